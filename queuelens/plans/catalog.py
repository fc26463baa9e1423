"""Registry of every operator / query runnable over a driver table directory.

Each entry is ``(spark, sf_dir) -> DataFrame``.  The star is built from the
driver tables and written once per application (see
:func:`queuelens.plans.model.materialized_star`); operators that work on the
raw export read the fixture's raw projection directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from queuelens.plans import queries
from queuelens.plans.model import materialized_star

Runner = Callable[[SparkSession, str], DataFrame]


def _on_star(fn) -> Runner:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(materialized_star(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def registry() -> dict[str, Runner]:
    from queuelens.plans.catalog_more import more_registry

    reg: dict[str, Runner] = {k: _on_star(v) for k, v in queries.QUERIES.items()}
    reg.update(more_registry())
    return reg
