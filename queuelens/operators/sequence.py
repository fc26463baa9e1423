"""Numbering within a key without one task per key.

``row_number()`` over a key alone sends a hot key's rows to one task.  Keys
with many rows, found by an aggregate over the key alone, are therefore split
by a value that never decreases along the order (``part``, such as the month
of the first ordering column): rows are numbered within (key, part), and the
rows of a key's earlier parts, counted by a small aggregate, are added.  All
other keys are numbered by one window, so their rows are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows from which a key is hot; an input has at most its rows / HOT_ROWS of them.
HOT_ROWS = 100_000


def sequence_within_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], out_col: str,
                        part: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Append ``out_col`` = 1-based position of each row within its key, by ``order``.

    Equal to ``row_number() OVER (PARTITION BY keys ORDER BY order)`` as long as
    ``part`` never decreases along ``order``.  Rows that tie on every ordering
    column are ordered by their remaining columns, so a task that runs again
    numbers them alike.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot_rows)
    hot = F.broadcast(many.select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    is_hot = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    own = Window.partitionBy(*keys).orderBy(*order, *rest)
    few = df.join(hot, is_hot, "left_anti").withColumn(out_col, F.row_number().over(own).cast("long"))
    return few.unionByName(_in_parts(df.join(hot, is_hot, "left_semi"), keys, order, rest, out_col, part))


def _in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], rest: Sequence[str], out_col: str, part: Column) -> DataFrame:
    split = df.withColumn("_part", part)
    own = Window.partitionBy(*keys, "_part").orderBy(*order, *rest)
    numbered = split.withColumn("_own", F.row_number().over(own))
    counts = split.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_before_part"),
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("_part").eqNullSafe(F.col("_before_part"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return numbered.join(before, same).withColumn(out_col, (F.col("_own") + F.col("_before")).cast("long")).select(*df.columns, out_col)
