from __future__ import annotations

import pytest


@pytest.fixture
def tables(spark, tmp_path):
    """Write small tables as <dir>/<name>.parquet and return the directory."""
    def write(**frames):
        for name, (rows, schema) in frames.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
