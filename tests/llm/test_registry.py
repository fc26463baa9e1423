from __future__ import annotations

import __spark_entry__ as entry

WITH_SQL = {"op6_top_k", "op9_exact_dedup", "op11_collocations", "op12_minhash", "op13_lexical_search"}


def test_each_operator_has_one_query_and_the_pipeline_is_there():
    keys = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in keys) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert {k for k in entry.oracle_sql() if k.startswith("op")} == WITH_SQL


def test_queries_with_sql_match_it(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    for key in sorted(WITH_SQL):
        got = entry.queries()[key](spark, "/root/testdata/sf0.01")
        cur = con.execute(entry.oracle_sql()[key])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(got.columns)
        assert sorted(cur.fetchall()) == sorted(tuple(r) for r in got.select(*names).collect())
