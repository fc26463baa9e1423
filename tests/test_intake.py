"""No row is lost on the way in: ids, quarantine, raw layouts, and publishing after the audit."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from queuelens.functions import privacy
from queuelens.operators import cleaning, quality
from queuelens.plans import queries as Q
from queuelens.plans.model import materialized_raw, materialized_star
from queuelens.schemas import FACT_COLUMNS, RAW_COLUMNS
from queuelens.session import scratch_path
from queuelens.sources import files, fixtures, sinks
from tests.conftest import SF_SMALL, explain_text


def test_long_customer_keys_keep_all_digits(spark):
    ids = spark.createDataFrame([(1234567,), (1234569,), (42,)], "o_custkey long").select(
        F.format_string("CUST%06d", "o_custkey").alias("customer_id"))
    assert sorted(r.customer_id for r in ids.collect()) == ["CUST000042", "CUST1234567", "CUST1234569"]
    assert ids.select(privacy.mask_customer("customer_id", "salt")).distinct().count() == 3


def spoilt(spark):
    """Raw rows with five unreadable ids, bad times, a text NaN agent and junk in other fields."""
    good = materialized_raw(spark, SF_SMALL).limit(300).collect()
    rows = [r.asDict() for r in good]
    for i in range(5):
        rows[i]["ticket_id"] = f"T-{i}"
    rows[5]["opened_at"], rows[6]["closed_at"], rows[7]["transaction_amount_inr"] = "soon", "later", "junk"
    rows[8]["agent_id"], rows[9]["agent_id"], rows[10]["sla_target_hours"] = "A17", "NaN", "NaN"
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows],
                                 materialized_raw(spark, SF_SMALL).select(*RAW_COLUMNS).schema)


def test_every_raw_row_is_clean_duplicate_or_quarantined(spark):
    out = scratch_path(spark, "intake")
    bad = {r.ticket_id: r.reasons for r in cleaning.quarantine(spoilt(spark)).collect()}
    assert {f"T-{i}" for i in range(5)} <= set(bad) and len(bad) == 10
    m = cleaning.run_clean_pipeline(spoilt(spark), fixtures.AS_OF, out)
    assert m["raw_rows"] == 300 == m["clean_rows"] + m["duplicates_removed"] + m["quarantined"]
    assert m["quarantined"] == 10 and m["unparsed_opened_at"] == 1
    kept = spark.read.parquet(f"{out}_quarantine")
    assert kept.count() == 10 and kept.where(F.size("reasons") == 0).count() == 0


def fingerprint(path):
    path = path.removeprefix("file:")
    return sorted((f, hashlib.md5(open(os.path.join(d, f), "rb").read()).hexdigest()) for d, _, fs in os.walk(path) for f in fs)


def test_a_failed_gate_leaves_the_old_output_as_it_was(spark):
    out = scratch_path(spark, "publish")
    fact = materialized_star(spark, SF_SMALL).fact.select(*FACT_COLUMNS).limit(50)
    quality.write_then_gate(fact, out)
    before = fingerprint(out)
    assert before
    for spoil in ({"channel_id": F.lit(None).cast("int")}, {"status": F.lit("Lost")}, {"ticket_id": F.lit(7).cast("long")},
                  {"ticket_id": F.lit(None).cast("long")}, {"customer_id": F.lit(None).cast("string")}):
        with pytest.raises(quality.DataQualityError):
            quality.write_then_gate(fact.withColumns(spoil), out)
        assert fingerprint(out) == before
    quality.write_then_gate(fact.limit(10), out)
    assert spark.read.parquet(out).count() == 10


def export(spark, path, columns, files_=4):
    raw = materialized_raw(spark, SF_SMALL).orderBy("ingest_seq", "ticket_id")
    raw.repartitionByRange(files_, "ingest_seq", "ticket_id").sortWithinPartitions("ingest_seq", "ticket_id").select(
        *columns).write.option("header", True).option("escape", '"').csv(path)


def test_fourteen_column_export_in_several_files_and_splits(spark):
    path = scratch_path(spark, "raw14")
    export(spark, path, RAW_COLUMNS[1:])
    want = sorted(map(str, cleaning.clean_pipeline(materialized_raw(spark, SF_SMALL), fixtures.AS_OF).collect()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (old, "20k", "300k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = files.read_raw_csv(spark, path)
            assert rows.columns == [*RAW_COLUMNS, files.CORRUPT_COLUMN]
            assert sorted(map(str, cleaning.clean_pipeline(rows, fixtures.AS_OF).collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_header_that_does_not_fit_names_the_columns(spark):
    path = scratch_path(spark, "raw_bad")
    export(spark, path, [c for c in RAW_COLUMNS[1:] if c != "customer_id"], 1)
    with pytest.raises(ValueError, match="customer_id"):
        files.read_raw_csv(spark, path)


def test_catalog_check_runs_every_measure(spark, monkeypatch):
    from queuelens.plans import catalog_more

    plan = explain_text(catalog_more.v1_catalog(spark, SF_SMALL))
    assert plan.count("bit_xor") >= len(Q.QUERIES)
    broken = lambda star: star.fact.groupBy("status").agg(F.sum(F.raise_error(F.lit("broken measure")).cast("int")).alias("x"))
    monkeypatch.setattr(Q, "QUERIES", {**Q.QUERIES, "q_broken": broken})
    with pytest.raises(Exception, match="broken measure"):
        catalog_more.v1_catalog(spark, SF_SMALL).collect()


def test_daily_mart_is_bounded_by_calendar_and_dimensions(spark):
    from queuelens.plans import mart

    star = materialized_star(spark, SF_SMALL)
    twice = star.fact.select(*FACT_COLUMNS).union(star.fact.select(*FACT_COLUMNS).withColumn("agent_id", F.col("agent_id") + 1000))
    assert not {"agent_id", "root_cause"} & set(mart.MART_KEYS)
    assert mart.build_mart(twice).count() == mart.build_mart(star.fact).count()


def test_lines_with_a_header_in_every_file_and_small_raw_files(spark, tmp_path, monkeypatch):
    """Surplus records are written by all tasks, not by one, and no raw file holds more than FILE_RECORDS records."""
    lines = spark.range(0, 1000, 1, 4).selectExpr("concat(id, ',  a ,,x,', id) AS value")
    monkeypatch.setattr(sinks, "FILE_RECORDS", 100)
    sinks.write_lines(lines, "p,q", f"{tmp_path}/lines")
    got = spark.read.text(f"{tmp_path}/lines").selectExpr("value", "_metadata.file_path AS f").collect()
    assert len({r.f for r in got}) >= 10 and sum(r.value == "p,q" for r in got) == len({r.f for r in got})
    assert sorted(r.value for r in got if r.value != "p,q") == sorted(r.value for r in lines.collect())
    sinks.write_raw_csv(lines, f"{tmp_path}/raw")
    assert spark.read.text(f"{tmp_path}/raw").groupBy("_metadata.file_path").count().agg({"count": "max"}).first()[0] <= 101
