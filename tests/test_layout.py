"""The interleaved layout of the star: what filters and point lookups read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from queuelens.plans.model import Star, interleaved_key, materialized_star, read_star, write_star
from queuelens.schemas import FACT_COLUMNS
from queuelens.session import scratch_path
from tests.conftest import SF_SMALL


def rows_read(df):
    """Rows that the scans handed on, from the executed plan's public metrics."""
    df.collect()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            out.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(out)


@pytest.fixture(scope="module")
def stars(spark):
    """One month of 60,000 tickets in eight files of small pages, in both layouts."""
    base = materialized_star(spark, SF_SMALL)
    n = F.col("id")
    hashed = F.pmod(F.xxhash64("id"), F.lit(1_000_003))
    fact = spark.range(60_000).select(
        (hashed * 100_000 + n).alias("ticket_id"), F.lit("C").alias("customer_id"), (hashed % 25).cast("int").alias("category_id"),
        (F.floor(hashed / 10) % 5 + 1).cast("int").alias("channel_id"), F.lit(1).alias("agent_id"), F.lit(1.0).alias("transaction_amount_inr"),
        F.timestamp_add("SECOND", (hashed * 7919) % (30 * 86_400), F.lit("2026-01-01").cast("timestamp_ntz")).alias("opened_at"),
        F.lit(None).cast("timestamp_ntz").alias("closed_at"), F.lit("Open").alias("status"), F.lit(None).cast("double").alias("resolution_hours"),
        F.lit(24).alias("sla_target_hours"), F.lit(0).alias("sla_breached"), F.lit(None).cast("string").alias("root_cause"), F.lit(0).alias("is_incident_day"))
    fact = fact.repartition(8)
    out = {}
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        for layout in ("time", "interleaved"):
            path = scratch_path(spark, f"layout_{layout}")
            small = {"parquet.page.row.count.limit": "200", "parquet.page.size.row.check.min": "100"}
            write_star(Star(fact, base.dim_category, base.dim_channel, base.dim_agent), path, layout, small)
            out[layout] = read_star(spark, path).fact
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    return out


def test_both_layouts_hold_the_same_rows(stars):
    a, b = (sorted(map(tuple, f.select(*FACT_COLUMNS).collect())) for f in stars.values())
    assert a == b and len(a) == 60_000


@pytest.mark.parametrize("condition,share", [("category_id = 3", 0.4), ("channel_id = 1", 0.6), ("category_id = 3 and channel_id = 3", 0.25)])
def test_filters_on_either_key_skip_most_pages(stars, condition, share):
    got, plain = stars["interleaved"].where(condition), stars["time"].where(condition)
    assert rows_read(got) < share * 60_000 == share * rows_read(plain)     # ordered by time alone, every page holds every category
    assert sorted(got.select("ticket_id").collect()) == sorted(plain.select("ticket_id").collect()) != []


def test_point_lookup_reads_few_files(stars):
    fact = stars["interleaved"]
    files = fact.select(F.input_file_name()).distinct().count()
    assert files >= 4
    ids = [r.ticket_id for r in fact.orderBy("ticket_id").select("ticket_id").limit(40_000).tail(3)]
    for one in ids:
        found = fact.where(F.col("ticket_id") == one)
        assert [r.ticket_id for r in found.collect()] == [one]
        assert rows_read(found) <= 2 * 60_000 / files


def test_key_interleaves_bits(spark):
    df = spark.sql("SELECT 5 AS a, 3 AS b UNION ALL SELECT NULL, 99")
    key = interleaved_key({"a": F.lit(8), "b": F.lit(8)}, bits=3)
    # highest bit first, in turn from a = 101 and b = 011; null counts as 0, 99 as 7
    assert [r[0] for r in df.select(key).collect()] == [0b10_01_11, 0b01_01_01]
