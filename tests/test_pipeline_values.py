"""Raw export -> CSV -> cleaning pipeline, checked against the cross-checked
values of the messy projection (FIXTURES.md section B.3)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from queuelens.functions import timestamps
from queuelens.operators import cleaning, median, quality
from queuelens.plans.model import materialized_raw
from queuelens.session import scratch_path
from queuelens.sources import files, fixtures, sinks

# (raw, unique, open, closed breached, sum hours, negative, unparsed, customers, on target, median)
EXPECTED = {
    "/root/testdata/sf0.001": (6_000, 4_599, 55, 2_479, 444_608.15, 0, 0, 150, 2, 97.43),
    "/root/testdata/sf0.01": (60_000, 45_832, 306, 25_583, 4_417_626.14, 0, 0, 1_500, 1, 96.6),
    "/root/testdata/sf0.1": (600_000, 456_861, 2_895, 255_414, 44_105_415.43, 2, 0, 14_999, 23, 97.04),
}


@pytest.mark.parametrize("sf_dir", sorted(EXPECTED))
def test_cleaned_export_matches_cross_checked_values(spark, sf_dir):
    path = scratch_path(spark, "pipeline_csv")
    sinks.write_raw_csv(materialized_raw(spark, sf_dir), path)
    raw = files.read_raw_csv(spark, path)
    clean = cleaning.clean_pipeline(raw, fixtures.AS_OF)
    out = scratch_path(spark, "pipeline_clean")
    quality.write_then_gate(clean, out)
    c = spark.read.parquet(out)

    r = c.agg(
        F.count(F.lit(1)).alias("unique"),
        F.count_if(F.col("status") == "Open").alias("open"),
        F.count_if((F.col("status") == "Closed") & (F.col("sla_breached") == 1)).alias("closed_breached"),
        F.sum(F.col("resolution_hours").cast("decimal(18,2)")).cast("double").alias("sum_hours"),
        F.count_if(F.col("resolution_hours") < 0).alias("negative"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(F.col("resolution_hours") == F.col("sla_target_hours")).alias("on_target"),
    ).first()
    unparsed = quality.unparsed_count(
        raw.select(F.col("opened_at").alias("_text"), timestamps.parse_mixed_timestamp("opened_at").alias("_ts")),
        "_text", "_ts").first()[0]
    med = median.upper_median(c, "resolution_hours").first()[0]
    got = (raw.count(), r.unique, r.open, r.closed_breached, r.sum_hours, r.negative, unparsed,
           r.customers, r.on_target, med)
    assert got == EXPECTED[sf_dir]


def test_observed_counts_match(spark):
    sf_dir = "/root/testdata/sf0.001"
    m = cleaning.run_clean_pipeline(materialized_raw(spark, sf_dir), fixtures.AS_OF,
                                    scratch_path(spark, "observed_clean"))
    assert m == {"raw_rows": 6_000, "quarantined": 0, "unparsed_opened_at": 0, "duplicates_removed": 1_401, "clean_rows": 4_599}
