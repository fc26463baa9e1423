"""End-to-end jobs: raw CSV export -> clean -> star -> catalog / mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuelens import jobs
from queuelens.plans.model import materialized_raw, read_star
from queuelens.plans.queries import QUERIES, q_a1_kpis
from queuelens.session import scratch_path
from queuelens.sources import fixtures, sinks
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark):
    base = scratch_path(spark, "jobs")
    sinks.write_raw_csv(materialized_raw(spark, SF_SMALL), f"{base}/raw")
    sinks.write_dim_csv(fixtures.dim_category(spark, SF_SMALL), f"{base}/category")
    sinks.write_dim_csv(fixtures.dim_channel(spark, SF_SMALL), f"{base}/channel")
    sinks.write_dim_csv(fixtures.dim_agent_base(spark, SF_SMALL), f"{base}/agent")

    c = jobs.main(["clean", "--raw", f"{base}/raw", "--out", f"{base}/clean", "--as-of", fixtures.AS_OF], spark)
    assert c == {"raw_rows": 6_000, "quarantined": 0, "unparsed_opened_at": 0, "duplicates_removed": 1_401, "clean_rows": 4_599}

    s = jobs.main(["star", "--clean", f"{base}/clean", "--category", f"{base}/category",
                   "--channel", f"{base}/channel", "--agent", f"{base}/agent", "--out", f"{base}/star"], spark)
    assert s["orphans"] == {"category_id": 0, "channel_id": 0, "agent_id": 0}
    star = read_star(spark, f"{base}/star")
    k = q_a1_kpis(star).first()
    assert (k.total_tickets, k.open_tickets) == (4_599, 55)

    rows = jobs.main(["catalog", "--star", f"{base}/star", "--out", f"{base}/answers"], spark)
    assert set(rows) == set(QUERIES) and all(n > 0 for n in rows.values())

    m = jobs.main(["mart", "--star", f"{base}/star", "--out", f"{base}/mart"], spark)
    assert m["mart_rows"] > 0
    daily = spark.read.parquet(f"{base}/mart/daily")
    assert daily.agg(F.sum("tickets")).first()[0] == 4_599
    assert spark.read.parquet(f"{base}/mart/agents").agg(F.sum("tickets")).first()[0] == 4_599

    choice = ["--star", f"{base}/star", "--start", "1998-01-01", "--end", "1998-12-31", "--channel", "1-URGENT"]
    assert jobs.main(["panels", *choice, "--out", f"{base}/panels"], spark) == {"panels": 6}
    assert jobs.main(["panels", "--mart", f"{base}/mart", *choice[2:], "--out", f"{base}/mart_panels"], spark) == {"panels": 6}
    for name in ("kpis", "category", "monthly", "channel_counts", "root_causes", "match_count"):
        both = [sorted(map(tuple, spark.read.option("header", True).csv(f"{base}/{x}/{name}").collect())) for x in ("panels", "mart_panels")]
        assert both[0] == both[1], name
    n = int(spark.read.option("header", True).csv(f"{base}/panels/match_count").first()[0])
    assert 0 < n == jobs.main(["export", *choice, "--out", f"{base}/detail"], spark)["rows"]

    made = jobs.main(["datasets", "--star", f"{base}/star", "--out", f"{base}/datasets"], spark)["datasets"]
    assert {"x_kpis", "x_detail", "p_incident", "bd_sanity", "r_target_gap", "r_salary_lift"} <= set(made)
    assert all(spark.read.option("header", True).csv(f"{base}/datasets/{k}").count() > 0 for k in made)

    spark.createDataFrame([("SELECT team, count(*) AS n\nFROM fact_complaints JOIN dim_agent USING (agent_id) GROUP BY team;",)], "q string") \
        .coalesce(1).write.text(f"{base}/query")
    assert jobs.main(["sql", "--star", f"{base}/star", "--query", f"{base}/query", "--out", f"{base}/by_team"], spark)["columns"] == ["team", "n"]
    assert sum(int(r.n) for r in spark.read.option("header", True).csv(f"{base}/by_team").collect()) == 4_599


def test_ingest_and_compact_jobs(spark):
    from queuelens.streaming.ingest import read_ingested

    base = scratch_path(spark, "jobs_ingest")
    sinks.write_raw_csv(materialized_raw(spark, SF_SMALL), f"{base}/drops/a")
    run = ["ingest", "--source", f"{base}/drops/*", "--sink", f"{base}/sink", "--checkpoint", f"{base}/ckpt", "--as-of", fixtures.AS_OF]
    assert jobs.main(run, spark)["batches_to_merge"] == 1
    assert jobs.main(["compact", "--sink", f"{base}/sink"], spark) == {"version": 1, "dropped": 0}
    assert jobs.main(run, spark)["batches_to_merge"] == 0
    assert jobs.main(["compact", "--sink", f"{base}/sink"], spark) == {"version": None, "dropped": 0}
    assert read_ingested(spark, f"{base}/sink").count() == 4_599
