"""Exports that round-trip, one cleaning pipeline, digests before joins, hot members apart, panels from one scan."""

from __future__ import annotations

import csv
import datetime as dt
import glob
import io
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from queuelens.operators import cleaning, filters, joins, quality
from queuelens.plans.model import materialized_raw, materialized_star
from queuelens.schemas import DIM_AGENT, DIM_CATEGORY, DIM_CHANNEL, FACT, FACT_COLUMNS, RAW_COLUMNS
from queuelens.session import scratch_path
from queuelens.sources import files, fixtures, sinks
from tests.conftest import SF_SMALL, explain_text

ODD = ['a "b", c', 'two\nlines', 'comma, "quote" and\r\nboth', '"', 'back\\slash "x\\"', "plain", ' ""'"'"]


def local(path):
    return path.removeprefix("file:")


def read_with_pandas(path, **more):
    return pd.concat([pd.read_csv(f, keep_default_na=False, **more) for f in sorted(glob.glob(f"{local(path)}/part-*.csv"))])


def test_dimension_exports_round_trip_here_and_in_pandas(spark):
    base = scratch_path(spark, "round_dims")
    agents = spark.createDataFrame([(i, t, f"team {t}") for i, t in enumerate(ODD)], DIM_AGENT)
    sinks.write_dim_csv(agents, f"{base}/agent")
    sinks.write_dim_csv(spark.createDataFrame([(1, ODD[0], ODD[2], 24)], DIM_CATEGORY), f"{base}/category")
    sinks.write_dim_csv(spark.createDataFrame([(1, ODD[1])], DIM_CHANNEL), f"{base}/channel")
    cat, ch, ag = files.read_dims_csv(spark, f"{base}/category", f"{base}/channel", f"{base}/agent")
    assert sorted(map(tuple, ag.collect())) == sorted(map(tuple, agents.collect()))
    assert tuple(cat.first()) == (1, ODD[0], ODD[2], 24) and tuple(ch.first()) == (1, ODD[1])
    assert sorted(read_with_pandas(f"{base}/agent")["agent_name"]) == sorted(ODD)


def test_clean_detail_and_raw_exports_round_trip(spark):
    star = materialized_star(spark, SF_SMALL)
    odd = F.element_at(F.array(*[F.lit(x) for x in ODD]), (F.col("ticket_id") % len(ODD) + 1).cast("int"))
    fact = star.fact.select(*FACT_COLUMNS).withColumn("root_cause", odd)
    base = scratch_path(spark, "round_clean")
    sinks.write_clean_csv(fact, f"{base}/clean")
    back = files.read_clean(spark, f"{base}/clean", fmt="csv")
    assert sorted(map(str, back.collect())) == sorted(map(str, fact.collect()))
    got = read_with_pandas(f"{base}/clean")
    want = {r.ticket_id: r.root_cause for r in fact.collect()}
    assert dict(zip(got["ticket_id"], got["root_cause"], strict=True)) == want
    detail = joins.enriched(fact, star.dim_category, star.dim_channel, star.dim_agent)
    sinks.write_detail_csv(filters.t_drill(detail), f"{base}/detail")
    got = read_with_pandas(f"{base}/detail")
    assert dict(zip(got["ticket_id"], got["root_cause"], strict=True)) == want


def export(rows, columns=RAW_COLUMNS[1:]):
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(columns)
    w.writerows(rows)
    return out.getvalue()


def ticket(n, cause="x", **more):
    row = dict.fromkeys(RAW_COLUMNS[1:], "") | {
        "ticket_id": n, "customer_id": f"CUST{n}", "category_id": 1, "channel_id": 2, "opened_at": "2026-02-05 04:03:09",
        "status": "Open", "sla_target_hours": 24, "sla_breached": 0, "root_cause": cause, "is_incident_day": 0} | more
    return [row[c] for c in RAW_COLUMNS[1:]]


def test_records_over_lines_surplus_and_short_records(spark, tmp_path):
    """A quoted break is one record at any split size; a 15th field is quarantined with its text."""
    many = [ticket(n, ODD[n % len(ODD)]) for n in range(2000)]
    (tmp_path / "a.csv").write_bytes(export(many).encode())
    (tmp_path / "b.csv").write_bytes((export([ticket(n) for n in range(3000, 5000)]) + ",".join(map(str, ticket(6000))) + ",surplus\n7000,short\n").encode())
    (tmp_path / "c.csv").write_bytes(export([ticket(n) for n in range(8000, 8010)]).encode() + b'9000,"never closed\n9001,swallowed\n')
    path = str(tmp_path)
    assert [f.rsplit("/", 1)[1] for f in files.files_with_open_lines(spark, path)] == ["a.csv", "c.csv"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for size in (old, "7k", "64k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = files.read_raw_csv(spark, path)
            assert size == old or rows.rdd.getNumPartitions() > 3
            seen.append(sorted((r.ticket_id, r.root_cause or "", r[files.CORRUPT_COLUMN] or "") for r in rows.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seen[0] == seen[1] == seen[2]
    good = {t: c for t, c, bad in seen[0] if not bad}
    assert len(good) == 4010 and all(good[str(n)] == ODD[n % len(ODD)] for n in range(2000))
    bad = {t: text for t, _, text in seen[0] if text}
    assert bad["6000"].endswith(",surplus") and bad["7000"] == "7000,short" and bad["9000"].startswith('9000,"never closed\n9001')

    m = cleaning.run_clean_pipeline(files.read_raw_csv(spark, path), "2026-03-01 00:00:00", scratch_path(spark, "round_raw"))
    assert (m["raw_rows"], m["clean_rows"], m["quarantined"], m["duplicates_removed"]) == (4013, 4010, 3, 0)


def test_a_missing_required_value_is_quarantined_and_the_first_copy_decides(spark, tmp_path):
    blank = {c: "" for c in ("customer_id", "category_id", "channel_id", "opened_at", "status", "sla_target_hours", "is_incident_day")}
    rows = [ticket(n, **{c: ""}) for n, c in enumerate(blank)] + [ticket(50, status="Lost"), ticket(51, is_incident_day=2)]
    rows += [ticket(7, cause="first", opened_at="soon"), ticket(7, cause="second"), ticket(8, cause="first"), ticket(8, cause="second", status="")]
    (tmp_path / "a.csv").write_text(export(rows))
    raw = files.read_raw_csv(spark, str(tmp_path))
    out = scratch_path(spark, "required")
    m = cleaning.run_clean_pipeline(raw, "2026-03-01 00:00:00", out)
    assert m == {"raw_rows": 13, "clean_rows": 1, "quarantined": 10, "duplicates_removed": 2, "unparsed_opened_at": 1}
    clean = spark.read.parquet(out)
    assert [(r.ticket_id, r.root_cause) for r in clean.collect()] == [(8, "first")]
    assert clean.dtypes == cleaning.clean_pipeline(raw, "2026-03-01 00:00:00").dtypes
    assert clean.collect() == cleaning.clean_pipeline(raw, "2026-03-01 00:00:00").collect()
    reasons = {r.ticket_id: r.reasons for r in spark.read.parquet(f"{out}_quarantine").collect()}
    assert [reasons[str(n)] for n in range(len(blank))] == [[c] for c in blank] and reasons["7"] == ["opened_at"]
    assert reasons["50"] == ["status"] and reasons["51"] == ["is_incident_day"]


def test_order_of_a_14_column_export_is_a_place_not_a_number(spark):
    path = scratch_path(spark, "places")
    materialized_raw(spark, SF_SMALL).select(*RAW_COLUMNS[1:]).write.option("header", True).option("escape", '"').csv(path)
    rows = files.read_raw_csv(spark, path)
    assert dict(rows.dtypes)["ingest_seq"].startswith("struct<seq:bigint,file_time:timestamp,path:string")
    assert "Exchange" not in explain_text(rows)
    assert explain_text(cleaning.dedup_first(rows)).count("Exchange") == 1
    timed = files.read_raw_csv(spark, path, by_time=True)
    assert timed.where("ingest_seq.file_time is null").count() == 0 and rows.where("ingest_seq.file_time is not null").count() == 0


# ------------------------------------------------------------ digests

def naive(left, right, cols):
    a, b = ({r[0]: r[1:] for r in x if r[0] is not None} for x in (left, right))
    nulls = [sum(r[0] is None for r in x) for x in (left, right)]
    both = a.keys() & b.keys()
    return (len(a.keys() - both) + nulls[0], len(b.keys() - both) + nulls[1], len(both),
            *[sum(a[k][i] != b[k][i] for k in both) for i in range(len(cols))])


@pytest.mark.parametrize("levels", [(4,), (2, 16), quality.DIGEST_LEVELS])
def test_reconcile_equals_a_plain_comparison(spark, levels):
    left = [(i, i % 5 or None, f"s{i % 7}") for i in range(500)] + [(None, 1, "n"), (None, 1, "n")]
    right = [(i, (i % 5 or None) if i % 50 else -1, f"s{i % 7}" if i % 70 else None) for i in range(20, 520)] + [(None, 1, "n")]
    frames = [spark.createDataFrame(x, "ticket_id long, a int, b string") for x in (left, right)]
    assert tuple(quality.reconcile(*frames, levels=levels).first()) == naive(left, right, "ab")
    assert tuple(quality.reconcile(frames[0], frames[0], levels=levels).first()) == (2, 2, 500, 0, 0)
    empty = frames[0].where("false")
    assert tuple(quality.reconcile(empty, frames[1], levels=levels).first()) == (0, 501, 0, 0, 0)
    assert tuple(quality.reconcile(empty, empty, levels=levels).first()) == (0, 0, 0, 0, 0)


def shuffled_rows(df):
    """Rows that each exchange of the executed plan wrote, by the public metrics in the final plan's text."""
    df.collect()
    counts = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            counts.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return counts


def test_equal_tables_shuffle_digests_but_no_rows(spark):
    fact = materialized_star(spark, SF_SMALL).fact.select(*FACT_COLUMNS)
    n = fact.count()
    result = quality.reconcile(fact, fact, levels=(8, 64))
    assert result.first().matched == n
    assert sum(shuffled_rows(result)) < n / 10
    assert tuple(result.first())[3:] == (0,) * (len(FACT_COLUMNS) - 1)


# ------------------------------------------------------------ hot members

def test_split_join_keeps_hot_members_off_the_shuffle(spark):
    rows = spark.range(20_000).select(F.col("id").alias("ticket_id"), F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, 5)
                                      .when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 1000 + 10).cast("int").alias("agent_id"))
    dim = spark.range(5, 2000).select(F.col("id").cast("int").alias("agent_id"), F.concat(F.lit("a"), "id").alias("agent_name"), F.lit("t").alias("team"))
    dim = dim.unionByName(spark.createDataFrame([(-1, "Unassigned", "Unassigned")], DIM_AGENT))
    want = sorted(map(tuple, joins.join_dim(rows, dim, "agent_id").collect()))
    split = joins.split_join(rows, dim, "agent_id", hot_share=0.05)
    assert sorted(map(tuple, split.collect())) == want and len(want) > 15_000
    plan = explain_text(split)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
    assert sorted(map(tuple, joins.split_join(rows.where("agent_id > 9"), dim, "agent_id", 0.5).collect())) == [r for r in want if r[0] > 9]
    assert joins.split_join(rows.where("false"), dim, "agent_id").count() == 0


def test_agents_join_by_size_estimate(spark):
    star = materialized_star(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert joins.fits_broadcast(star.dim_agent)
    want = sorted(map(str, star.enriched().collect()))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not joins.fits_broadcast(star.dim_agent)
        assert sorted(map(str, star.enriched().collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ------------------------------------------------------------ panels

CHOICES = [filters.TicketFilter(), filters.TicketFilter(start=dt.date(1998, 1, 1), end=dt.date(1998, 6, 30), channels=["1-URGENT", "2-HIGH"]),
           filters.TicketFilter(incident_only=True), filters.TicketFilter(categories=[])]


@pytest.mark.parametrize("choice", CHOICES)
def test_panels_from_one_scan_equal_the_single_panels(spark, choice):
    rows = filters.t_filter(filters.t_panel(materialized_star(spark, SF_SMALL)), choice)
    cube = filters.panel_cube(rows)
    assert choice.categories == [] or len(re.findall(r"FileScan parquet \[category_id#\d+,channel_id", explain_text(cube))) == 1
    path = scratch_path(spark, "cube")
    cube.write.parquet(path)
    got = filters.panels_of(spark.read.schema(cube.schema).parquet(path))
    single = {"kpis": filters.t_kpis, "category": filters.t_category, "monthly": filters.t_monthly,
              "channel_counts": filters.t_channel_counts, "root_causes": filters.t_root_causes8, "match_count": filters.t_match_count}
    for name, fn in single.items():
        want = fn(rows)
        assert got[name].dtypes == want.dtypes, name
        assert sorted(map(str, got[name].collect())) == sorted(map(str, want.collect())), name


def test_fact_schema_is_unchanged():
    assert FACT.names == FACT_COLUMNS and fixtures.AS_OF
