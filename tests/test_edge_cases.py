"""Hand-written rows for every trap (FIXTURES.md part C)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from queuelens.functions import sla, timestamps
from queuelens.operators import cleaning, filters, median, quality
from queuelens.schemas import DIM_CATEGORY

T0 = dt.datetime(2026, 7, 1, 0, 0, 0)
AS_OF = "2026-07-30 23:59:59"


def _ticket_df(spark, rows):
    """rows: (status, opened, closed, target)"""
    return spark.createDataFrame(
        rows, "status string, opened_at timestamp_ntz, closed_at timestamp_ntz, sla_target_hours int")


def _derive(df, as_of=AS_OF):
    return cleaning.recompute_breach(cleaning.recompute_resolution(df), as_of)


@pytest.mark.parametrize("values,expected", [([1, 2, 3, 4], 3.0), ([1, 2, 3], 2.0), ([5], 5.0),
                                             ([2.5, 1.25], 2.5)])
def test_upper_median(spark, values, expected):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "h double")
    assert median.upper_median(df, "h").first()[0] == expected


def test_upper_median_empty(spark):
    df = spark.createDataFrame([(None,)], "h double")
    assert median.upper_median(df, "h").first()[0] is None


def test_tie_rounding_is_half_even_and_breach_uses_rounded_hours(spark):
    # 86,418 s = 24.005 h -> 24.0 at 2 dp (half-to-even); target 24 -> not breached
    df = _ticket_df(spark, [("Closed", T0, T0 + dt.timedelta(seconds=86_418), 24)])
    r = _derive(df).first()
    assert r.resolution_hours == 24.0
    assert r.sla_breached == 0


def test_exactly_on_target_is_not_a_breach(spark):
    df = _ticket_df(spark, [("Closed", T0, T0 + dt.timedelta(seconds=86_400), 24),
                            ("Closed", T0, T0 + dt.timedelta(seconds=86_437), 24)])
    got = [r.sla_breached for r in _derive(df).orderBy("closed_at").collect()]
    assert got == [0, 1]   # 24.0 h exact: no; 24.01 h: yes


def test_closed_without_close_time_never_breaches(spark):
    df = _ticket_df(spark, [("Closed", T0, None, 24)])
    r = _derive(df).first()
    assert r.resolution_hours is None and r.sla_breached == 0


def test_open_ticket_clock_is_unrounded(spark):
    as_of = dt.datetime(2026, 7, 30, 23, 59, 59)
    exactly = as_of - dt.timedelta(hours=24)
    one_more = exactly - dt.timedelta(seconds=1)
    df = _ticket_df(spark, [("Open", exactly, None, 24), ("Open", one_more, None, 24)])
    got = {r.opened_at: r.sla_breached for r in _derive(df, as_of).collect()}
    assert got[exactly] == 0 and got[one_more] == 1


def test_timestamp_layouts_junk_and_invalid_dates(spark):
    vals = ["2026-02-05 04:03:09", "05/02/2026 16:03", "02-05-2026 04:03 PM", "05-Feb-2026 16:03:09",
            "5/2/2026 4:03", " junk", "31/02/2026 10:00", None, "05-FEB-2026 16:03:09",
            "02-05-2026 04:03 pm", "10:00:00", "2026"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", timestamps.parse_mixed_timestamp("s").alias("t")).collect()}
    assert got[0] == dt.datetime(2026, 2, 5, 4, 3, 9)
    assert got[1] == dt.datetime(2026, 2, 5, 16, 3)
    assert got[2] == dt.datetime(2026, 2, 5, 16, 3)
    assert got[3] == dt.datetime(2026, 2, 5, 16, 3, 9)
    assert got[4] == dt.datetime(2026, 2, 5, 4, 3)
    assert got[5] is None and got[6] is None and got[7] is None
    assert got[8] == dt.datetime(2026, 2, 5, 16, 3, 9)
    assert got[9] == dt.datetime(2026, 2, 5, 16, 3)
    assert got[10] is None and got[11] is None   # no anchoring to today / 1 January


def test_iso_fallback_accepts_t_separator(spark):
    df = spark.createDataFrame([("2026-02-05T04:03:09",)], "s string")
    assert df.select(timestamps.parse_mixed_timestamp("s")).first()[0] == dt.datetime(2026, 2, 5, 4, 3, 9)


def test_dedup_keeps_first_copy_even_with_null_agent(spark):
    raw = spark.createDataFrame([(1, "7", None), (2, "7", "5.0"), (1, "8", "3.0")],
                                "ingest_seq long, ticket_id string, agent_id string")
    out = cleaning.default_agent(cleaning.dedup_first(raw.withColumn("ticket_id", F.col("ticket_id").cast("long"))))
    got = {r.ticket_id: r.agent_id for r in out.collect()}
    assert got == {7: -1, 8: 3}


def test_customer_normalisation(spark):
    df = spark.createDataFrame([("  cust000123 ",)], "customer_id string")
    assert cleaning.normalize_customer(df).first()[0] == "CUST000123"


def test_strip_removes_any_surrounding_whitespace(spark):
    df = spark.createDataFrame([("\t cust000123\n",), ("\u00a0cust000124\u00a0",)], "customer_id string")
    assert [r[0] for r in cleaning.normalize_customer(df).collect()] == ["CUST000123", "CUST000124"]
    ts = spark.createDataFrame([("\t05/02/2026 16:03\r\n",)], "s string")
    assert ts.select(timestamps.parse_mixed_timestamp("s")).first()[0] == dt.datetime(2026, 2, 5, 16, 3)


def test_kpi_mean_hours_null_when_closed_tickets_have_no_hours(spark):
    rows = [(1, "Closed", None, 0, 10.0), (2, "Open", None, 1, 5.0)]
    df = spark.createDataFrame(rows, "ticket_id long, status string, resolution_hours double, "
                                     "sla_breached int, transaction_amount_inr double")
    k = filters.t_kpis(df).first()
    assert k.avg_resolution_hours is None and k.total_tickets == 2 and k.open_tickets == 1
    only_open = filters.t_kpis(df.filter("status = 'Open'")).first()
    assert only_open.avg_resolution_hours == 0.0


def test_bucket_edges(spark):
    hours = [24.0, 24.01, 48.0, 72.0, 168.0, 168.01, None]
    df = spark.createDataFrame([(h,) for h in hours], "h double")
    got = [r.b for r in df.select(sla.resolution_bucket("h").alias("b")).collect()]
    assert got == ["0-24 hrs", "24-48 hrs", "24-48 hrs", "48-72 hrs", "72-168 hrs", "168+ hrs", "168+ hrs"]


def test_salary_window_days(spark):
    days = [2, 3, 24, 25, 31]
    df = spark.createDataFrame([(dt.datetime(2026, 1, d, 12),) for d in days], "t timestamp_ntz")
    got = [r.p for r in df.select(sla.salary_period("t").alias("p")).collect()]
    assert got == [sla.SALARY_LABEL, sla.REST_LABEL, sla.REST_LABEL, sla.SALARY_LABEL, sla.SALARY_LABEL]


def test_weekday_is_sunday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 7, 5, 10),)], "t timestamp_ntz")  # a Sunday
    r = df.select(sla.weekday_sunday0("t").alias("n")).first()
    assert r.n == 0


def test_orphan_key_is_reported(spark):
    fact = spark.createDataFrame([(1, 3), (2, 99), (3, None)], "ticket_id long, category_id int")
    dim = spark.createDataFrame([(3, "x", "g", 24)], DIM_CATEGORY)
    got = [r.ticket_id for r in quality.fk_orphans(fact, dim, "category_id").collect()]
    assert got == [2]


def test_orphan_keys_are_aggregated(spark):
    fact = spark.createDataFrame([(1, 3), (2, 99), (3, 99), (4, None)], "ticket_id long, category_id int")
    dim = spark.createDataFrame([(3, "x", "g", 24)], DIM_CATEGORY)
    got = [tuple(r) for r in quality.fk_orphan_keys(fact, dim, "category_id").collect()]
    assert got == [(99, 2)]


def test_gate_raises_on_duplicates(spark):
    row = (1, "CUST000001", 1, 1, T0, "Open", 24, 0, 0)
    schema = ("ticket_id long, customer_id string, category_id int, channel_id int, opened_at timestamp_ntz, "
              "status string, sla_target_hours int, sla_breached int, is_incident_day int")
    assert quality.gate(spark.createDataFrame([row], schema)).count() == 1
    with pytest.raises(quality.DataQualityError, match="duplicate_keys"):
        quality.gate(spark.createDataFrame([row, row], schema))


def test_empty_selection_gives_zero_kpis(spark, small_star):
    e = filters.t_load(small_star)
    f = filters.t_filter(e, filters.TicketFilter(categories=[]))
    k = filters.t_kpis(f).first()
    assert k.total_tickets == 0 and k.sla_compliance_pct == 0.0 and k.avg_resolution_hours == 0.0
    assert k.open_tickets == 0 and k.disputed_value_inr == 0.0


def test_half_open_range_means_full_bounds(spark, small_star):
    e = filters.t_load(small_star)
    full = filters.t_filter(e, filters.TicketFilter()).count()
    half = filters.t_filter(e, filters.TicketFilter(start=dt.date(1998, 1, 1), end=None)).count()
    assert full == half == e.count()


def test_month_partition_predicate_is_added(spark, small_star):
    e = filters.t_load(small_star)
    f = filters.t_filter(e, filters.TicketFilter(start=dt.date(1998, 1, 1), end=dt.date(1998, 3, 31)))
    from tests.conftest import explain_text

    plan = explain_text(f)
    assert "PartitionFilters" in plan and "opened_month" in plan
    assert f.count() == e.filter(F.to_date("opened_at").between("1998-01-01", "1998-03-31")).count()


def test_raw_csv_quarantines_malformed_lines(spark):
    import os

    from queuelens.schemas import RAW_COLUMNS
    from queuelens.session import scratch_path
    from queuelens.sources import files

    path = scratch_path(spark, "bad_csv")
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(local, exist_ok=True)
    good = "1,7,  cust000123 ,3,2,5.0,100.5,2026-02-05 04:03:09,,Open,,24,1,,0"
    with open(os.path.join(local, "part-0.csv"), "w") as fh:
        fh.write(",".join(RAW_COLUMNS) + "\n" + good + "\n" + "2,8,oops,too,many,fields" + ",x" * 20 + "\n")
    df = files.read_raw_csv(spark, path).cache()
    rows = sorted(df.collect(), key=lambda r: r.ingest_seq)
    assert len(rows) == 2
    assert rows[0][files.CORRUPT_COLUMN] is None and rows[0].customer_id == "  cust000123 "
    assert rows[1][files.CORRUPT_COLUMN] is not None


def test_unparsed_rows_are_quarantined(spark):
    raw = spark.createDataFrame([(1, 7, "05/02/2026 16:03"), (1, 8, "not a time"), (2, 8, None)],
                                "ingest_seq long, ticket_id long, opened_at string")
    parsed = cleaning.parse_timestamps(raw, cols=("opened_at",))
    q = quality.unparsed_timestamps(raw, "opened_at").collect()
    assert [(r.ticket_id, r.ingest_seq, r.opened_at_text) for r in q] == [(8, 1, "not a time")]
    n = quality.unparsed_count(raw.withColumn("_ts", timestamps.parse_mixed_timestamp("opened_at")),
                               "opened_at", "_ts").first()[0]
    assert n == 1
