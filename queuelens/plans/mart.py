"""Additive marts from which part of the catalog and the filter panels roll up.

The daily mart's grain is (day, category, channel, incident flag, status,
breach flag): bounded by the calendar and a few small dimensions, so it stops
growing while tickets keep coming.  What would multiply it has marts of its
own: root causes, which only one panel reads (breached tickets by day,
category, channel and cause), agents by month, and the hour distribution.
Measures are additive (ticket count, exact DECIMAL hour and amount sums and
their non-NULL counts).  From them come the questions A1, B1, C2, C4, E1 (daily),
D2 (agents) and B4 (hours), and the filter panels.

All are plain ``groupBy`` aggregates with partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.functions import sla
from queuelens.plans import queries as Q
from queuelens.plans.model import Star

MART_KEYS = ["day", "category_id", "channel_id", "is_incident_day", "status", "sla_breached"]
CAUSE_KEYS = ["day", "category_id", "channel_id", "is_incident_day", "root_cause"]


def build_mart(fact: DataFrame) -> DataFrame:
    return _additive(fact, F.to_date("opened_at").alias("day"), *MART_KEYS[1:])


def build_cause_mart(fact: DataFrame) -> DataFrame:
    """Breached tickets with a root cause, by day, category, channel, incident flag and cause."""
    breached = fact.where((F.col("sla_breached") == 1) & F.col("root_cause").isNotNull())
    return breached.groupBy(F.to_date("opened_at").alias("day"), *CAUSE_KEYS[1:]).agg(F.count(F.lit(1)).alias("tickets"))


def build_agent_mart(fact: DataFrame) -> DataFrame:
    return _additive(fact, sla.month_key("opened_at").alias("month"), "agent_id", "sla_breached")


def _additive(fact: DataFrame, *keys) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tickets"),
        F.sum(F.col("resolution_hours").cast(Q.HOURS_DEC)).alias("hours_sum"),
        F.count("resolution_hours").alias("hours_n"),
        F.sum(F.col("transaction_amount_inr").cast(Q.HOURS_DEC)).alias("amount_sum"),
        F.count("transaction_amount_inr").alias("amount_n"))


def build_hours_histogram(fact: DataFrame) -> DataFrame:
    return fact.groupBy("status", "resolution_hours").agg(F.count(F.lit(1)).alias("tickets"))


def _measures(mart: DataFrame, keys) -> DataFrame:
    """The same additive measures as :func:`queries.measures`, from the mart."""
    return mart.groupBy(*keys).agg(
        F.sum("tickets").alias("_n"),
        F.sum(F.col("tickets") * F.col("sla_breached")).cast("bigint").alias("_b"),
        F.sum("hours_sum").alias("_hs"), F.sum("hours_n").alias("_hn"),
        F.sum("amount_sum").alias("_as"), F.sum("amount_n").alias("_an"))


def _by_dimension(mart: DataFrame, dim: DataFrame, fk: str, attrs) -> DataFrame:
    return Q.rollup(_measures(mart, [fk]).join(dim.select(fk, *attrs), fk, "inner"), attrs)


def mart_a1_kpis(mart: DataFrame) -> DataFrame:
    def tickets_where(cond):
        return F.sum(F.when(cond, F.col("tickets")).otherwise(0)).cast("bigint")

    return mart.agg(
        F.sum("tickets").cast("bigint").alias("total_tickets"),
        tickets_where(F.col("status") == "Closed").alias("closed_tickets"),
        tickets_where(F.col("status") == "Open").alias("open_tickets"),
        sla.pct(tickets_where(F.col("sla_breached") == 0), F.sum("tickets"), 2).alias("sla_compliance_pct"),
        F.round(F.try_divide(F.sum("hours_sum").cast("double"), F.sum("hours_n").cast("double")), 1)
         .alias("avg_resolution_hours"))


def mart_b1_category(mart: DataFrame, star: Star) -> DataFrame:
    attrs = ["category_name", "category_group", "sla_target_hours"]
    m = _by_dimension(mart, star.dim_category, "category_id", attrs)
    return m.select(*attrs, Q.n_().alias("ticket_count"), Q.avg_hours_of(1).alias("avg_resolution_hours"),
                    Q.breach_pct_of(1).alias("sla_breach_pct"))


def mart_c2_monthly_sla(mart: DataFrame) -> DataFrame:
    m = _measures(mart, [F.date_format("day", "yyyy-MM").alias("month")])
    return m.select("month", Q.n_().alias("ticket_count"), Q.compliance_pct_of(1).alias("sla_compliance_pct"))


def mart_c4_salary_window(mart: DataFrame) -> DataFrame:
    days = mart.groupBy(sla.salary_period("day").alias("period"), "day").agg(F.sum("tickets").alias("_n"))
    r = days.groupBy("period").agg(F.count(F.lit(1)).alias("days_counted"), F.sum("_n").alias("_n"))
    return r.select("period", Q.n_().alias("ticket_count"), Q.tickets_per_day(1).alias("avg_tickets_per_day"))


def mart_d2_team(agents: DataFrame, star: Star) -> DataFrame:
    m = _by_dimension(agents, star.dim_agent, "agent_id", ["team"])
    return m.select("team", Q.n_().alias("ticket_count"), Q.avg_hours_of(1).alias("avg_resolution_hours"),
                    Q.breach_pct_of(1).alias("sla_breach_pct"))


def mart_e1_incident_volume(mart: DataFrame) -> DataFrame:
    days = mart.groupBy("is_incident_day", "day").agg(F.sum("tickets").alias("_n"))
    r = days.groupBy("is_incident_day").agg(F.count(F.lit(1)).alias("days_counted"), F.sum("_n").alias("_n"))
    return r.select("is_incident_day", "days_counted", Q.n_().alias("total_tickets"),
                    Q.tickets_per_day(1).alias("avg_tickets_per_day"))


def hist_b4_buckets(hist: DataFrame) -> DataFrame:
    c = hist.filter(F.col("status") == "Closed")
    return (c.groupBy(sla.resolution_bucket("resolution_hours").alias("resolution_bucket"))
            .agg(F.sum("tickets").alias("ticket_count"), F.min("resolution_hours").alias("_lo"))
            .transform(Q.sorted_small("_lo")).drop("_lo"))


# ------------------------------------------------ filter panels from the mart

def mart_enriched(mart: DataFrame, star: Star) -> DataFrame:
    """The mart with category and channel names attached (two small joins over
    mart rows, not tickets)."""
    from queuelens.operators.joins import join_dim

    m = join_dim(mart, star.dim_category.select("category_id", "category_name"), "category_id")
    return join_dim(m, star.dim_channel.select("channel_id", "channel_name"), "channel_id")


def mart_filter(menr: DataFrame, f) -> DataFrame:
    """``t_filter`` semantics on mart rows (the day key replaces to_date(opened_at))."""
    cond = F.lit(True)
    if f.start is not None and f.end is not None:
        cond = cond & (F.col("day") >= F.lit(f.start)) & (F.col("day") <= F.lit(f.end))
    if f.categories is not None:
        cond = cond & (F.col("category_name").isin(*f.categories) if f.categories else F.lit(False))
    if f.channels is not None:
        cond = cond & (F.col("channel_name").isin(*f.channels) if f.channels else F.lit(False))
    if f.incident_only:
        cond = cond & (F.col("is_incident_day") == 1)
    return menr.filter(cond)


def _tw(cond):
    return F.sum(F.when(cond, F.col("tickets")).otherwise(0))


def mart_t_kpis(fm: DataFrame) -> DataFrame:
    n = F.sum("tickets")
    closed = F.col("status") == "Closed"
    hs = F.sum(F.when(closed, F.col("hours_sum")))
    hn = F.sum(F.when(closed, F.col("hours_n")))
    return fm.agg(
        F.coalesce(n, F.lit(0)).cast("bigint").alias("total_tickets"),
        F.coalesce(F.lit(100.0) * (F.lit(1.0) - F.try_divide(_tw(F.col("sla_breached") == 1).cast("double"),
                                                             n.cast("double"))), F.lit(0.0))
         .alias("sla_compliance_pct"),
        F.when(F.coalesce(_tw(closed), F.lit(0)) == 0, F.lit(0.0))
         .otherwise(F.try_divide(hs.cast("double"), hn.cast("double"))).alias("avg_resolution_hours"),
        F.coalesce(_tw(F.col("status") == "Open"), F.lit(0)).cast("bigint").alias("open_tickets"),
        F.coalesce(F.sum("amount_sum").cast("double"), F.lit(0.0)).alias("disputed_value_inr"))


def mart_t_category(fm: DataFrame) -> DataFrame:
    return (fm.groupBy("category_name")
            .agg(F.sum("tickets").alias("tickets"),
                 (F.lit(100.0) * (_tw(F.col("sla_breached") == 1).cast("double")
                                  / F.sum("tickets").cast("double"))).alias("sla_breach_pct"))
            .transform(Q.sorted_small(F.desc("sla_breach_pct"), "category_name")))


def mart_t_monthly(fm: DataFrame) -> DataFrame:
    return (fm.groupBy(F.date_format("day", "yyyy-MM").alias("month"))
            .agg(F.sum("tickets").alias("tickets"),
                 (F.lit(100.0) * (F.lit(1.0) - _tw(F.col("sla_breached") == 1).cast("double")
                                  / F.sum("tickets").cast("double"))).alias("sla_compliance_pct"))
            .transform(Q.sorted_small("month")))


def mart_t_channel_counts(fm: DataFrame) -> DataFrame:
    return fm.groupBy("channel_name").agg(F.sum("tickets").alias("tickets"))


def mart_t_root_causes8(fc: DataFrame, k: int = 8) -> DataFrame:
    """From the filtered cause mart."""
    return (fc.groupBy("root_cause").agg(F.sum("tickets").alias("breached_tickets"))
            .orderBy(F.desc("breached_tickets"), "root_cause").limit(k))


def mart_t_match_count(fm: DataFrame) -> DataFrame:
    return fm.agg(F.coalesce(F.sum("tickets"), F.lit(0)).cast("bigint").alias("matching_tickets"))


def mart_panels(daily: DataFrame, causes: DataFrame, f) -> dict[str, DataFrame]:
    """The six panels of a selection from the written marts (names attached)."""
    fm, fc = mart_filter(daily, f), mart_filter(causes, f)
    return {"kpis": mart_t_kpis(fm), "category": mart_t_category(fm), "monthly": mart_t_monthly(fm),
            "channel_counts": mart_t_channel_counts(fm), "root_causes": mart_t_root_causes8(fc), "match_count": mart_t_match_count(fm)}
