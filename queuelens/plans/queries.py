"""The 19 analytical questions (q_a1 .. q_e3).

Plan shape used throughout: aggregate the fact on the dimension's foreign
key first (partial aggregation on the map side, so only one row per key per
task is shuffled), join that small aggregate to the dimension, then roll up
to the dimension attributes.  The fact itself is never shuffled for a join.
Additive measures (counts, DECIMAL sums) make the roll-up exact; ratios are
taken at the very end.

Ties before a LIMIT are broken by name ascending, so results are unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queuelens.functions import sla
from queuelens.operators.median import upper_median
from queuelens.plans.model import Star

HOURS_DEC = "decimal(18,2)"


# ------------------------------------------------------------ building blocks

def measures(fact: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Additive per-key measures: tickets, breached, hour sum/count, amount sum/count."""
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("sla_breached").cast("bigint").alias("_b"),
        F.sum(F.col("resolution_hours").cast(HOURS_DEC)).alias("_hs"),
        F.count("resolution_hours").alias("_hn"),
        F.sum(F.col("transaction_amount_inr").cast(HOURS_DEC)).alias("_as"),
        F.count("transaction_amount_inr").alias("_an"),
    )


def rollup(m: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Re-aggregate measures to coarser keys (exact: everything is additive)."""
    return m.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("_n", "_b", "_hs", "_hn", "_as", "_an")])


def by_dimension(fact: DataFrame, dim: DataFrame, fk: str, attrs: Sequence[str]) -> DataFrame:
    """Measures per dimension attributes: aggregate on ``fk``, join, roll up."""
    m = measures(fact, [fk])
    return rollup(m.join(dim.select(fk, *attrs), fk, "inner"), attrs)


def n_(c: str = "_n") -> Column:
    return F.col(c).cast("bigint")


def breach_pct_of(digits: int | None = 1) -> Column:
    return sla.pct(F.col("_b"), F.col("_n"), digits)


def compliance_pct_of(digits: int | None = 1) -> Column:
    return sla.pct(F.col("_n") - F.col("_b"), F.col("_n"), digits)


def avg_hours_of(digits: int | None = 1) -> Column:
    v = F.try_divide(F.col("_hs").cast("double"), F.col("_hn").cast("double"))
    return F.round(v, digits) if digits is not None else v


def amount_sum_of(digits: int | None = 2) -> Column:
    v = F.col("_as").cast("double")
    return F.round(v, digits) if digits is not None else v


def sorted_small(*cols):
    """ORDER BY for a result whose size is bounded by a dimension (a handful of
    categories, channels, teams, months, buckets), for ``DataFrame.transform``.
    The rows meet in one partition and are sorted there: the same work as a
    global sort minus the range-bounds sampling job, which costs more than
    the sort itself.  Unbounded results (detail rows) keep ``orderBy``."""
    return lambda df: df.repartition(1).sortWithinPartitions(*cols)


# ------------------------------------------------------------ A: overall KPIs

def q_a1_kpis(star: Star) -> DataFrame:
    f = star.fact
    return f.agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.count_if(F.col("status") == "Closed").alias("closed_tickets"),
        F.count_if(F.col("status") == "Open").alias("open_tickets"),
        sla.compliance_pct(digits=2).alias("sla_compliance_pct"),
        sla.exact_mean("resolution_hours", 1).alias("avg_resolution_hours"),
    )


def q_a2_mean_median(star: Star) -> DataFrame:
    """Mean (1 dp) and upper median of resolution hours, from one histogram pass."""
    return upper_median(star.fact, "resolution_hours", "median_resolution_hours",
                        mean_col="mean_resolution_hours", mean_digits=1)


def q_a3_value(star: Star) -> DataFrame:
    return star.fact.agg(
        F.round(sla.exact_sum("transaction_amount_inr"), 2).alias("total_disputed_value_inr"),
        sla.exact_mean("transaction_amount_inr", 2).alias("avg_transaction_value_inr"),
    )


# ------------------------------------------------------------ B: SLA breaches

def q_b1_category(star: Star) -> DataFrame:
    attrs = ["category_name", "category_group", "sla_target_hours"]
    m = by_dimension(star.fact, star.dim_category, "category_id", attrs)
    return m.select(*attrs, n_().alias("ticket_count"),
                    avg_hours_of(1).alias("avg_resolution_hours"),
                    breach_pct_of(1).alias("sla_breach_pct")) \
        .transform(sorted_small(F.desc("sla_breach_pct"), "category_name"))


def q_b2_group(star: Star) -> DataFrame:
    m = by_dimension(star.fact, star.dim_category, "category_id", ["category_group"])
    return m.select("category_group", n_().alias("ticket_count"),
                    breach_pct_of(1).alias("sla_breach_pct")) \
        .transform(sorted_small(F.desc("sla_breach_pct"), "category_group"))


def q_b3_root_causes(star: Star, k: int = 10) -> DataFrame:
    f = star.fact.filter((F.col("sla_breached") == 1) & F.col("root_cause").isNotNull())
    return (f.groupBy("root_cause").agg(F.count(F.lit(1)).alias("breached_tickets"))
            .orderBy(F.desc("breached_tickets"), "root_cause").limit(k))


def q_b4_buckets(star: Star) -> DataFrame:
    f = star.fact.filter(F.col("status") == "Closed")
    return (f.groupBy(sla.resolution_bucket("resolution_hours").alias("resolution_bucket"))
            .agg(F.count(F.lit(1)).alias("ticket_count"), F.min("resolution_hours").alias("_lo"))
            .transform(sorted_small("_lo")).drop("_lo"))


def q_b5_value_at_risk(star: Star) -> DataFrame:
    breached = star.fact.filter(F.col("sla_breached") == 1)
    m = by_dimension(breached, star.dim_category, "category_id", ["category_group"])
    return m.select("category_group", n_().alias("breached_tickets"),
                    amount_sum_of(2).alias("disputed_value_inr")) \
        .transform(sorted_small(F.desc("disputed_value_inr"), "category_group"))


# ------------------------------------------------------------ C: volume, trend

def q_c1_monthly(star: Star) -> DataFrame:
    return (star.fact.groupBy(sla.month_key("opened_at").alias("month"))
            .agg(F.count(F.lit(1)).alias("ticket_count")).transform(sorted_small("month")))


def q_c2_monthly_sla(star: Star) -> DataFrame:
    m = measures(star.fact, [sla.month_key("opened_at").alias("month")])
    return m.select("month", n_().alias("ticket_count"),
                    compliance_pct_of(1).alias("sla_compliance_pct")).transform(sorted_small("month"))


def q_c3_weekday(star: Star) -> DataFrame:
    d = sla.weekday_sunday0("opened_at").alias("_dow")
    return (star.fact.groupBy(d).agg(F.count(F.lit(1)).alias("ticket_count"))
            .transform(sorted_small("_dow")).select(sla.weekday_name(F.col("_dow")).alias("day_of_week"), "ticket_count"))


def per_day_rate(fact: DataFrame, label: Column, label_name: str) -> DataFrame:
    """Tickets and distinct opening days per label: a two-level aggregate
    (label, day) -> label, i.e. COUNT(DISTINCT date) without a global set."""
    days = fact.groupBy(label.alias(label_name), F.to_date("opened_at").alias("_day")) \
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("sla_breached").cast("bigint").alias("_b"))
    return days.groupBy(label_name).agg(
        F.count(F.lit(1)).alias("days_counted"),
        F.sum("_n").cast("bigint").alias("_n"),
        F.sum("_b").cast("bigint").alias("_b"))


def tickets_per_day(digits: int | None = 1) -> Column:
    v = F.try_divide(F.col("_n").cast("double"), F.col("days_counted").cast("double"))
    return F.round(v, digits) if digits is not None else v


def q_c4_salary_window(star: Star) -> DataFrame:
    r = per_day_rate(star.fact, sla.salary_period("opened_at"), "period")
    return r.select("period", n_().alias("ticket_count"),
                    tickets_per_day(1).alias("avg_tickets_per_day"))


# ------------------------------------------------------------ D: channel, agents

def q_d1_channel(star: Star) -> DataFrame:
    m = by_dimension(star.fact, star.dim_channel, "channel_id", ["channel_name"])
    return m.select("channel_name", n_().alias("ticket_count"),
                    breach_pct_of(1).alias("sla_breach_pct")) \
        .transform(sorted_small(F.desc("sla_breach_pct"), "channel_name"))


def q_d2_team(star: Star) -> DataFrame:
    m = by_dimension(star.fact, star.dim_agent, "agent_id", ["team"])
    return m.select("team", n_().alias("ticket_count"),
                    avg_hours_of(1).alias("avg_resolution_hours"),
                    breach_pct_of(1).alias("sla_breach_pct")) \
        .transform(sorted_small(F.desc("sla_breach_pct"), "team"))


def q_d3_top_agents(star: Star, k: int = 5) -> DataFrame:
    f = star.fact.filter(F.col("agent_id") != -1)
    m = by_dimension(f, star.dim_agent.filter(F.col("agent_id") != -1), "agent_id",
                     ["agent_name", "team"])
    return m.select("agent_name", "team", n_().alias("tickets_handled"),
                    breach_pct_of(1).alias("sla_breach_pct")) \
        .orderBy(F.desc("tickets_handled"), "agent_name", "team").limit(k)


def q_d4_unassigned(star: Star) -> DataFrame:
    return star.fact.agg(F.count_if(F.col("agent_id") == -1).alias("unassigned_tickets"))


# ------------------------------------------------------------ E: incident days

def q_e1_incident_volume(star: Star) -> DataFrame:
    r = per_day_rate(star.fact, F.col("is_incident_day"), "is_incident_day")
    return r.select("is_incident_day", "days_counted", n_().alias("total_tickets"),
                    tickets_per_day(1).alias("avg_tickets_per_day"))


def q_e2_incident_categories(star: Star, k: int = 5) -> DataFrame:
    f = star.fact.filter(F.col("is_incident_day") == 1)
    m = by_dimension(f, star.dim_category, "category_id", ["category_name"])
    return m.select("category_name", n_().alias("tickets_on_incident_days")) \
        .orderBy(F.desc("tickets_on_incident_days"), "category_name").limit(k)


def q_e3_incident_sla(star: Star) -> DataFrame:
    m = measures(star.fact, ["is_incident_day"])
    return m.select("is_incident_day", n_().alias("ticket_count"),
                    breach_pct_of(1).alias("sla_breach_pct"))


QUERIES = {
    "q_a1_kpis": q_a1_kpis,
    "q_a2_mean_median": q_a2_mean_median,
    "q_a3_value": q_a3_value,
    "q_b1_category": q_b1_category,
    "q_b2_group": q_b2_group,
    "q_b3_root_causes": q_b3_root_causes,
    "q_b4_buckets": q_b4_buckets,
    "q_b5_value_at_risk": q_b5_value_at_risk,
    "q_c1_monthly": q_c1_monthly,
    "q_c2_monthly_sla": q_c2_monthly_sla,
    "q_c3_weekday": q_c3_weekday,
    "q_c4_salary_window": q_c4_salary_window,
    "q_d1_channel": q_d1_channel,
    "q_d2_team": q_d2_team,
    "q_d3_top_agents": q_d3_top_agents,
    "q_d4_unassigned": q_d4_unassigned,
    "q_e1_incident_volume": q_e1_incident_volume,
    "q_e2_incident_categories": q_e2_incident_categories,
    "q_e3_incident_sla": q_e3_incident_sla,
}
