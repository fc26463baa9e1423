"""Report metrics (r_*): the computed facts behind the root-cause write-up.

All of them start from small aggregates; windows here run over a handful
of aggregated rows, never over tickets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queuelens.functions import sla
from queuelens.plans import queries as Q
from queuelens.plans.model import Star

# The compliance target the report measures against (percent).
SLA_TARGET_PCT = 90.0


def r_avg_vs_target(star: Star) -> DataFrame:
    """Mean resolution per category next to its target, and their ratio."""
    attrs = ["category_name", "category_group", "sla_target_hours"]
    m = Q.by_dimension(star.fact, star.dim_category, "category_id", attrs)
    avg = Q.avg_hours_of(None)
    return m.select(*attrs, Q.avg_hours_of(1).alias("avg_resolution_hours"),
                    F.round(avg - F.col("sla_target_hours"), 1).alias("hours_over_target"),
                    F.round(F.try_divide(avg, F.col("sla_target_hours").cast("double")), 3)
                    .alias("avg_to_target_ratio"))


def r_group_top_cause(star: Star) -> DataFrame:
    """Largest breached root cause inside each category group."""
    b = star.fact.filter((F.col("sla_breached") == 1) & F.col("root_cause").isNotNull())
    per = (b.groupBy("category_id", "root_cause").agg(F.count(F.lit(1)).alias("_n"))
           .join(star.dim_category.select("category_id", "category_group"), "category_id")
           .groupBy("category_group", "root_cause").agg(F.sum("_n").cast("bigint").alias("breached_tickets")))
    w = Window.partitionBy("category_group").orderBy(F.desc("breached_tickets"), "root_cause")
    return per.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def r_group_share(star: Star) -> DataFrame:
    """Each category group's tickets and share of all tickets."""
    m = Q.by_dimension(star.fact, star.dim_category, "category_id", ["category_group"])
    total = F.sum("_n").over(Window.partitionBy())  # over the few group rows only
    return m.select("category_group", Q.n_().alias("ticket_count"),
                    F.round(F.lit(100.0) * F.col("_n") / total, 1).alias("share_pct"))


def r_top4_sum(star: Star) -> DataFrame:
    """Breached tickets in the four largest root causes together."""
    return Q.q_b3_root_causes(star, k=4).agg(
        F.sum("breached_tickets").cast("bigint").alias("top4_breached_tickets"),
        F.count(F.lit(1)).alias("causes_counted"))


def r_unassigned_vs_team(star: Star) -> DataFrame:
    """Per team (Unassigned included): share of tickets and breach rate."""
    m = Q.by_dimension(star.fact, star.dim_agent, "agent_id", ["team"])
    total = F.sum("_n").over(Window.partitionBy())
    return m.select("team", Q.n_().alias("ticket_count"),
                    F.round(F.lit(100.0) * F.col("_n") / total, 1).alias("share_pct"),
                    Q.breach_pct_of(1).alias("sla_breach_pct"))


def _pivot_rates(r: DataFrame, key: str, on_value, off_value) -> DataFrame:
    """One row: per-day rates for two labels, from the (label -> n, days) table."""
    rate = F.col("_n").cast("double") / F.col("days_counted").cast("double")
    return r.agg(
        F.max(F.when(F.col(key) == on_value, rate)).alias("_on"),
        F.max(F.when(F.col(key) == off_value, rate)).alias("_off"),
        F.max(F.when(F.col(key) == on_value, Q.breach_pct_of(None))).alias("_on_b"),
        F.max(F.when(F.col(key) == off_value, Q.breach_pct_of(None))).alias("_off_b"))


def r_salary_lift(star: Star) -> DataFrame:
    """Salary-window tickets/day over the rest of the month."""
    r = Q.per_day_rate(star.fact, sla.salary_period("opened_at"), "period")
    p = _pivot_rates(r, "period", sla.SALARY_LABEL, sla.REST_LABEL)
    return p.select(F.round("_on", 1).alias("salary_window_per_day"),
                    F.round("_off", 1).alias("rest_of_month_per_day"),
                    F.round(F.lit(100.0) * (F.try_divide(F.col("_on"), F.col("_off")) - 1), 1)
                    .alias("lift_pct"))


def r_incident_lift(star: Star) -> DataFrame:
    """Incident vs normal days: tickets/day, their ratio, and breach rates."""
    r = Q.per_day_rate(star.fact, F.col("is_incident_day"), "is_incident_day")
    p = _pivot_rates(r, "is_incident_day", 1, 0)
    return p.select(F.round("_on", 1).alias("incident_per_day"),
                    F.round("_off", 1).alias("normal_per_day"),
                    F.round(F.try_divide(F.col("_on"), F.col("_off")), 2).alias("volume_ratio"),
                    F.round("_on_b", 1).alias("incident_breach_pct"),
                    F.round("_off_b", 1).alias("normal_breach_pct"))


def r_target_gap(star: Star, target_pct: float = SLA_TARGET_PCT) -> DataFrame:
    """Overall compliance against the target, in percentage points."""
    c = sla.compliance_pct(digits=None)
    return star.fact.agg(F.round(c, 1).alias("sla_compliance_pct"),
                         F.lit(float(target_pct)).alias("target_pct"),
                         F.round(F.lit(float(target_pct)) - c, 1).alias("gap_pct_points"),
                         (c >= F.lit(float(target_pct))).cast("int").alias("meets_target"))
