"""Datasets behind the workbook (x_*), the preview charts (p_*) and the
post-load sanity check (bd_*).  Drawing is out of scope; these are the
tables the drawings are made from.  Most reuse the catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.functions import sla
from queuelens.plans import queries as Q
from queuelens.plans.model import Star


def x_kpis(star: Star) -> DataFrame:
    """Workbook KPI row: A1 with compliance at 1 dp, plus total value at 0 dp."""
    return star.fact.agg(
        F.count(F.lit(1)).alias("total_tickets"),
        F.count_if(F.col("status") == "Closed").alias("closed_tickets"),
        F.count_if(F.col("status") == "Open").alias("open_tickets"),
        sla.compliance_pct(digits=1).alias("sla_compliance_pct"),
        sla.exact_mean("resolution_hours", 1).alias("avg_resolution_hours"),
        F.round(sla.exact_sum("transaction_amount_inr"), 0).alias("total_disputed_value_inr"),
    )


x_category = Q.q_b1_category
x_channel = Q.q_d1_channel
x_monthly = Q.q_c2_monthly_sla


def x_detail(star: Star) -> DataFrame:
    """Wide detail sheet, ordered by opening time (ticket id breaks ties)."""
    return star.enriched().orderBy("opened_at", "ticket_id")


def x_category_chart(star: Star) -> DataFrame:
    """Two-column projection of B1 with display names."""
    return Q.q_b1_category(star).select(F.col("category_name").alias("Category"),
                                        F.col("sla_breach_pct").alias("SLA Breach %"))


def p_kpis(star: Star) -> DataFrame:
    """Preview KPI card: compliance 1 dp, value 0 dp, no closed count."""
    return star.fact.agg(
        F.count(F.lit(1)).alias("total_tickets"),
        sla.compliance_pct(digits=1).alias("sla_compliance_pct"),
        sla.exact_mean("resolution_hours", 1).alias("avg_resolution_hours"),
        F.count_if(F.col("status") == "Open").alias("open_tickets"),
        F.round(sla.exact_sum("transaction_amount_inr"), 0).alias("disputed_value"),
    )


def p_breach_by_category(star: Star) -> DataFrame:
    """Breach % and tickets per category name, ascending (chart order)."""
    m = Q.by_dimension(star.fact, star.dim_category, "category_id", ["category_name"])
    return m.select("category_name", Q.breach_pct_of(1).alias("breach_pct"),
                    Q.n_().alias("tickets")).transform(Q.sorted_small("breach_pct", "category_name"))


def p_monthly(star: Star) -> DataFrame:
    m = Q.measures(star.fact, [sla.month_key("opened_at").alias("month")])
    return m.select("month", Q.n_().alias("tickets"), Q.compliance_pct_of(1).alias("sla_pct")) \
        .transform(Q.sorted_small("month"))


def p_root_causes8(star: Star) -> DataFrame:
    """Top 8 breached root causes, then re-sorted ascending for the bar chart."""
    return Q.q_b3_root_causes(star, k=8).transform(Q.sorted_small("breached_tickets", F.desc("root_cause")))


def p_incident(star: Star) -> DataFrame:
    """Incident vs normal days; the day counts in the labels are computed."""
    r = Q.per_day_rate(star.fact, F.col("is_incident_day"), "is_incident_day")
    label = F.concat(F.when(F.col("is_incident_day") == 1, F.lit("Incident Days ("))
                     .otherwise(F.lit("Normal Days (")), F.col("days_counted").cast("string"), F.lit(")"))
    return r.select(label.alias("day_type"), Q.tickets_per_day(1).alias("avg_tickets_per_day"),
                    Q.breach_pct_of(1).alias("sla_breach_pct"))


def bd_sanity(star: Star) -> DataFrame:
    """Post-load check: tickets, mean hours and breach % per category, worst first."""
    m = Q.by_dimension(star.fact, star.dim_category, "category_id", ["category_name"])
    return m.select("category_name", Q.n_().alias("tickets"),
                    Q.avg_hours_of(1).alias("avg_resolution_hrs"),
                    Q.breach_pct_of(1).alias("sla_breach_pct")) \
        .transform(Q.sorted_small(F.desc("sla_breach_pct"), "category_name"))
