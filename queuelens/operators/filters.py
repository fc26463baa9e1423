"""Interactive filter and drill-through surface (t_*).

``t_filter`` turns widget state into one predicate over the enriched detail;
every panel is then an aggregate of the filtered frame, so only small
results ever reach the driver.  When the detail still carries the fact's
``opened_month`` partition column, the date range is also stated on it, so a
written star prunes whole month directories (Spark does not derive a
partition predicate from one on ``opened_at``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.functions import sla
from queuelens.operators import joins
from queuelens.plans.model import Star
from queuelens.plans.queries import sorted_small
from queuelens.schemas import DETAIL_COLUMNS, ENRICHED_COLUMNS


@dataclass(frozen=True)
class TicketFilter:
    """Widget state.  ``None`` for a list means "all" (the default selection);
    an empty list selects nothing.  A range with a missing end falls back to
    the full bounds."""
    start: _dt.date | None = None
    end: _dt.date | None = None
    categories: Sequence[str] | None = None
    channels: Sequence[str] | None = None
    incident_only: bool = False


def t_load(star: Star) -> DataFrame:
    """t_load: the enriched detail (plus ``opened_month`` when the fact has it)."""
    extra = ["opened_month"] if "opened_month" in star.fact.columns else []
    df = t_panel(star)
    df = joins.join_agent(df, star.dim_agent.select("agent_id", "agent_name", "team"))
    return df.select(*ENRICHED_COLUMNS, *extra)


def t_panel(star: Star) -> DataFrame:
    """What the panels read: the fact with category and channel names.

    No panel shows an agent, so the agent dimension, which grows with the data
    and has one very frequent member, stays out; that every ticket has an agent
    member is what the foreign-key gate of the star job has checked."""
    cat = star.dim_category.select("category_id", "category_name", "category_group")
    df = joins.join_dim(star.fact, cat, "category_id")
    return joins.join_dim(df, star.dim_channel.select("channel_id", "channel_name"), "channel_id")


def t_bounds(fact: DataFrame) -> DataFrame:
    """t_bounds: first and last opening date (the date widget's limits); one scan of one column."""
    d = F.to_date("opened_at")
    return fact.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))


def t_distinct_lists(star: Star) -> DataFrame:
    """t_distinct_lists: sorted distinct category and channel names in use (long form).

    The fact is first reduced to its distinct (category, channel) pairs."""
    pairs = star.fact.select("category_id", "channel_id").distinct()
    named = (pairs.join(star.dim_category.select("category_id", "category_name"), "category_id")
             .join(star.dim_channel.select("channel_id", "channel_name"), "channel_id"))
    both = F.array(F.struct(F.lit("category").alias("list_name"), F.col("category_name").alias("value")),
                   F.struct(F.lit("channel").alias("list_name"), F.col("channel_name").alias("value")))
    return named.select(F.explode(both).alias("x")).select("x.*").distinct().transform(sorted_small("list_name", "value"))


def t_filter(df: DataFrame, f: TicketFilter) -> DataFrame:
    """t_filter: inclusive date range AND category IN AND channel IN AND
    (optionally) incident days only."""
    cond = F.lit(True)
    if f.start is not None and f.end is not None:
        d = F.to_date("opened_at")
        cond = cond & (d >= F.lit(f.start)) & (d <= F.lit(f.end))
        if "opened_month" in df.columns:
            cond = cond & F.col("opened_month").between(f.start.strftime("%Y-%m"), f.end.strftime("%Y-%m"))
    if f.categories is not None:
        cond = cond & (F.col("category_name").isin(*f.categories) if f.categories else F.lit(False))
    if f.channels is not None:
        cond = cond & (F.col("channel_name").isin(*f.channels) if f.channels else F.lit(False))
    if f.incident_only:
        cond = cond & (F.col("is_incident_day") == 1)
    return df.filter(cond)


def t_kpis(fdf: DataFrame) -> DataFrame:
    """t_kpis: count, compliance 100*(1-mean breach), mean hours of Closed tickets,
    open count, amount sum -- unrounded; 0 instead of NULL on an empty selection
    (mean hours: 0 when no ticket is closed, NULL when none of them has hours)."""
    closed = F.col("status") == "Closed"
    n = F.count(F.lit(1))
    hours_closed = F.when(closed, F.col("resolution_hours"))
    return fdf.agg(
        n.alias("total_tickets"),
        F.coalesce(F.lit(100.0) * (F.lit(1.0) - F.try_divide(F.sum("sla_breached").cast("double"),
                                                             n.cast("double"))), F.lit(0.0))
         .alias("sla_compliance_pct"),
        # 0 only when nothing is closed; closed tickets without hours give NULL
        F.when(F.count_if(closed) == 0, F.lit(0.0)).otherwise(sla.exact_mean(hours_closed, None))
         .alias("avg_resolution_hours"),
        F.count_if(F.col("status") == "Open").alias("open_tickets"),
        F.coalesce(sla.exact_sum("transaction_amount_inr"), F.lit(0.0)).alias("disputed_value_inr"),
    )


def _mean_pct(col: str, complement: bool = False) -> F.Column:
    m = F.sum(col).cast("double") / F.count(F.lit(1)).cast("double")
    return F.lit(100.0) * ((F.lit(1.0) - m) if complement else m)


def t_category(fdf: DataFrame) -> DataFrame:
    """t_category: tickets and 100*mean(breach) per category (unrounded), worst first."""
    return (fdf.groupBy("category_name")
            .agg(F.count(F.lit(1)).alias("tickets"), _mean_pct("sla_breached").alias("sla_breach_pct"))
            .transform(sorted_small(F.desc("sla_breach_pct"), "category_name")))


def t_monthly(fdf: DataFrame) -> DataFrame:
    """t_monthly: tickets and 100*(1-mean(breach)) per month (unrounded)."""
    return (fdf.groupBy(sla.month_key("opened_at").alias("month"))
            .agg(F.count(F.lit(1)).alias("tickets"),
                 _mean_pct("sla_breached", complement=True).alias("sla_compliance_pct"))
            .transform(sorted_small("month")))


def t_channel_counts(fdf: DataFrame) -> DataFrame:
    """t_channel_counts: tickets per channel."""
    return fdf.groupBy("channel_name").agg(F.count(F.lit(1)).alias("tickets"))


def t_root_causes8(fdf: DataFrame, k: int = 8) -> DataFrame:
    """t_root_causes8: top-k root causes of breached tickets (NULL causes dropped)."""
    b = fdf.filter((F.col("sla_breached") == 1) & F.col("root_cause").isNotNull())
    return (b.groupBy("root_cause").agg(F.count(F.lit(1)).alias("breached_tickets"))
            .orderBy(F.desc("breached_tickets"), "root_cause").limit(k))


def t_drill(fdf: DataFrame) -> DataFrame:
    """t_drill: the 12-column detail, newest first (ticket id breaks ties)."""
    return fdf.select(*DETAIL_COLUMNS).orderBy(F.desc("opened_at"), "ticket_id")


def t_match_count(fdf: DataFrame) -> DataFrame:
    """t_match_count: number of tickets matching the current filters."""
    return fdf.agg(F.count(F.lit(1)).alias("matching_tickets"))


# ------------------------------------------------- all panels from one scan

# What the panels group by, each on its own.
CUBE_KEYS = ("category_name", "month", "channel_name", "root_cause")


def panel_cube(fdf: DataFrame) -> DataFrame:
    """Every panel's sums in one pass over the filtered rows, by grouping sets: all rows, and by each of ``CUBE_KEYS`` alone.

    Columns: ``panel`` (the key grouped by, ``all`` for none), the keys, and
    additive measures.  Five small groups a row are pre-aggregated in the task
    that scans it, so little is shuffled; the result has a row for each value
    of each key.
    """
    closed = F.col("status") == "Closed"
    hours = F.when(closed, F.col("resolution_hours"))
    rows = fdf.select("category_name", sla.month_key("opened_at").alias("month"), "channel_name", "root_cause", "sla_breached", "status",
                      hours.alias("hours"), "transaction_amount_inr")
    sets = [[], *[[F.col(k)] for k in CUBE_KEYS]]
    cube = rows.groupingSets(sets, *CUBE_KEYS).agg(
        F.grouping_id(*CUBE_KEYS).alias("gid"),
        F.count(F.lit(1)).alias("tickets"), F.sum("sla_breached").cast("bigint").alias("breached"),
        F.count_if(F.col("status") == "Open").alias("open"), F.count_if(F.col("status") == "Closed").alias("closed"),
        F.count("hours").alias("hours_n"), sla.exact_sum("hours").alias("hours_sum"),
        sla.exact_sum("transaction_amount_inr").alias("amount"))
    panel = F.lit("all")
    for i, k in enumerate(CUBE_KEYS):   # grouping_id: a bit for each key left out, the first key's the highest
        panel = F.when(F.col("gid") == (2 ** len(CUBE_KEYS) - 1 - 2 ** (len(CUBE_KEYS) - 1 - i)), F.lit(k)).otherwise(panel)
    return cube.withColumn("panel", panel).drop("gid")


def panels_of(cube: DataFrame) -> dict[str, DataFrame]:
    """The six panels (the values of ``t_kpis`` ... ``t_match_count``) from a :func:`panel_cube`, written or not."""
    def part(name: str) -> DataFrame:
        return cube.where(F.col("panel") == name)

    share = F.col("breached").cast("double") / F.col("tickets").cast("double")
    # grouping sets give no row at all for an empty selection; its panels are zeros, as with a plain aggregate
    counts = ("tickets", "breached", "open", "closed", "hours_n")
    whole = part("all").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts], *[F.sum(c).alias(c) for c in ("hours_sum", "amount")])
    kpis = whole.select(
        F.col("tickets").alias("total_tickets"),
        F.coalesce(F.lit(100.0) * (F.lit(1.0) - F.try_divide(F.col("breached").cast("double"), F.col("tickets").cast("double"))), F.lit(0.0)).alias("sla_compliance_pct"),
        F.when(F.col("closed") == 0, F.lit(0.0)).otherwise(F.try_divide("hours_sum", F.col("hours_n").cast("double"))).alias("avg_resolution_hours"),
        F.col("open").alias("open_tickets"), F.coalesce("amount", F.lit(0.0)).alias("disputed_value_inr"))
    causes = part("root_cause").where("root_cause is not null and breached > 0")
    return {
        "kpis": kpis,
        "category": part("category_name").select("category_name", "tickets", (F.lit(100.0) * share).alias("sla_breach_pct"))
                    .transform(sorted_small(F.desc("sla_breach_pct"), "category_name")),
        "monthly": part("month").select("month", "tickets", (F.lit(100.0) * (F.lit(1.0) - share)).alias("sla_compliance_pct"))
                   .transform(sorted_small("month")),
        "channel_counts": part("channel_name").select("channel_name", "tickets"),
        "root_causes": causes.select("root_cause", F.col("breached").alias("breached_tickets")).orderBy(F.desc("breached_tickets"), "root_cause").limit(8),
        "match_count": whole.select(F.col("tickets").alias("matching_tickets")),
    }
