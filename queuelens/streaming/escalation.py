"""Escalation rules from the report's recommendations.

* st_at_risk: a ticket with a 24 h SLA still unresolved 18 h after opening
  is flagged before it breaches.
* st_unassigned_escalation: a ticket still without an agent 30 minutes after
  opening goes to the lead queue.

Batch forms evaluate the rule at an ``as_of`` instant over the fact (pure
filters, so they parallelize over the fact and push down to the scan).  The
stream form turns the fact into open/close events and joins them, stream to
stream: an open without a close in its lead time escalates.  Ticks of a
heartbeat let the last tickets of a quiet source escalate as well.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.functions import sla

# The rules' parameters.
AT_RISK_TARGET_HOURS = 24
AT_RISK_LEAD_MINUTES = 18 * 60
UNASSIGNED_LEAD_MINUTES = 30
UNASSIGNED_AGENT_ID = -1
LEAD_QUEUE = "Team lead queue"

TICK = "tick"   # an event that only says how late it is


def _due(opened: F.Column, minutes: int) -> F.Column:
    return F.timestamp_add("MINUTE", F.lit(minutes), opened)


def at_risk(fact: DataFrame, as_of: str | _dt.datetime,
            target_hours: int = AT_RISK_TARGET_HOURS,
            lead_minutes: int = AT_RISK_LEAD_MINUTES) -> DataFrame:
    """Batch st_at_risk: tickets whose escalation instant has passed by
    ``as_of`` while they were still unresolved at that instant."""
    due = _due(F.col("opened_at"), lead_minutes)
    cond = ((F.col("sla_target_hours") == target_hours) & (due <= sla.ts_literal(as_of))
            & (F.col("closed_at").isNull() | (F.col("closed_at") > due)))
    return fact.filter(cond).select("ticket_id", "category_id", "opened_at",
                                    due.alias("escalate_at"), "closed_at", "sla_breached")


def unassigned_escalation(fact: DataFrame, as_of: str | _dt.datetime,
                          lead_minutes: int = UNASSIGNED_LEAD_MINUTES) -> DataFrame:
    """Batch st_unassigned_escalation: unassigned tickets still open at
    opening + lead time (and that instant is not after ``as_of``)."""
    due = _due(F.col("opened_at"), lead_minutes)
    cond = ((F.col("agent_id") == UNASSIGNED_AGENT_ID) & (due <= sla.ts_literal(as_of))
            & (F.col("closed_at").isNull() | (F.col("closed_at") > due)))
    return fact.filter(cond).select("ticket_id", "category_id", "opened_at",
                                    due.alias("escalate_at"), "closed_at",
                                    F.lit(LEAD_QUEUE).alias("routed_to"))


# ------------------------------------------------------------- stream form

def ticket_events(fact: DataFrame) -> DataFrame:
    """Open and close events of each ticket, event time as TIMESTAMP."""
    opened = fact.select("ticket_id", "sla_target_hours", "agent_id",
                         F.lit("open").alias("event"), F.col("opened_at").cast("timestamp").alias("event_time"))
    closed = fact.filter(F.col("closed_at").isNotNull()).select(
        "ticket_id", "sla_target_hours", "agent_id",
        F.lit("close").alias("event"), F.col("closed_at").cast("timestamp").alias("event_time"))
    return opened.unionByName(closed)


def heartbeat(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Ticks of the wall clock as events: they move event time on while the source is silent.

    To be used where event times follow the wall clock; a replay of old files
    takes its ticks from a file stream instead, see :func:`tick`."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return clock.select(*_tick_columns(F.col("timestamp")))


def tick(spark: SparkSession, at: str | _dt.datetime) -> DataFrame:
    """One tick event at the wall-clock instant ``at``, to be written beside the event files."""
    return spark.range(1).select(*_tick_columns(sla.ts_literal(at).cast("timestamp")))


def _tick_columns(when: F.Column) -> list[F.Column]:
    nothing = {c: F.lit(None).cast(t).alias(c) for c, t in (("ticket_id", "long"), ("sla_target_hours", "int"), ("agent_id", "int"))}
    return [*nothing.values(), F.lit(TICK).alias("event"), when.alias("event_time")]


def _only(event: str) -> F.Column:
    """Rows of one kind of event, by a condition that reads the event time: Spark leaves such a filter above the watermark.

    A plain filter on ``event`` would be pushed below it, and ticks would be gone before they count."""
    return F.when(F.col("event") == event, F.col("event_time")).isNotNull()


def escalation_stream(events: DataFrame, lead_minutes: int, watermark_delay: str = "1 hour",
                      ticks: DataFrame | None = None, wanted: F.Column | None = None) -> DataFrame:
    """Stream form: (ticket_id, opened_at, escalate_at) of tickets without a close within the lead time.

    A stream-stream left outer join of opens to the closes between opening and
    opening + lead; an open is emitted without a partner once the watermark has
    passed its escalation instant, so a close that arrives before its open, or
    up to ``watermark_delay`` late, still counts.  State is bounded by lead
    time and delay.

    Every event and tick moves the watermark, also those that ``wanted``
    (a condition on the tickets) leaves out.  ``ticks`` is a stream of tick
    events, such as :func:`heartbeat`; ticks among ``events`` count as well.
    Without any, a quiet source holds its last tickets back."""
    from queuelens.streaming.ingest import use_rocksdb_state

    use_rocksdb_state(events.sparkSession)
    both = events if ticks is None else events.unionByName(ticks)
    timed = both.withWatermark("event_time", watermark_delay)
    mine = F.lit(True) if wanted is None else F.when(wanted, F.col("event_time")).isNotNull()
    opens = timed.filter(_only("open") & mine).select("ticket_id", F.col("event_time").alias("opened_at"))
    closes = timed.filter(_only("close") & mine).select(F.col("ticket_id").alias("closed_ticket"), F.col("event_time").alias("closed_at"))
    lead = F.expr(f"INTERVAL {int(lead_minutes)} MINUTES")
    in_time = ((F.col("ticket_id") == F.col("closed_ticket")) & (F.col("closed_at") >= F.col("opened_at"))
               & (F.col("closed_at") <= F.col("opened_at") + lead))
    return (opens.join(closes, in_time, "left_outer").filter(F.col("closed_ticket").isNull())
            .select("ticket_id", "opened_at", (F.col("opened_at") + lead).alias("escalate_at")))


def at_risk_stream(events: DataFrame, watermark_delay: str = "1 hour",
                   target_hours: int = AT_RISK_TARGET_HOURS,
                   lead_minutes: int = AT_RISK_LEAD_MINUTES, ticks: DataFrame | None = None) -> DataFrame:
    """Stream form of st_at_risk: tickets on the ``target_hours`` SLA without a
    close between opening and opening + lead."""
    return escalation_stream(events, lead_minutes, watermark_delay, ticks, F.col("sla_target_hours") == target_hours)


def unassigned_stream(events: DataFrame, watermark_delay: str = "1 hour", lead_minutes: int = UNASSIGNED_LEAD_MINUTES,
                      ticks: DataFrame | None = None) -> DataFrame:
    """Stream form of st_unassigned_escalation."""
    return escalation_stream(events, lead_minutes, watermark_delay, ticks, F.col("agent_id") == UNASSIGNED_AGENT_ID)
