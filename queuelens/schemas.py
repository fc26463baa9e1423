"""Typed star schema (sc_star) and the raw export layout.

The fact keeps the 14 columns of the cleaned export in their fixed order;
timestamps are wall clock without a zone, hence TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DIM_CATEGORY = T.StructType([
    T.StructField("category_id", T.IntegerType(), False),
    T.StructField("category_name", T.StringType(), False),
    T.StructField("category_group", T.StringType(), False),
    T.StructField("sla_target_hours", T.IntegerType(), False),
])

DIM_CHANNEL = T.StructType([
    T.StructField("channel_id", T.IntegerType(), False),
    T.StructField("channel_name", T.StringType(), False),
])

DIM_AGENT = T.StructType([
    T.StructField("agent_id", T.IntegerType(), False),
    T.StructField("agent_name", T.StringType(), False),
    T.StructField("team", T.StringType(), False),
])

FACT = T.StructType([
    T.StructField("ticket_id", T.LongType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("category_id", T.IntegerType(), False),
    T.StructField("channel_id", T.IntegerType(), False),
    T.StructField("agent_id", T.IntegerType(), True),
    T.StructField("transaction_amount_inr", T.DoubleType(), True),
    T.StructField("opened_at", T.TimestampNTZType(), False),
    T.StructField("closed_at", T.TimestampNTZType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("resolution_hours", T.DoubleType(), True),
    T.StructField("sla_target_hours", T.IntegerType(), False),
    T.StructField("sla_breached", T.IntegerType(), False),
    T.StructField("root_cause", T.StringType(), True),
    T.StructField("is_incident_day", T.IntegerType(), False),
])

FACT_COLUMNS = [f.name for f in FACT.fields]

# Raw export: the same 14 columns, every field read as text (timestamps come
# in several layouts, agent ids as floats, customer ids dirty), plus the
# ingest sequence the export carries so keep-first is well defined.
RAW_FACT = T.StructType(
    [T.StructField("ingest_seq", T.LongType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in FACT_COLUMNS]
)

# The place of a record in the ingest order, compared field by field: its number, or where it lies.
INGEST_ORDER = T.StructType([
    T.StructField("seq", T.LongType(), True),
    T.StructField("file_time", T.TimestampType(), True),
    T.StructField("path", T.StringType(), True),
    T.StructField("block", T.LongType(), True),
    T.StructField("line", T.LongType(), True),
])

# One rule for every CSV reader and writer: a quote inside a quoted field is doubled.
CSV_QUOTES = {"quote": '"', "escape": '"'}

RAW_COLUMNS = [f.name for f in RAW_FACT.fields]

# The wide detail model, fact joined to its three dimensions.
ENRICHED_COLUMNS = [
    "ticket_id", "customer_id", "category_name", "category_group",
    "channel_name", "agent_name", "team", "transaction_amount_inr",
    "opened_at", "closed_at", "status", "resolution_hours",
    "sla_target_hours", "sla_breached", "root_cause", "is_incident_day",
]

# Drill-through / CSV export columns.
DETAIL_COLUMNS = [
    "ticket_id", "customer_id", "category_name", "channel_name", "team",
    "agent_name", "opened_at", "status", "resolution_hours",
    "sla_target_hours", "sla_breached", "root_cause",
]

STAR = {
    "fact_complaints": FACT,
    "dim_category": DIM_CATEGORY,
    "dim_channel": DIM_CHANNEL,
    "dim_agent": DIM_AGENT,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project, order and cast ``df`` to ``schema`` (by name).

    ``DataFrame.to`` reorders and up-casts safely; nullability of the
    declared schema is checked separately by the quality gate.
    """
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return df.to(nullable)
