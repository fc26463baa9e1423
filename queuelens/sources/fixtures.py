"""Canonical ticket projection over the driver's TPC-H-like tables.

The reference ships no data, so the test input is a deterministic projection
of ``lineitem`` / ``orders`` / ``customer`` (fact) and ``nation`` / ``region``
/ ``supplier`` / ``orders`` (dimensions).  Integer arithmetic only, so Spark
and the DuckDB oracle agree bit for bit.

Two variants share one definition:

* :func:`clean_fact` - the cleaned fact (first copy per ticket).
* :func:`raw_fact`   - the messy export: every copy kept, timestamps as text
  in rotating layouts, missing agents, dirty customer ids, an ``ingest_seq``.

Plan shape: lineitem is deduplicated (or sequenced) on its own key first --
the ``row_number() = 1`` form gets a map-side ``WindowGroupLimit`` so a hot
group of copies is cut down before the shuffle -- then joined to
orders-with-customer on ``l_orderkey``.  Orders and customers are joined
first because that side is ~4x smaller than lineitem, so the fact is
shuffled once for the join.  Dimensions are derived with aggregates, never
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.functions import sla, timestamps
from queuelens.operators.sequence import sequence_within_key

# Fixed values of the test projection.
AS_OF = "2001-08-01 23:59:59"          # the "now" of open-ticket SLA clocks
OPEN_FROM_DATE = "2001-07-02"          # lines still 'O' on orders from here are open
INCIDENT_DAYS = ("1996-10-14", "1999-01-05", "2001-05-22")
TARGET_HOURS = (24, 48, 72, 96, 120, 168)   # indexed by nationkey % 6
UNASSIGNED_MODULUS = 67                # ticket_id % 67 = 0 -> no agent
DIRTY_CUSTOMER_MODULUS, DIRTY_CUSTOMER_REMAINDER = 100, 7
RES_SECS_MODULUS = 700_000
INGEST_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
                "l_quantity", "l_discount", "l_tax"]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate")
    return li.withColumn("ticket_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the fact's source, from the files' footers."""
    return read_table(spark, sf_dir, "lineitem").count()


def customer_text(custkey: str) -> F.Column:
    """``CUST%06d``; the formatter, which is slow, only where the number has not up to six digits."""
    n = F.col(custkey)
    return (F.when(n.between(0, 999_999), F.concat(F.lit("CUST"), F.lpad(n.cast("string"), 6, "0")))
            .otherwise(F.format_string("CUST%06d", n)))


def _orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").drop("c_custkey")


def channel_number() -> F.Column:
    """The number before the dash of an order priority."""
    return F.substring_index("o_orderpriority", "-", 1).cast("int")


def target_hours(nationkey: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(h) for h in TARGET_HOURS]),
                        (nationkey % len(TARGET_HOURS) + 1).cast("int"))


def _projected(joined: DataFrame) -> DataFrame:
    """Clean ticket values from a lineitem x orders x customer row."""
    opened = F.timestamp_add(
        "SECOND", (F.col("l_partkey") % 1440) * 60 + F.col("l_suppkey") % 60,
        F.col("o_orderdate"))
    res_secs = (F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729
                + F.col("l_linenumber") * 1299709) % RES_SECS_MODULUS
    is_open = (F.col("l_linestatus") == "O") & (
        F.col("o_orderdate") >= sla.ts_literal(OPEN_FROM_DATE + " 00:00:00"))
    status = F.when(is_open, F.lit("Open")).otherwise(F.lit("Closed"))
    t = joined.select(
        "ticket_id", "l_suppkey", *([c for c in ["ingest_seq"] if c in joined.columns]),
        customer_text("o_custkey").alias("customer_id"),
        F.col("c_nationkey").cast("int").alias("category_id"),
        channel_number().alias("channel_id"),
        F.when(F.col("ticket_id") % UNASSIGNED_MODULUS == 0, F.lit(-1))
         .otherwise(F.col("l_suppkey")).cast("int").alias("agent_id"),
        F.col("l_extendedprice").alias("transaction_amount_inr"),
        opened.alias("opened_at"),
        status.alias("status"),
        res_secs.alias("_res_secs"),
        target_hours(F.col("c_nationkey")).alias("sla_target_hours"),
        F.when(~is_open, F.concat_ws("-", "l_returnflag", F.col("l_linenumber").cast("string")))
         .alias("root_cause"),
        F.when(F.to_date("o_orderdate").isin(*[F.lit(d).cast("date") for d in INCIDENT_DAYS]), 1)
         .otherwise(0).alias("is_incident_day"),
    )
    t = t.withColumn("closed_at", F.when(F.col("status") == "Closed",
                                         F.timestamp_add("SECOND", F.col("_res_secs"), F.col("opened_at"))))
    t = t.withColumn("resolution_hours", sla.resolution_hours("status", "opened_at", "closed_at"))
    t = t.withColumn("sla_breached", sla.breach_flag("status", "resolution_hours", "opened_at",
                                                      "sla_target_hours", AS_OF))
    return t


def clean_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned fact: first copy of every ticket, 14 typed columns."""
    from queuelens.schemas import FACT_COLUMNS

    w = Window.partitionBy("ticket_id").orderBy(*INGEST_ORDER)
    first = (_lines(spark, sf_dir).withColumn("_rn", F.row_number().over(w))
             .filter(F.col("_rn") == 1).drop("_rn"))
    joined = first.join(_orders_with_customer(spark, sf_dir),
                        first.l_orderkey == F.col("o_orderkey"), "inner")
    return _projected(joined).select(*FACT_COLUMNS)


def raw_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messy export: all copies, text fields, ``ingest_seq`` per ticket."""
    from queuelens.schemas import RAW_COLUMNS

    seq = sequence_within_key(_lines(spark, sf_dir), ["ticket_id"], INGEST_ORDER, "ingest_seq",
                              F.trunc("l_shipdate", "month"))
    joined = seq.join(_orders_with_customer(spark, sf_dir),
                      seq.l_orderkey == F.col("o_orderkey"), "inner")
    t = _projected(joined)
    tid = F.col("ticket_id")
    dirty = tid % DIRTY_CUSTOMER_MODULUS == DIRTY_CUSTOMER_REMAINDER
    out = t.select(
        F.col("ingest_seq"),
        tid.cast("string").alias("ticket_id"),
        F.when(dirty, F.concat(F.lit("  "), F.lower("customer_id"), F.lit(" ")))
         .otherwise(F.col("customer_id")).alias("customer_id"),
        F.col("category_id").cast("string").alias("category_id"),
        F.col("channel_id").cast("string").alias("channel_id"),
        F.when(F.col("agent_id") == -1, F.lit(None))
         .otherwise(F.col("agent_id").cast("double").cast("string")).alias("agent_id"),
        F.col("transaction_amount_inr").cast("string").alias("transaction_amount_inr"),
        timestamps.format_as("opened_at", (tid + F.col("ingest_seq")) % 4).alias("opened_at"),
        timestamps.format_as("closed_at", (tid + F.col("l_suppkey")) % 4).alias("closed_at"),
        F.col("status"),
        F.col("resolution_hours").cast("string").alias("resolution_hours"),
        F.col("sla_target_hours").cast("string").alias("sla_target_hours"),
        F.col("sla_breached").cast("string").alias("sla_breached"),
        F.col("root_cause"),
        F.col("is_incident_day").cast("string").alias("is_incident_day"),
    )
    return out.select(*RAW_COLUMNS)


# ---------------------------------------------------------------- dimensions

def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("int").alias("category_id"),
        F.col("n_name").alias("category_name"),
        F.col("r_name").alias("category_group"),
        target_hours(F.col("n_nationkey")).alias("sla_target_hours"))


def dim_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per priority: a partial aggregate, so only a handful of rows
    # per map task cross the shuffle.
    o = read_table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return o.select(channel_number().alias("channel_id"),
                    F.col("o_orderpriority").alias("channel_name"))


def dim_agent_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent dimension as exported (without the Unassigned member)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return s.select(F.col("s_suppkey").cast("int").alias("agent_id"),
                    F.col("s_name").alias("agent_name"),
                    F.concat(F.lit("Team "), (F.col("s_suppkey") % 3).cast("string")).alias("team"))
