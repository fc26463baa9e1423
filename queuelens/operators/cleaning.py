"""Raw export -> clean fact (cl_*), plus the two re-aimed simulator rules (g1, g2).

Every step is a lazy ``DataFrame -> DataFrame`` function made of native
expressions; :func:`clean_pipeline` chains them: dedup -> judge (with the
times parsed) -> customer -> agent -> hours -> breach -> project.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelens.functions import sla, timestamps
from queuelens.functions.text import strip_ws
from queuelens.schemas import FACT_COLUMNS


def parse_timestamps(raw: DataFrame, cols: Sequence[str] = ("opened_at", "closed_at")) -> DataFrame:
    """cl_timestamp (+ cl_ts_fallback): text in any known layout -> TIMESTAMP_NTZ.

    The text is stripped once into a column first: it feeds up to ten guard /
    parse expressions inside conditional branches, where Spark would otherwise
    re-evaluate the strip each time.  (The stripping projection is not
    expression-cheap, so Catalyst keeps it separate instead of inlining it.)"""
    tmp = {c: f"_{c}_stripped" for c in cols}
    df = raw.withColumns({tmp[c]: strip_ws(c) for c in cols})
    df = df.withColumns({c: timestamps.parse_mixed_timestamp(F.col(tmp[c]), stripped=True) for c in cols})
    return df.drop(*tmp.values())


def dedup_first(df: DataFrame, key: str = "ticket_id", seq: str = "ingest_seq") -> DataFrame:
    """cl_dedup_first: keep the first copy of every key in ingest order.

    ``row_number() = 1`` plans a partial ``WindowGroupLimit`` before the
    shuffle, so each map task forwards at most one row per key -- a hot group
    of copies shrinks to (tasks) rows before it is exchanged.
    """
    w = Window.partitionBy(key).orderBy(F.col(seq).asc_nulls_last())
    return df.withColumn("_first", F.row_number().over(w)).filter(F.col("_first") == 1).drop("_first")


def normalize_customer(df: DataFrame, col: str = "customer_id") -> DataFrame:
    """cl_customer: strip surrounding whitespace + upper case."""
    return df.withColumn(col, F.upper(strip_ws(col)))


def default_agent(df: DataFrame, col: str = "agent_id") -> DataFrame:
    """cl_agent_default: missing agent -> -1 (the Unassigned member), as INT.

    Raw ids arrive as float text ("17.0"); they go through DOUBLE first.  Text
    ``NaN`` counts as missing; other unreadable text is found by :func:`rejects`.
    """
    c = F.col(col)
    return df.withColumn(col, F.coalesce(c.try_cast("double").try_cast("int"), F.lit(-1)))


def recompute_resolution(df: DataFrame) -> DataFrame:
    """cl_resolution: hours from the cleaned timestamps, half-even at 2 dp."""
    return df.withColumn("resolution_hours",
                         sla.resolution_hours("status", "opened_at", "closed_at"))


def recompute_breach(df: DataFrame, as_of: str | _dt.datetime) -> DataFrame:
    """cl_breach: 0/1 against ``sla_target_hours`` with the ``as_of`` clock."""
    return df.withColumn("sla_breached", sla.breach_flag(
        "status", "resolution_hours", "opened_at", "sla_target_hours", as_of))


def iso_format(df: DataFrame, cols: Sequence[str] = ("opened_at", "closed_at")) -> DataFrame:
    """cl_iso_format: timestamps as ``YYYY-MM-DD HH:MM:SS`` text (sinks only)."""
    return df.withColumns({c: timestamps.iso_text(c) for c in cols})


def project_sort(df: DataFrame) -> DataFrame:
    """cl_project_sort: the fixed 14 columns, ordered by ticket id.

    ``orderBy`` is a distributed sort (range exchange); sinks that only
    need ordered files use ``sortWithinPartitions`` instead.
    """
    return df.select(*FACT_COLUMNS).orderBy("ticket_id")


def _flag01(col: str) -> F.Column:
    t = F.lower(F.trim(F.col(col)))
    return (F.when(t.isin("1", "true", "1.0"), 1)
            .when(t.isin("0", "false", "0.0"), 0)
            .otherwise(F.col(col).try_cast("int")))


def type_raw(raw: DataFrame) -> DataFrame:
    """Cast the text columns of the raw export to the fact types.

    Timestamps and agent ids are left to their own cleaning steps.
    """
    return raw.withColumns({
        "ticket_id": F.col("ticket_id").try_cast("long"),
        "category_id": F.col("category_id").try_cast("int"),
        "channel_id": F.col("channel_id").try_cast("int"),
        "transaction_amount_inr": F.col("transaction_amount_inr").try_cast("double"),
        "resolution_hours": F.col("resolution_hours").try_cast("double"),
        "sla_target_hours": F.col("sla_target_hours").try_cast("double").try_cast("int"),
        "sla_breached": _flag01("sla_breached"),
        "is_incident_day": _flag01("is_incident_day"),
    })


def _unreadable(col: str, typed: F.Column) -> F.Column:
    """Text is there, is not a spelling of "missing", and does not read as its type."""
    t = F.lower(strip_ws(col))
    return F.col(col).isNotNull() & ~t.isin(*MISSING_TEXTS) & typed.isNull()


# Texts that stand for a missing value in an export.
MISSING_TEXTS = ("", "nan", "none", "null", "na", "n/a")


def _required() -> list[str]:
    from queuelens.operators.quality import REQUIRED_COLUMNS

    return [c for c in REQUIRED_COLUMNS if c not in ("ticket_id", "sla_breached")]   # the key has its own rule, the flag is computed


def has_key(raw: DataFrame) -> F.Column:
    """The row is a whole record with a readable ticket id, so it takes part in the dedup."""
    from queuelens.sources.files import CORRUPT_COLUMN

    key = F.col("ticket_id").try_cast("long").isNotNull()
    return key & F.col(CORRUPT_COLUMN).isNull() if CORRUPT_COLUMN in raw.columns else key


def rejects(raw: DataFrame, keep_times: bool = False) -> DataFrame:
    """``raw`` plus ``reasons``: why a row cannot be loaded (an empty array if it can).

    A row is rejected when its record has not the export's number of fields
    (``record``), its ticket id is unreadable, a column that the gate requires
    has no value in its domain, or any other typed field has text that does
    not read as its type.  With ``keep_times`` the parsed times stay as
    ``_opened_at`` and ``_closed_at``.
    """
    from queuelens.operators.quality import STATUS_DOMAIN
    from queuelens.sources.files import CORRUPT_COLUMN

    raw = raw.withColumns({f"_{c}": timestamps.parse_mixed_timestamp(c) for c in ("opened_at", "closed_at")})
    number = {c: F.col(c).try_cast("double") for c in ("transaction_amount_inr", "resolution_hours")}
    whole = {c: F.col(c).try_cast("double").try_cast("int") for c in ("category_id", "channel_id", "agent_id", "sla_target_hours")}
    flags = {c: F.when(_flag01(c).isin(0, 1), _flag01(c)) for c in ("sla_breached", "is_incident_day")}
    times = {c: F.col(f"_{c}") for c in ("opened_at", "closed_at")}
    texts = {"customer_id": F.col("customer_id"), "status": F.when(F.col("status").isin(*STATUS_DOMAIN), F.col("status"))}
    rules = {"record": F.col(CORRUPT_COLUMN).isNotNull()} if CORRUPT_COLUMN in raw.columns else {}
    rules["ticket_id"] = F.col("ticket_id").try_cast("long").isNull()
    typed = {**whole, **number, **flags, **times, **texts}
    rules |= {c: v.isNull() if c in _required() else _unreadable(c, v) for c, v in typed.items()}
    judged = raw.withColumn("reasons", F.filter(
        F.array(*[F.when(bad, F.lit(c)) for c, bad in rules.items()]), lambda x: x.isNotNull()))
    return judged if keep_times else judged.drop("_opened_at", "_closed_at")


def quarantine(raw: DataFrame) -> DataFrame:
    """dq_quarantine: the rejected rows with their texts and reasons."""
    return rejects(raw).where(F.size("reasons") > 0)


def first_copies(raw: DataFrame) -> DataFrame:
    """The first copy of every ticket, judged (:func:`rejects`, with its times parsed).

    A ticket's first copy decides, also when it is rejected: a later copy does
    not take its place.  Rows without a readable key are no copies of anything.
    """
    return rejects(dedup_first(raw.where(has_key(raw)).withColumn("ticket_id", F.col("ticket_id").try_cast("long"))), keep_times=True)


def clean_first(judged: DataFrame, as_of: str | _dt.datetime) -> DataFrame:
    """The cleaned columns of :func:`first_copies`; other columns stay as they are."""
    df = type_raw(judged).withColumns({c: F.col(f"_{c}") for c in ("opened_at", "closed_at")})
    df = default_agent(normalize_customer(df))
    return recompute_breach(recompute_resolution(df), as_of)


def clean_pipeline(raw: DataFrame, as_of: str | _dt.datetime, *, sort: bool = False) -> DataFrame:
    """cl_pipeline: raw export -> clean fact (14 columns).

    Dedup, then judge, then clean: what :func:`run_clean_pipeline` writes and
    the stream ingests.  Rejected rows are left to the quarantine.
    """
    df = clean_first(first_copies(raw).where(F.size("reasons") == 0), as_of).select(*FACT_COLUMNS)
    return df.orderBy("ticket_id") if sort else df


def _with_flag(df: DataFrame, flag: str) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(flag, T.BooleanType(), True)])


def run_clean_pipeline(raw: DataFrame, as_of: str | _dt.datetime, path: str,
                       quarantine_path: str | None = None) -> dict[str, int]:
    """cl_pipeline as a job: keep the first copies, judge, clean, write aside, audit, publish.

    Every raw row ends in one of three places: the clean fact, the quarantine
    (``path`` + ``_quarantine``), or the count of removed copies: raw = clean +
    duplicates + quarantined.  The plan runs once, into tables in the shared
    folder; all counts are those tables' row counts, so a task that runs twice
    is not counted twice.  Raises ``DataQualityError``, with the earlier output
    untouched, if an assertion fails.
    """
    from queuelens.operators import quality
    from queuelens.session import scratch_path

    spark = raw.sparkSession
    rows_at, first_at = scratch_path(spark, "rows"), scratch_path(spark, "first_copies")
    raw.withColumn("keyed", has_key(raw)).write.partitionBy("keyed").parquet(rows_at)
    rows = spark.read.schema(_with_flag(raw, "keyed")).parquet(rows_at)
    judged = first_copies(rows.where("keyed").drop("keyed"))
    judged.withColumn("rejected", F.size("reasons") > 0).write.partitionBy("rejected").parquet(first_at)
    first = spark.read.schema(_with_flag(judged, "rejected")).parquet(first_at)
    unkeyed = rejects(rows.where("not keyed").drop("keyed"))
    bad = unkeyed.unionByName(first.where("rejected").select(*raw.columns, "reasons").withColumn("ticket_id", F.col("ticket_id").cast("string")))
    out = quarantine_path or f"{path.rstrip('/')}_quarantine"
    bad.write.mode("overwrite").parquet(out)
    quality.write_then_gate(clean_first(first.where("not rejected"), as_of).select(*FACT_COLUMNS), path)
    all_rows, keyed, kept, clean = rows.count(), rows.where("keyed").count(), first.count(), first.where("not rejected").count()
    bad = spark.read.schema(bad.schema).parquet(out)
    unparsed = bad.where(F.array_contains("reasons", "opened_at") & F.col("opened_at").isNotNull()).count()
    return {"raw_rows": all_rows, "quarantined": bad.count(), "unparsed_opened_at": unparsed,
            "duplicates_removed": keyed - kept, "clean_rows": clean}


# ------------------------------------------------- re-aimed simulator rules

def flag_incident_days(fact: DataFrame, calendar: DataFrame, ts_col: str = "opened_at",
                       out_col: str = "is_incident_day") -> DataFrame:
    """g1_incident_flag: 1 if the ticket opened on a listed incident day.

    ``calendar`` has one column ``incident_date`` (DATE); it is
    de-duplicated and joined on the date.
    """
    days = calendar.select(F.col("incident_date").cast("date").alias("_day")).distinct() \
        .withColumn("_hit", F.lit(1))
    out = fact.withColumn("_day", F.to_date(ts_col)).join(days, "_day", "left")
    return out.withColumn(out_col, F.coalesce(F.col("_hit"), F.lit(0))).drop("_day", "_hit")


# The team used when a category group has no owning team.
DEFAULT_TEAM = "Tier-1 Support"


def route_team(df: DataFrame, routing: DataFrame, group_col: str = "category_group",
               out_col: str = "routed_team", default: str = DEFAULT_TEAM) -> DataFrame:
    """g2_route_team: category group -> owning team, else the default team.

    ``routing`` has columns ``category_group`` and ``team``; of several teams of a
    group the first in alphabetical order is taken.
    """
    r = routing.select(F.col("category_group").alias(group_col), F.col("team").alias("_team")) \
        .groupBy(group_col).agg(F.min("_team").alias("_team"))
    out = df.join(r, group_col, "left")
    return out.withColumn(out_col, F.coalesce(F.col("_team"), F.lit(default))).drop("_team")
