"""Registry entries for sources/sinks, quality, cleaning, joins, dashboard,
filter, report and streaming operators (see :mod:`queuelens.plans.catalog`).

Registry parameters (the filter widget state, the routing table, the salt)
are plain values; every entry still reads the driver tables, so its work
grows with them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.functions import privacy, timestamps
from queuelens.operators import cleaning, filters, joins, quality
from queuelens.plans import dashboards as X
from queuelens.plans import mart as M
from queuelens.plans import queries as Q
from queuelens.plans import reports as R
from queuelens.plans.model import (Star, add_unassigned, materialized_raw, materialized_star,
                                   read_star, write_star)
from queuelens.schemas import (CSV_QUOTES, DETAIL_COLUMNS, ENRICHED_COLUMNS, FACT, FACT_COLUMNS, RAW_COLUMNS, conform)
from queuelens.session import scratch_path, shuffle_files_dropped
from queuelens.sources import files, fixtures, sinks
from queuelens.streaming import compaction, escalation, ingest

AS_OF = fixtures.AS_OF

# Registry parameters.
REGISTRY_FILTER = filters.TicketFilter(
    start=_dt.date(1998, 1, 1), end=_dt.date(1998, 12, 31),
    categories=["NATION_2", "NATION_8", "NATION_9", "NATION_12", "NATION_18",
                "NATION_6", "NATION_7", "NATION_19", "NATION_22", "NATION_23"],
    channels=["1-URGENT", "2-HIGH", "3-MEDIUM"],
    incident_only=False)
ROUTING = [("ASIA", "Team Asia"), ("EUROPE", "Team Europe"), ("AMERICA", "Team Americas")]
PII_SALT = "queuelens-registry-salt"


def _star(spark: SparkSession, d: str) -> Star:
    return materialized_star(spark, d)


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return materialized_raw(spark, d)


def _typed_raw(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.type_raw(_raw(spark, d))


def _parsed_raw(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.parse_timestamps(_typed_raw(spark, d))


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_pipeline(_raw(spark, d), AS_OF)


def _filtered(spark: SparkSession, d: str) -> DataFrame:
    return filters.t_filter(filters.t_load(_star(spark, d)), REGISTRY_FILTER)


def _panel(spark: SparkSession, d: str) -> DataFrame:
    return filters.t_filter(filters.t_panel(_star(spark, d)), REGISTRY_FILTER)


# ------------------------------------------------------------ sources / sinks

def src_raw_csv(spark, d):
    path = scratch_path(spark, "raw_csv")
    sinks.write_raw_csv(_raw(spark, d), path)
    back = files.read_raw_csv(spark, path)
    return back.select(*RAW_COLUMNS).withColumns({"transaction_amount_inr": F.col("transaction_amount_inr").try_cast("double"),
                             "resolution_hours": F.col("resolution_hours").try_cast("double")})


def src_raw_multiline(spark, d):
    """Root causes with quotes, commas and line breaks survive the export; records with a surplus field are kept apart."""
    base = scratch_path(spark, "raw_multiline")
    n = F.col("ticket_id").cast("long")
    raw = _raw(spark, d).withColumn("root_cause", F.when(n % 5 == 0, F.concat(F.lit('said "'), "root_cause", F.lit('",\ntwice'))).otherwise(F.col("root_cause")))
    sinks.write_raw_csv(raw.where(n % 211 != 0), f"{base}/whole")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS[:-2]]
    surplus = raw.where(n % 211 == 0).select(F.concat_ws(",", *fields, F.lit("x"), "is_incident_day", F.lit("surplus")).alias("value"))
    sinks.write_lines(surplus, ",".join(RAW_COLUMNS), f"{base}/surplus")
    rows = files.read_raw_csv(spark, f"{base}/whole").unionByName(files.read_raw_csv(spark, f"{base}/surplus"))
    return rows.select("ingest_seq", "ticket_id", F.when(F.col(files.CORRUPT_COLUMN).isNull(), F.col("root_cause")).alias("root_cause"),
                       F.col(files.CORRUPT_COLUMN).isNotNull().cast("int").alias("malformed"))


def src_dims_csv(spark, d):
    base = scratch_path(spark, "dims_csv")
    sinks.write_dim_csv(fixtures.dim_category(spark, d), f"{base}/category")
    sinks.write_dim_csv(fixtures.dim_channel(spark, d), f"{base}/channel")
    sinks.write_dim_csv(fixtures.dim_agent_base(spark, d), f"{base}/agent")
    cat, ch, ag = files.read_dims_csv(spark, f"{base}/category", f"{base}/channel", f"{base}/agent")
    none_s, none_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    return (cat.select(F.lit("category").alias("dimension"), F.col("category_id").alias("member_id"),
                       F.col("category_name").alias("member_name"), F.col("category_group").alias("member_group"),
                       "sla_target_hours")
            .unionByName(ch.select(F.lit("channel").alias("dimension"), F.col("channel_id").alias("member_id"),
                                   F.col("channel_name").alias("member_name"), none_s.alias("member_group"),
                                   none_i.alias("sla_target_hours")))
            .unionByName(ag.select(F.lit("agent").alias("dimension"), F.col("agent_id").alias("member_id"),
                                   F.col("agent_name").alias("member_name"), F.col("team").alias("member_group"),
                                   none_i.alias("sla_target_hours"))))


def _clean_csv_path(spark, d) -> str:
    path = scratch_path(spark, "clean_csv")
    sinks.write_clean_csv(_star(spark, d).fact, path)
    return path


def src_clean(spark, d):
    return files.read_clean(spark, _clean_csv_path(spark, d), fmt="csv")


def sk_clean_csv(spark, d):
    from pyspark.sql import types as T
    text_ts = T.StructType([T.StructField(f.name, T.StringType(), True)
                            if f.name in ("opened_at", "closed_at") else f for f in FACT.fields])
    return spark.read.option("header", True).options(**CSV_QUOTES).schema(text_ts).csv(_clean_csv_path(spark, d))


SQL_VIEW_TEXT = """
SELECT d.category_group, count(DISTINCT f.customer_id) AS customers, min(f.opened_at) AS first_opened
FROM tickets f LEFT SEMI JOIN busy b ON f.category_id = b.category_id JOIN categories d ON d.category_id = f.category_id
WHERE f.is_incident_day = :incident
GROUP BY d.category_group
"""


def src_sql_view(spark, d):
    s = _star(spark, d)
    return files.sql_view(spark, SQL_VIEW_TEXT,
                          {"tickets": s.fact, "categories": s.dim_category,
                           "busy": s.fact.groupBy("category_id").count().where("count > 100")}, {"incident": 0})


def sk_star(spark, d):
    path = scratch_path(spark, "star_refresh")
    write_star(_star(spark, d), path)
    return read_star(spark, path).fact.select(*FACT_COLUMNS)


def sk_star_interleaved(spark, d):
    """The star in the interleaved layout, read back through filters on its keys."""
    path = scratch_path(spark, "star_interleaved")
    write_star(_star(spark, d), path, layout="interleaved")
    fact = read_star(spark, path).fact
    return fact.where("category_id in (3, 4) and channel_id = 2 and day(opened_at) <= 10").select(*FACT_COLUMNS)


def sk_unassigned(spark, d):
    return add_unassigned(fixtures.dim_agent_base(spark, d))


def sk_detail_csv(spark, d):
    from pyspark.sql import types as T
    path = scratch_path(spark, "detail_csv")
    sinks.write_detail_csv(filters.t_drill(_filtered(spark, d)), path)
    s = _star(spark, d)
    enriched_schema = {f.name: f.dataType for f in s.enriched().schema.fields}
    schema = T.StructType([T.StructField(c, T.StringType() if c == "opened_at" else enriched_schema[c], True)
                           for c in DETAIL_COLUMNS])
    return spark.read.option("header", True).options(**CSV_QUOTES).schema(schema).csv(path)


# ------------------------------------------------------------ schema / quality

def sc_star(spark, d):
    return conform(_star(spark, d).fact.select(*FACT_COLUMNS), FACT)


def dq_pk_unique(spark, d):
    return quality.pk_violations(_typed_raw(spark, d), "ticket_id")


def dq_not_null(spark, d):
    return quality.null_counts(_parsed_raw(spark, d), FACT_COLUMNS)


def dq_domain(spark, d):
    return quality.domain_violations(_typed_raw(spark, d))


def dq_fk(spark, d):
    s = _star(spark, d)
    # the agents as exported, before the Unassigned member is added
    dims = {"category_id": s.dim_category, "channel_id": s.dim_channel, "agent_id": fixtures.dim_agent_base(spark, d)}
    found = quality.fk_orphan_rows(s.fact, dims)
    return found.withColumn("key_value", F.col("key_value").cast("int"))


def dq_quarantine(spark, d):
    """The export with some ids, times and categories spoilt; every spoilt row is kept apart with its reasons."""
    raw = _raw(spark, d)
    n = F.col("ticket_id").cast("long")
    spoilt = raw.withColumns({
        "ticket_id": F.when(n % 97 == 0, F.concat(F.lit("T-"), "ticket_id")).otherwise(F.col("ticket_id")),
        "opened_at": F.when(n % 89 == 0, F.lit("soon")).otherwise(F.col("opened_at")),
        "category_id": F.when(n % 83 == 0, F.lit("x")).otherwise(F.col("category_id")),
        "agent_id": F.when(n % 79 == 0, F.lit("A17")).when(n % 73 == 0, F.lit("NaN")).otherwise(F.col("agent_id"))})
    return cleaning.quarantine(spoilt).select("ingest_seq", F.col("ticket_id").alias("ticket_text"),
                                              F.array_join("reasons", ",").alias("reasons"))


def dq_unparsed(spark, d):
    raw = _raw(spark, d)
    parsed = raw.select(
        "opened_at", "closed_at",
        timestamps.parse_mixed_timestamp("opened_at").alias("_o"),
        timestamps.parse_mixed_timestamp("closed_at").alias("_c"))
    return parsed.agg(
        F.count_if(F.col("opened_at").isNotNull() & F.col("_o").isNull()).alias("unparsed_opened_at"),
        F.count_if(F.col("closed_at").isNotNull() & F.col("_c").isNull()).alias("unparsed_closed_at"))


def dq_counts(spark, d):
    return quality.counts(_typed_raw(spark, d), "ticket_id")


def dq_gate(spark, d):
    path = scratch_path(spark, "gated")
    quality.write_then_gate(_cleaned(spark, d), path)
    return files.read_clean(spark, path)


def dq_reconcile(spark, d):
    return quality.reconcile(dq_gate(spark, d), _star(spark, d).fact.select(*FACT_COLUMNS), "ticket_id")


def dq_reconcile_drift(spark, d):
    """The cleaned export against a later state of it: some tickets gone, some new, some changed."""
    clean, n = dq_gate(spark, d), F.col("ticket_id")
    later = clean.where(n % 101 != 0).withColumns({
        "status": F.when(n % 103 == 0, F.lit("Open")).otherwise(F.col("status")),
        "root_cause": F.when(n % 107 == 0, F.lit(None)).otherwise(F.col("root_cause"))})
    new = clean.where(n % 109 == 0).withColumn("ticket_id", -n)
    path = scratch_path(spark, "later")
    later.unionByName(new).write.parquet(path)
    return quality.reconcile(clean, files.read_clean(spark, path), "ticket_id")


# ------------------------------------------------------------ cleaning

def cl_timestamp(spark, d):
    return _parsed_raw(spark, d).select("ingest_seq", "ticket_id", "opened_at", "closed_at")


def cl_ts_fallback(spark, d):
    r = _raw(spark, d)
    return r.select("ingest_seq", F.col("ticket_id").cast("long").alias("ticket_id"),
                    timestamps.parse_fallback("opened_at").alias("opened_at_fallback"),
                    timestamps.parse_fallback("closed_at").alias("closed_at_fallback"))


def cl_dedup_first(spark, d):
    return cleaning.dedup_first(_typed_raw(spark, d)).select(
        "ingest_seq", "ticket_id", "customer_id", "agent_id", "opened_at")


def cl_customer(spark, d):
    return cleaning.normalize_customer(_typed_raw(spark, d)).select("ingest_seq", "ticket_id", "customer_id")


def cl_agent_default(spark, d):
    return cleaning.default_agent(_typed_raw(spark, d)).select("ingest_seq", "ticket_id", "agent_id")


def cl_resolution(spark, d):
    return cleaning.recompute_resolution(_parsed_raw(spark, d)).select(
        "ingest_seq", "ticket_id", "status", "resolution_hours")


def cl_breach(spark, d):
    df = cleaning.recompute_breach(cleaning.recompute_resolution(_parsed_raw(spark, d)), AS_OF)
    return df.select("ingest_seq", "ticket_id", "sla_breached")


def cl_iso_format(spark, d):
    return cleaning.iso_format(_parsed_raw(spark, d)).select("ingest_seq", "ticket_id", "opened_at", "closed_at")


def cl_project_sort(spark, d):
    """The cleaned rows are written first: the sort reads them twice, and their shuffle files are gone before its own come."""
    path = scratch_path(spark, "cleaned")
    with shuffle_files_dropped(spark):
        _cleaned(spark, d).write.parquet(path)
    return cleaning.project_sort(files.read_clean(spark, path))


def cl_pipeline(spark, d):
    return _cleaned(spark, d)


def g1_incident_flag(spark, d):
    cal = spark.createDataFrame([(x,) for x in fixtures.INCIDENT_DAYS], "incident_date string")
    f = _star(spark, d).fact.select("ticket_id", "opened_at")
    return cleaning.flag_incident_days(f, cal, out_col="is_incident_day")


def g2_route_team(spark, d):
    routing = spark.createDataFrame(ROUTING, "category_group string, team string")
    e = _star(spark, d).enriched().select("ticket_id", "category_group")
    return cleaning.route_team(e, routing)


# ------------------------------------------------------------ joins

def j_category(spark, d):
    s = _star(spark, d)
    return joins.join_category(s.fact.select(*FACT_COLUMNS), s.dim_category)


def j_channel(spark, d):
    s = _star(spark, d)
    return joins.join_channel(s.fact.select(*FACT_COLUMNS), s.dim_channel)


def j_agent(spark, d):
    s = _star(spark, d)
    return joins.join_agent(s.fact.select(*FACT_COLUMNS), s.dim_agent)


def j_agent_split(spark, d):
    """j_agent with the hot members set apart, as it runs once the agents outgrow a broadcast."""
    s = _star(spark, d)
    return joins.split_join(s.fact.select(*FACT_COLUMNS), s.dim_agent, "agent_id")


def j_enriched(spark, d):
    return _star(spark, d).enriched()


# ------------------------------------------------------------ filter surface

def t_load(spark, d):
    return filters.t_load(_star(spark, d))


def t_filter(spark, d):
    return _filtered(spark, d).select(*ENRICHED_COLUMNS)


def _on_filtered(fn):
    return lambda spark, d: fn(_filtered(spark, d))


def _on_panel(fn):
    return lambda spark, d: fn(_panel(spark, d))


def _on_star(fn):
    return lambda spark, d: fn(_star(spark, d))


def t_panels(spark, d):
    """All panels of the registry's selection in long form, from one scan."""
    path = scratch_path(spark, "panel_cube")
    cube = filters.panel_cube(_panel(spark, d))
    cube.write.parquet(path)
    panels = filters.panels_of(spark.read.schema(cube.schema).parquet(path))
    none = F.lit(None)

    def long(name, label, tickets, value):
        return panels[name].select(F.lit(name).alias("panel"), label.cast("string").alias("label"), tickets.cast("bigint").alias("tickets"),
                                   value.cast("double").alias("value"))

    parts = [long("kpis", F.lit(c), F.when(F.lit(c).isin("total_tickets", "open_tickets"), F.col(c)), F.when(~F.lit(c).isin("total_tickets", "open_tickets"), F.col(c)))
             for c in panels["kpis"].columns]
    parts += [long("category", F.col("category_name"), F.col("tickets"), F.col("sla_breach_pct")),
              long("monthly", F.col("month"), F.col("tickets"), F.col("sla_compliance_pct")),
              long("channel_counts", F.col("channel_name"), F.col("tickets"), none),
              long("root_causes", F.col("root_cause"), F.col("breached_tickets"), none),
              long("match_count", none, F.col("matching_tickets"), none)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ marts

def _mart_panel(fn):
    """A filter panel from the daily mart."""
    def run(spark, d):
        s = _star(spark, d)
        build = M.build_cause_mart if fn is M.mart_t_root_causes8 else M.build_mart
        return fn(M.mart_filter(M.mart_enriched(build(s.fact), s), REGISTRY_FILTER))
    return run


MART_REGISTRY = {
    "mart_a1_kpis": _on_star(lambda s: M.mart_a1_kpis(M.build_mart(s.fact))),
    "mart_b1_category": _on_star(lambda s: M.mart_b1_category(M.build_mart(s.fact), s)),
    "mart_b4_buckets": _on_star(lambda s: M.hist_b4_buckets(M.build_hours_histogram(s.fact))),
    "mart_c2_monthly_sla": _on_star(lambda s: M.mart_c2_monthly_sla(M.build_mart(s.fact))),
    "mart_c4_salary_window": _on_star(lambda s: M.mart_c4_salary_window(M.build_mart(s.fact))),
    "mart_d2_team": _on_star(lambda s: M.mart_d2_team(M.build_agent_mart(s.fact), s)),
    "mart_e1_incident_volume": _on_star(lambda s: M.mart_e1_incident_volume(M.build_mart(s.fact))),
    **{f"mart_{k}": _mart_panel(getattr(M, f"mart_{k}")) for k in (
        "t_kpis", "t_category", "t_monthly", "t_channel_counts", "t_root_causes8", "t_match_count")},
}


# ------------------------------------------------------------ streaming

def _ingest(spark, d, between=None) -> str:
    """The export in four drops of 14 columns, the tickets' later copies arriving before the earlier ones.

    A drop's name tells its place in the ingest order; ``between`` runs on the sink after every drop.
    """
    base = scratch_path(spark, "ingest")
    raw = _raw(spark, d)
    nth = F.least(F.col("ingest_seq"), F.lit(4))
    for k in (4, 3, 2, 1):
        drop = raw.where(nth == k).sortWithinPartitions("ingest_seq").select(*RAW_COLUMNS[1:])
        sinks.write_raw_csv(drop, f"{base}/source/drop{k}", compression="gzip")
        ingest.start_clean_ingest(spark, f"{base}/source/*", f"{base}/sink", f"{base}/checkpoint", AS_OF).awaitTermination()
        if between:
            between(f"{base}/sink")
    return f"{base}/sink"


def st_clean_ingest(spark, d):
    return ingest.read_ingested(spark, _ingest(spark, d))


def st_ingest_compacted(spark, d):
    """The same stream, compacted after every drop but the last: table and tail are read together."""
    left = [0]

    def between(sink):
        left[0] += 1
        if left[0] < 4:
            compaction.compact(spark, sink)

    return ingest.read_ingested(spark, _ingest(spark, d, between))


def st_at_risk(spark, d):
    return escalation.at_risk(_star(spark, d).fact, AS_OF)


def st_unassigned_escalation(spark, d):
    return escalation.unassigned_escalation(_star(spark, d).fact, AS_OF)


def _escalate(spark, d, build):
    """The rule as a stream: what has happened by AS_OF arrives in three drops, then nothing but a tick."""
    base = scratch_path(spark, "escalation")
    events = escalation.ticket_events(_star(spark, d).fact).where(F.col("event_time") <= F.lit(AS_OF).cast("timestamp"))
    source = spark.readStream.schema(events.schema).parquet(f"{base}/events/*")
    year = F.year("event_time")
    late = _dt.datetime.fromisoformat(AS_OF) + _dt.timedelta(hours=1, seconds=1)   # the watermark's delay, and past AS_OF
    for k, drop in enumerate((events.where(year < 1995), events.where(year.between(1995, 1998)), events.where(year > 1998), escalation.tick(spark, late))):
        drop.write.parquet(f"{base}/events/drop{k}")
        (build(source).writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start(f"{base}/out").awaitTermination())
    return spark.read.parquet(f"{base}/out").select("ticket_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("opened_at", "escalate_at")])


def st_at_risk_stream(spark, d):
    return _escalate(spark, d, escalation.at_risk_stream)


def st_unassigned_stream(spark, d):
    return _escalate(spark, d, escalation.unassigned_stream)


def pii_mask(spark, d):
    r = _raw(spark, d)
    return r.select("ingest_seq", F.col("ticket_id").cast("long").alias("ticket_id"),
                    privacy.mask_customer("customer_id", PII_SALT).alias("customer_token"))


def pii_hmac(spark, d):
    path = scratch_path(spark, "pii_key")
    # the registry's key: the salt's characters, written as a text file (and so with a line end)
    spark.createDataFrame([(PII_SALT,)], "value string").coalesce(1).write.text(path)
    r = _raw(spark, d).select("ingest_seq", F.col("ticket_id").cast("long").alias("ticket_id"), "customer_id")
    return privacy.mask_customers(r, f"{path}/part-*.txt").drop("customer_id")


# ------------------------------------------------------------ catalog check

def v1_catalog(spark, d):
    """Every catalog query run in one job; one row per query with its row count.

    A query that fails to plan or run fails this job (the reference only
    printed failures)."""
    s = _star(spark, d)
    parts = []
    for key, fn in Q.QUERIES.items():
        answer = fn(s)
        # the digest keeps every measure in the plan; without it only the rows would be counted
        digest = F.bit_xor(F.xxhash64(*answer.columns))
        parts.append(answer.agg(F.count(F.lit(1)).alias("n"), digest.alias("digest")).select(
            F.lit(key).alias("query_key"), F.when(F.col("digest").isNotNull(), F.col("n")).otherwise(F.lit(0)).alias("result_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def more_registry():
    reg = {
        "src_raw_csv": src_raw_csv, "src_raw_multiline": src_raw_multiline, "src_dims_csv": src_dims_csv, "src_clean": src_clean,
        "src_sql_view": src_sql_view, "sk_clean_csv": sk_clean_csv, "sk_star": sk_star, "sk_star_interleaved": sk_star_interleaved,
        "sk_unassigned": sk_unassigned, "sk_detail_csv": sk_detail_csv,
        "sc_star": sc_star, "dq_pk_unique": dq_pk_unique, "dq_not_null": dq_not_null,
        "dq_domain": dq_domain, "dq_fk": dq_fk, "dq_unparsed": dq_unparsed, "dq_counts": dq_counts,
        "dq_gate": dq_gate, "dq_quarantine": dq_quarantine, "dq_reconcile": dq_reconcile,
        "dq_reconcile_drift": dq_reconcile_drift,
        "cl_timestamp": cl_timestamp, "cl_ts_fallback": cl_ts_fallback, "cl_dedup_first": cl_dedup_first,
        "cl_customer": cl_customer, "cl_agent_default": cl_agent_default, "cl_resolution": cl_resolution,
        "cl_breach": cl_breach, "cl_iso_format": cl_iso_format, "cl_project_sort": cl_project_sort,
        "cl_pipeline": cl_pipeline, "g1_incident_flag": g1_incident_flag, "g2_route_team": g2_route_team,
        "j_category": j_category, "j_channel": j_channel, "j_agent": j_agent, "j_agent_split": j_agent_split, "j_enriched": j_enriched,
        "x_kpis": _on_star(X.x_kpis), "x_category": _on_star(X.x_category),
        "x_channel": _on_star(X.x_channel), "x_monthly": _on_star(X.x_monthly),
        "x_detail": _on_star(X.x_detail), "x_category_chart": _on_star(X.x_category_chart),
        "p_kpis": _on_star(X.p_kpis), "p_breach_by_category": _on_star(X.p_breach_by_category),
        "p_monthly": _on_star(X.p_monthly), "p_root_causes8": _on_star(X.p_root_causes8),
        "p_incident": _on_star(X.p_incident), "bd_sanity": _on_star(X.bd_sanity),
        "t_load": t_load, "t_bounds": lambda spark, d: filters.t_bounds(_star(spark, d).fact),
        "t_distinct_lists": _on_star(filters.t_distinct_lists),
        "t_filter": t_filter,
        "t_kpis": _on_panel(filters.t_kpis), "t_category": _on_panel(filters.t_category),
        "t_monthly": _on_panel(filters.t_monthly),
        "t_channel_counts": _on_panel(filters.t_channel_counts),
        "t_root_causes8": _on_panel(filters.t_root_causes8), "t_drill": _on_filtered(filters.t_drill),
        "t_match_count": _on_panel(filters.t_match_count), "t_panels": t_panels,
        "r_avg_vs_target": _on_star(R.r_avg_vs_target), "r_group_top_cause": _on_star(R.r_group_top_cause),
        "r_group_share": _on_star(R.r_group_share), "r_top4_sum": _on_star(R.r_top4_sum),
        "r_unassigned_vs_team": _on_star(R.r_unassigned_vs_team),
        "r_salary_lift": _on_star(R.r_salary_lift), "r_incident_lift": _on_star(R.r_incident_lift),
        "r_target_gap": _on_star(R.r_target_gap), "v1_catalog": v1_catalog,
        "st_clean_ingest": st_clean_ingest, "st_ingest_compacted": st_ingest_compacted, "st_at_risk": st_at_risk,
        "st_at_risk_stream": st_at_risk_stream, "st_unassigned_stream": st_unassigned_stream,
        "st_unassigned_escalation": st_unassigned_escalation, "pii_mask": pii_mask, "pii_hmac": pii_hmac,
        **MART_REGISTRY,
    }
    return reg
