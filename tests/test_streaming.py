"""Streaming operators: batch = stream on ordered input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from queuelens.operators import cleaning
from queuelens.plans.model import materialized_raw, materialized_star
from queuelens.schemas import FACT_COLUMNS, RAW_COLUMNS
from queuelens.session import scratch_path
from queuelens.sources import files, fixtures, sinks
from queuelens.streaming import compaction, escalation, ingest
from tests.conftest import SF_SMALL, explain_text


def test_ingest_stream_equals_batch_in_any_order(spark):
    raw = materialized_raw(spark, SF_SMALL)
    base = scratch_path(spark, "test_ingest")
    src, sink, ckpt = f"{base}/source", f"{base}/sink", f"{base}/checkpoint"
    # later copies first, in two runs of several micro-batches
    for run, part in enumerate((F.col("ingest_seq") > 1, F.col("ingest_seq") == 1)):
        for k in range(2):
            drop = raw.filter(part & (F.col("ticket_id").cast("long") % 2 == k))
            sinks.write_raw_csv(drop.coalesce(1), f"{src}/drop{run}{k}")
        q = ingest.start_clean_ingest(spark, f"{src}/*", sink, ckpt, fixtures.AS_OF, max_files_per_trigger=1)
        q.awaitTermination()
    streamed = ingest.read_ingested(spark, sink)
    batch = cleaning.clean_pipeline(raw, fixtures.AS_OF)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_close_that_arrives_before_its_open_does_not_escalate(spark):
    base = scratch_path(spark, "test_close_first")
    schema = "ticket_id long, sla_target_hours int, agent_id int, event string, event_time timestamp"
    rows = [[(1, 24, -1, "close", "2024-01-01 10:00:00")],
            [(1, 24, -1, "open", "2024-01-01 09:50:00"), (2, 24, -1, "open", "2024-01-01 09:50:00")],
            [(9, 24, -1, "close", "2024-01-02 10:00:00")]]
    for i, r in enumerate(rows):
        spark.createDataFrame(r, schema.replace("timestamp", "string")).withColumn(
            "event_time", F.to_timestamp("event_time")).coalesce(1).write.mode("append").parquet(f"{base}/events/{i}")
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/events/*")
    q = (escalation.escalation_stream(events, 30).writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    assert [r.ticket_id for r in spark.read.parquet(f"{base}/out").collect()] == [2]


def _run_stream(spark, fact, build, name):
    base = scratch_path(spark, name)
    escalation.ticket_events(fact).write.parquet(f"{base}/events")
    events = spark.readStream.schema(escalation.ticket_events(fact).schema).parquet(f"{base}/events")
    q = (build(events).writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return {r.ticket_id for r in spark.read.parquet(f"{base}/out").collect()}


def _last_event_minus_1s(fact):
    # A timer fires once the watermark (= last event time, zero delay) has
    # passed the escalation instant: the batch rule one second before it.
    import datetime as dt
    last = fact.agg(F.max(F.greatest("opened_at", F.coalesce("closed_at", "opened_at")))).first()[0]
    return last - dt.timedelta(seconds=1)


def test_unassigned_escalation_stream_equals_batch(spark):
    fact = materialized_star(spark, SF_SMALL).fact.select(*FACT_COLUMNS).filter(F.col("agent_id") == -1)
    streamed = _run_stream(spark, fact, lambda ev: escalation.escalation_stream(
        ev, escalation.UNASSIGNED_LEAD_MINUTES, watermark_delay="0 seconds"), "test_escalation")
    batch = {r.ticket_id for r in escalation.unassigned_escalation(fact, _last_event_minus_1s(fact)).collect()}
    assert batch and streamed == batch


def test_at_risk_stream_equals_batch(spark):
    fact = materialized_star(spark, SF_SMALL).fact.select(*FACT_COLUMNS)
    streamed = _run_stream(spark, fact, lambda ev: escalation.at_risk_stream(ev, watermark_delay="0 seconds"),
                           "test_at_risk")
    batch = {r.ticket_id for r in escalation.at_risk(fact, _last_event_minus_1s(fact)).collect()}
    assert batch and streamed == batch


def test_quiet_source_escalates_by_the_heartbeat_alone(spark):
    """No event follows the opens; the wall clock's ticks alone move event time past their lead."""
    import time

    base = scratch_path(spark, "test_quiet")
    rows = spark.range(3).select(F.col("id").alias("ticket_id"), F.lit(24).alias("sla_target_hours"), F.lit(-1).alias("agent_id"),
                                 F.lit("open").alias("event"), (F.current_timestamp() - F.expr("INTERVAL 2 HOURS")).alias("event_time"))
    rows.where("ticket_id < 2").write.parquet(f"{base}/events/a")
    rows.where("ticket_id = 1").withColumn("event", F.lit("close")).write.parquet(f"{base}/events/b")
    events = spark.readStream.schema(rows.schema).parquet(f"{base}/events/*")
    out = []
    q = (escalation.unassigned_stream(events, "10 seconds", ticks=escalation.heartbeat(spark)).writeStream
         .foreachBatch(lambda df, _: out.extend(r.ticket_id for r in df.collect()))
         .option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="1 second").start())
    try:
        for _ in range(120):
            if out:
                break
            time.sleep(1)
    finally:
        q.stop()
    assert out == [0]


def _drops(spark, base, parts, between=lambda: None):
    for name, part in parts:
        sinks.write_raw_csv(part, f"{base}/source/{name}")
        ingest.start_clean_ingest(spark, f"{base}/source/*", f"{base}/sink", f"{base}/checkpoint", fixtures.AS_OF).awaitTermination()
        between()


def _rows(df):
    return sorted(map(str, df.select(*FACT_COLUMNS).collect()))


def test_fourteen_column_drops_in_any_order_equal_the_job(spark):
    raw = materialized_raw(spark, SF_SMALL)
    cols = RAW_COLUMNS[1:]
    spoilt = raw.withColumn("status", F.when(F.col("ticket_id").cast("long") % 41 == 0, F.when(F.col("ingest_seq") == 1, "Lost").otherwise(F.col("status")))
                            .otherwise(F.col("status")))
    first, later = spoilt.where("ingest_seq = 1").select(*cols), spoilt.where("ingest_seq > 1").orderBy("ingest_seq").select(*cols)
    results = []
    for order in (("a", "b"), ("b", "a")):
        base = scratch_path(spark, "test_any_order")
        _drops(spark, base, [(name, {"a": first, "b": later}[name]) for name in order])
        kept = ingest.read_quarantined(spark, f"{base}/sink")
        assert kept.count() == first.where("status = 'Lost'").count() > 0 and kept.where("status <> 'Lost'").count() == 0
        results.append(_rows(ingest.read_ingested(spark, f"{base}/sink")))
    out = scratch_path(spark, "test_any_order_job")
    m = cleaning.run_clean_pipeline(files.read_raw_csv(spark, f"{base}/source/*"), fixtures.AS_OF, out)
    assert results[0] == results[1] == _rows(spark.read.parquet(out)) == _rows(cleaning.clean_pipeline(spoilt, fixtures.AS_OF))
    assert m["quarantined"] == first.where("status = 'Lost'").count()


def test_compaction_reads_the_tail_only_and_survives_crashes_and_replays(spark):
    raw = materialized_raw(spark, SF_SMALL)
    base = scratch_path(spark, "test_compaction")
    sink = f"{base}/sink"
    nth = lambda k: raw.where(F.pmod(F.col("ticket_id").cast("long") + F.col("ingest_seq"), F.lit(3)) == k)
    want = _rows(cleaning.clean_pipeline(raw, fixtures.AS_OF))
    assert compaction.merged(spark, sink).count() == 0 and compaction.compact(spark, sink) is None
    _drops(spark, base, [("x", nth(0)), ("y", nth(1))])
    crashed = compaction.write_merged(spark, sink)      # the table is there, its manifest is not
    assert compaction.last_manifest(spark, sink) is None
    before = _rows(ingest.read_ingested(spark, sink))
    first = compaction.compact(spark, sink)
    assert first.version == 1 and first.table != crashed.table and compaction.compact(spark, sink) is None
    assert _rows(ingest.read_ingested(spark, sink)) == before
    with pytest.raises(FileExistsError):
        compaction.publish(spark, sink, crashed)
    _drops(spark, base, [("z", nth(2))])
    merged = compaction.merged(spark, sink)
    plan = explain_text(merged)
    old_side = plan.split("FullOuter")[1].split("FileScan")[0]
    assert plan.count("queuelens_merged_") == 1 and "Bucketed: true" in plan
    assert "Exchange" not in old_side and plan.count("Exchange") == 1     # history is read in its buckets, only the tail is shuffled
    assert _rows(ingest.read_ingested(spark, sink)) == want
    # a merged batch that is written again changes nothing
    again = spark.read.parquet(f"{sink}/batches/batch=0")
    rows = again.collect()
    spark.createDataFrame(rows, again.schema).write.mode("overwrite").parquet(f"{sink}/batches/batch=0")
    second = compaction.compact(spark, sink)
    assert (second.version, second.through) == (2, 2) and compaction.drop_unread(spark, sink) == 2
    assert _rows(ingest.read_ingested(spark, sink)) == want


def test_compaction_has_a_bucket_for_every_partition_of_the_readers_shuffles(spark):
    """With fewer buckets a reader's join shuffles the merged side as well, and a bucket grows with the input."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    raw = materialized_raw(spark, SF_SMALL)
    base, before = scratch_path(spark, "test_buckets"), spark.conf.get(key, None)
    spark.conf.set(key, "7")
    try:
        _drops(spark, base, [("x", raw.where("ingest_seq > 1"))])
        assert compaction.compact(spark, f"{base}/sink").buckets == 7
        _drops(spark, base, [("y", raw.where("ingest_seq = 1"))])
        plan = explain_text(compaction.merged(spark, f"{base}/sink"))
        assert "Bucketed: true" in plan and plan.count("Exchange") == 1
        assert _rows(ingest.read_ingested(spark, f"{base}/sink")) == _rows(cleaning.clean_pipeline(raw, fixtures.AS_OF))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _shuffle_files(spark):
    """Names of the shuffle files on this (local) session's disk."""
    files_ = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files_) if f.getName().startswith("shuffle_")}


def _left_over(spark, run):
    """Shuffle files that stay after ``run``; Spark drops them a moment after the job."""
    import time

    before = _shuffle_files(spark)
    run()
    for _ in range(20):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_ingest_leaves_no_cached_batch_no_staged_table_and_no_shuffle_files(spark, monkeypatch):
    raw = materialized_raw(spark, SF_SMALL)
    base = scratch_path(spark, "test_left_over")
    sinks.write_raw_csv(raw, f"{base}/source/x", compression="gzip")
    cached = []
    persist = type(raw).persist
    monkeypatch.setattr(type(raw), "persist", lambda self, *a: (cached.append(1), persist(self, *a))[1])
    assert not _left_over(spark, lambda: ingest.start_clean_ingest(
        spark, f"{base}/source/*", f"{base}/sink", f"{base}/checkpoint", fixtures.AS_OF).awaitTermination())
    assert not cached and not compaction._files(spark, f"{base}/sink/staged/*")
    assert not _left_over(spark, lambda: compaction.compact(spark, f"{base}/sink"))
    assert _rows(ingest.read_ingested(spark, f"{base}/sink")) == _rows(cleaning.clean_pipeline(raw, fixtures.AS_OF))


def test_drops_of_the_registry_are_compressed(spark):
    from queuelens.plans import catalog_more

    sink = catalog_more._ingest(spark, SF_SMALL)
    found = compaction._files(spark, f"{sink}/../source/drop*/part-*")
    assert found and all(f.endswith(".csv.gz") for f in found)


def test_raw_export_and_cleaned_rows_leave_no_shuffle_files_for_the_sort(spark, monkeypatch):
    from queuelens.plans import catalog_more, model

    monkeypatch.setattr(model, "_MEMO", {})
    assert not _left_over(spark, lambda: materialized_raw(spark, SF_SMALL))
    out = []
    assert not _left_over(spark, lambda: out.append(catalog_more.cl_project_sort(spark, SF_SMALL)))
    plan = explain_text(out[0])
    assert plan.count("Exchange") == 1 and "rangepartitioning(ticket_id" in plan   # the cleaning is not run again by the sort's sampling
    assert out[0].collect() == cleaning.project_sort(cleaning.clean_pipeline(materialized_raw(spark, SF_SMALL), fixtures.AS_OF)).collect()
