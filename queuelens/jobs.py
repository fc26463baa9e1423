"""Batch jobs for spark-submit: the end-to-end path from exports to answers.

    spark-submit -m queuelens.jobs clean   --raw RAW_CSV --out CLEAN --as-of "2026-07-30 23:59:59"
    spark-submit -m queuelens.jobs star    --clean CLEAN --category CAT_CSV --channel CH_CSV --agent AG_CSV --out STAR
    spark-submit -m queuelens.jobs catalog --star STAR --out RESULTS
    spark-submit -m queuelens.jobs mart    --star STAR --out MART
    spark-submit -m queuelens.jobs panels  --star STAR | --mart MART --out PANELS [--start DAY --end DAY --category NAME ... --channel NAME ... --incident-only]
    spark-submit -m queuelens.jobs export  --star STAR --out CSV    [the same selection]
    spark-submit -m queuelens.jobs datasets --star STAR --out DATASETS
    spark-submit -m queuelens.jobs sql     --star STAR --query FILE --out CSV
    spark-submit -m queuelens.jobs ingest  --source CSV_DROPS --sink SINK --checkpoint CKPT --as-of "..."
    spark-submit -m queuelens.jobs compact --sink SINK

(or ``python -m queuelens.jobs ...`` with a local master).  Each job reads
and writes shared storage only; nothing but small result counts reaches the
driver.  ``clean`` refuses to finish if the quality gate fails.
"""

from __future__ import annotations

import argparse
import datetime
import json
import sys
import uuid

from pyspark.sql import SparkSession

from queuelens.schemas import CSV_QUOTES


def job_clean(spark: SparkSession, raw: str, out: str, as_of: str) -> dict:
    from queuelens.operators.cleaning import run_clean_pipeline
    from queuelens.sources.files import read_raw_csv

    return run_clean_pipeline(read_raw_csv(spark, raw), as_of, out)


def job_star(spark: SparkSession, clean: str, category: str, channel: str, agent: str, out: str,
             layout: str = "time") -> dict:
    from queuelens.operators import quality
    from queuelens.plans.model import Star, add_unassigned, write_star
    from queuelens.schemas import FACT_COLUMNS
    from queuelens.session import replace_folder
    from queuelens.sources.files import read_clean, read_dims_csv

    cat, ch, ag = read_dims_csv(spark, category, channel, agent)
    fact = read_clean(spark, clean).select(*FACT_COLUMNS)
    star = Star(fact=fact, dim_category=cat, dim_channel=ch, dim_agent=add_unassigned(ag))
    broken = {k: n for k, n in quality.assertion_counts(fact).first().asDict().items() if n}
    if broken:
        raise quality.DataQualityError(f"data quality gate failed for {clean}: {broken}")
    orphans = {k: quality.fk_orphan_keys(fact, dim, k).count()
               for k, dim in (("category_id", star.dim_category), ("channel_id", star.dim_channel),
                              ("agent_id", star.dim_agent))}
    if any(orphans.values()):
        raise quality.DataQualityError(f"foreign keys without a dimension member: {orphans}")
    staged = f"{out.rstrip('/')}.staged-{uuid.uuid4().hex}"
    write_star(star, staged, layout)    # four tables that belong together are published together
    replace_folder(spark, staged, out)
    return {"orphans": orphans}


def job_catalog(spark: SparkSession, star_path: str, out: str) -> dict:
    """Run the 19 questions over a written star; each answer is written as CSV."""
    from queuelens.plans.model import read_star
    from queuelens.plans.queries import QUERIES

    star = read_star(spark, star_path)
    rows = {}
    for key, fn in QUERIES.items():
        df = fn(star)
        df.write.mode("overwrite").option("header", True).options(**CSV_QUOTES).csv(f"{out}/{key}")
        rows[key] = spark.read.option("header", True).options(**CSV_QUOTES).csv(f"{out}/{key}").count()
    return rows


def job_mart(spark: SparkSession, star_path: str, out: str) -> dict:
    from queuelens.plans.mart import build_agent_mart, build_cause_mart, build_hours_histogram, build_mart, mart_enriched
    from queuelens.plans.model import read_star

    star = read_star(spark, star_path)
    mart_enriched(build_mart(star.fact), star).write.mode("overwrite").parquet(f"{out}/daily")
    mart_enriched(build_cause_mart(star.fact), star).write.mode("overwrite").parquet(f"{out}/causes")
    build_agent_mart(star.fact).write.mode("overwrite").parquet(f"{out}/agents")
    build_hours_histogram(star.fact).write.mode("overwrite").parquet(f"{out}/hours_histogram")
    return {"mart_rows": spark.read.parquet(f"{out}/daily").count()}


def job_panels(spark: SparkSession, out: str, choice, star_path: str | None = None, mart_path: str | None = None) -> dict:
    """The filter panels of one selection, each as CSV: from the marts, or from one scan of the star."""
    from queuelens.operators import filters
    from queuelens.plans.mart import mart_panels
    from queuelens.plans.model import read_star
    from queuelens.session import scratch_path

    if mart_path:
        panels = mart_panels(spark.read.parquet(f"{mart_path}/daily"), spark.read.parquet(f"{mart_path}/causes"), choice)
    else:
        aside = scratch_path(spark, "panel_cube")
        cube = filters.panel_cube(filters.t_filter(filters.t_panel(read_star(spark, star_path)), choice))
        cube.write.parquet(aside)
        panels = filters.panels_of(spark.read.schema(cube.schema).parquet(aside))
    for name, df in panels.items():
        df.write.mode("overwrite").option("header", True).options(**CSV_QUOTES).csv(f"{out}/{name}")
    return {"panels": len(panels)}


def job_export(spark: SparkSession, star_path: str, out: str, choice) -> dict:
    """The detail rows of one selection as CSV."""
    from queuelens.operators import filters
    from queuelens.plans.model import read_star
    from queuelens.sources.sinks import write_detail_csv

    write_detail_csv(filters.t_drill(filters.t_filter(filters.t_load(read_star(spark, star_path)), choice)), out)
    return {"rows": spark.read.option("header", True).options(**CSV_QUOTES, multiLine="true").csv(out).count()}


def job_datasets(spark: SparkSession, star_path: str, out: str) -> dict:
    """The workbook, preview, sanity and report datasets over a written star, each as CSV."""
    from queuelens.plans import dashboards, reports
    from queuelens.plans.model import read_star
    from queuelens.sources.sinks import EXPORT

    star = read_star(spark, star_path)
    named = {k: fn for module in (dashboards, reports) for k, fn in vars(module).items() if k.split("_")[0] in ("x", "p", "bd", "r") and callable(fn)}
    for key, fn in named.items():
        fn(star).write.mode("overwrite").options(**EXPORT).csv(f"{out}/{key}")
    return {"datasets": sorted(named)}


def job_sql(spark: SparkSession, star_path: str, query: str, out: str) -> dict:
    """One SQL statement, read from a file, over the tables of a written star; the answer as CSV."""
    from queuelens.plans.model import read_star
    from queuelens.sources.files import sql_view
    from queuelens.sources.sinks import EXPORT

    star = read_star(spark, star_path)
    text = spark.read.text(query, wholetext=True).first()[0]
    tables = {"fact_complaints": star.fact, "dim_category": star.dim_category, "dim_channel": star.dim_channel, "dim_agent": star.dim_agent}
    answer = sql_view(spark, text.strip().rstrip(";"), tables)
    answer.write.mode("overwrite").options(**EXPORT).csv(out)
    return {"columns": answer.columns}


def job_ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, as_of: str, numbered: bool | None = None) -> dict:
    """Take in what has arrived since the last run, then stop."""
    from queuelens.streaming.compaction import last_manifest, tail_batches
    from queuelens.streaming.ingest import start_clean_ingest

    start_clean_ingest(spark, source, sink, checkpoint, as_of, numbered=numbered).awaitTermination()
    m = last_manifest(spark, sink)
    return {"batches_to_merge": len(tail_batches(spark, sink, m.through if m else -1))}


def job_compact(spark: SparkSession, sink: str) -> dict:
    """Merge the batches taken in so far; merged tables that nobody needs any more go."""
    from queuelens.streaming.compaction import compact, drop_unread

    m = compact(spark, sink)
    return {"version": m.version if m else None, "dropped": drop_unread(spark, sink)}


def _choice(args):
    from queuelens.operators.filters import TicketFilter

    day = lambda x: datetime.date.fromisoformat(x) if x else None
    return TicketFilter(start=day(args.start), end=day(args.end), categories=args.category, channels=args.channel,
                        incident_only=args.incident_only)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="queuelens.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--raw", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--as-of", required=True)
    s = sub.add_parser("star")
    for a in ("--clean", "--category", "--channel", "--agent", "--out"):
        s.add_argument(a, required=True)
    s.add_argument("--layout", choices=("time", "interleaved"), default="time")
    q = sub.add_parser("catalog")
    q.add_argument("--star", required=True)
    q.add_argument("--out", required=True)
    m = sub.add_parser("mart")
    m.add_argument("--star", required=True)
    m.add_argument("--out", required=True)
    for name in ("panels", "export"):
        f = sub.add_parser(name)
        source = f.add_mutually_exclusive_group(required=True)
        source.add_argument("--star")
        if name == "panels":
            source.add_argument("--mart")
        f.add_argument("--out", required=True)
        f.add_argument("--start")
        f.add_argument("--end")
        f.add_argument("--category", action="append")
        f.add_argument("--channel", action="append")
        f.add_argument("--incident-only", action="store_true")
    for name, options in {"datasets": ("--star", "--out"), "sql": ("--star", "--query", "--out"),
                          "ingest": ("--source", "--sink", "--checkpoint", "--as-of"), "compact": ("--sink",)}.items():
        d = sub.add_parser(name)
        for a in options:
            d.add_argument(a, required=True)
    args = p.parse_args(argv)

    if spark is None:
        from queuelens.session import build_session
        spark = build_session()
    from queuelens.session import ensure_timezone
    ensure_timezone(spark)

    if args.job == "clean":
        result = job_clean(spark, args.raw, args.out, args.as_of)
    elif args.job == "star":
        result = job_star(spark, args.clean, args.category, args.channel, args.agent, args.out, args.layout)
    elif args.job == "catalog":
        result = job_catalog(spark, args.star, args.out)
    elif args.job == "panels":
        result = job_panels(spark, args.out, _choice(args), args.star, args.mart)
    elif args.job == "export":
        result = job_export(spark, args.star, args.out, _choice(args))
    elif args.job == "datasets":
        result = job_datasets(spark, args.star, args.out)
    elif args.job == "sql":
        result = job_sql(spark, args.star, args.query, args.out)
    elif args.job == "ingest":
        result = job_ingest(spark, args.source, args.sink, args.checkpoint, args.as_of)
    elif args.job == "compact":
        result = job_compact(spark, args.sink)
    else:
        result = job_mart(spark, args.star, args.out)
    print(json.dumps({"job": args.job, **result}))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
