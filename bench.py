"""Benchmark: ETL + the analytical catalog at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Steps (each timed):
  * ``etl_star``     -- driver tables -> cleaned star (dedup, joins, SLA
                        derivation) -> Parquet, fact partitioned by month;
  * ``etl_clean``    -- raw export (staged once, untimed) -> full cleaning
                        pipeline -> quality gate -> Parquet;
  * ``mart_build``   -- the additive daily mart from the written fact;
  * every catalog query (q_*), dashboard panels and report metrics over the
    written star, and the filter panels both from the detail (t_*) and from
    the mart (mart_t_*), each ``collect()``-ed: median of ``BENCH_REPS`` runs
    after one warm-up run.

Prints ONE JSON line: {"metric", "value" (sum of medians, sec), "unit",
"queries" {key: median sec}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from queuelens.session import build_session, drop_scratch, scratch_path

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
             "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)}
    spark = build_session(f"local[{cpus}]", app="queuelens-bench",
                          shuffle_partitions=max(8, 2 * cpus), extra=extra)
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="queuelens-bench-"))

    from queuelens.operators import cleaning, filters
    from queuelens.plans import dashboards as X
    from queuelens.plans import queries as Q
    from queuelens.plans import reports as R
    from queuelens.plans.catalog_more import REGISTRY_FILTER
    from queuelens.plans.model import read_star, star_from_fixture, write_star
    from queuelens.sources import fixtures

    timings: dict[str, float] = {}

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    # -------------------------------------------------------------- ETL
    star_paths = []

    def build_star():
        p = scratch_path(spark, "bench_star")
        write_star(star_from_fixture(spark, sf_dir), p)
        star_paths.append(p)

    build_star()  # warm-up (JVM class loading, codegen)
    etl = [timed(build_star) for _ in range(max(1, reps - 1))]
    timings["etl_star"] = statistics.median(etl)
    star = read_star(spark, star_paths[-1])

    raw_path = scratch_path(spark, "bench_raw")
    fixtures.raw_fact(spark, sf_dir).write.mode("overwrite").parquet(raw_path)  # staging, untimed
    raw = spark.read.parquet(raw_path)

    def clean_once():
        cleaning.run_clean_pipeline(raw, fixtures.AS_OF, scratch_path(spark, "bench_clean"))

    clean_once()  # warm-up
    timings["etl_clean"] = statistics.median([timed(clean_once) for _ in range(max(1, reps - 1))])

    # -------------------------------------------------------------- queries
    panels = {
        **Q.QUERIES,
        "x_kpis": X.x_kpis, "p_incident": X.p_incident, "bd_sanity": X.bd_sanity,
        "r_group_top_cause": R.r_group_top_cause, "r_salary_lift": R.r_salary_lift,
        "r_incident_lift": R.r_incident_lift,
    }
    fdf = filters.t_filter(filters.t_panel(star), REGISTRY_FILTER)
    filter_panels = {
        "t_kpis": lambda: filters.t_kpis(fdf), "t_category": lambda: filters.t_category(fdf),
        "t_monthly": lambda: filters.t_monthly(fdf), "t_root_causes8": lambda: filters.t_root_causes8(fdf),
        "t_drill": lambda: filters.t_drill(filters.t_filter(filters.t_load(star), REGISTRY_FILTER)),
    }
    # the scalable dashboard path: build the additive mart once, panels roll up from it
    from queuelens.plans import mart as M

    mart_paths = []

    def build_mart():
        p = scratch_path(spark, "bench_mart")
        # denormalized: names attached once at build time, panels are scans + aggregates
        M.mart_enriched(M.build_mart(star.fact), star).write.mode("overwrite").parquet(f"{p}/daily")
        M.mart_enriched(M.build_cause_mart(star.fact), star).write.mode("overwrite").parquet(f"{p}/causes")
        mart_paths.append(p)

    build_mart()  # warm-up
    timings["mart_build"] = statistics.median([timed(build_mart) for _ in range(max(1, reps - 1))])
    fm, fc = (M.mart_filter(spark.read.parquet(f"{mart_paths[-1]}/{name}"), REGISTRY_FILTER) for name in ("daily", "causes"))
    filter_panels.update({
        "mart_t_kpis": lambda: M.mart_t_kpis(fm), "mart_t_category": lambda: M.mart_t_category(fm),
        "mart_t_monthly": lambda: M.mart_t_monthly(fm), "mart_t_root_causes8": lambda: M.mart_t_root_causes8(fc),
    })

    jobs = {k: (lambda fn=fn: fn(star).collect()) for k, fn in panels.items()}
    jobs.update({k: (lambda fn=fn: fn().collect()) for k, fn in filter_panels.items()})
    for key, job in jobs.items():
        job()  # warm-up
        timings[key] = statistics.median([timed(job) for _ in range(reps)])

    fact_rows, mart_rows = star.fact.count(), spark.read.parquet(f"{mart_paths[-1]}/daily").count()
    out = {
        "metric": "etl_plus_catalog_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": sf,
        "cpus": cpus,
        "reps": reps,
        "tickets": fact_rows,
        "mart_rows": mart_rows,
    }
    drop_scratch(spark)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
