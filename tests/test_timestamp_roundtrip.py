"""Round trip: random wall-clock times rendered in each raw layout parse back.

Covers the 12-hour clock edges (00:xx is 12:xx AM, 12:xx is 12:xx PM),
month names and unpadded day / month numbers."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from queuelens.functions import timestamps


def _samples(n=400, seed=11):
    rnd = random.Random(seed)
    base = dt.datetime(1990, 1, 1)
    out = [base + dt.timedelta(seconds=rnd.randrange(0, 40 * 365 * 86400)) for _ in range(n)]
    out += [dt.datetime(2026, 2, 5, 0, 7, 9), dt.datetime(2026, 2, 5, 12, 7, 9),
            dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2026, 12, 31, 0, 0, 0)]
    return out


def _renderings(t: dt.datetime):
    hour12 = t.hour % 12 or 12
    ampm = "AM" if t.hour < 12 else "PM"
    no_secs = t.replace(second=0)
    return [
        (t.strftime("%Y-%m-%d %H:%M:%S"), t),
        (t.strftime("%d/%m/%Y %H:%M"), no_secs),
        (f"{t.day}/{t.month}/{t.year} {t.hour}:{t.minute:02d}", no_secs),            # unpadded
        (f"{t.month:02d}-{t.day:02d}-{t.year} {hour12:02d}:{t.minute:02d} {ampm}", no_secs),
        (f"{t.month:02d}-{t.day:02d}-{t.year} {hour12:02d}:{t.minute:02d} {ampm.lower()}", no_secs),
        (t.strftime("%d-%b-%Y %H:%M:%S"), t),
        (t.strftime("%d-%b-%Y %H:%M:%S").upper(), t),
    ]


def test_every_layout_round_trips(spark):
    rows = [(text, want) for t in _samples() for text, want in _renderings(t)]
    df = spark.createDataFrame(rows, "text string, want timestamp_ntz")
    got = df.select("text", "want", timestamps.parse_mixed_timestamp("text").alias("got"))
    bad = got.filter(~F.col("got").eqNullSafe(F.col("want"))).limit(5).collect()
    assert not bad, bad
