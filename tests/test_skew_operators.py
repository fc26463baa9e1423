"""Skew-safe operators against brute force, including one key holding a third of the rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from queuelens.operators import cleaning, median
from queuelens.operators.sequence import sequence_within_key
from tests.conftest import explain_text


def _hot_key_frame(spark, n=6000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 42 if i % 3 == 0 else rnd.randrange(200)     # key 42 holds a third of all rows
        rows.append((k, rnd.randrange(10_000), rnd.random()))
    return spark.createDataFrame(rows, "k long, o long, v double")


def test_sequence_equals_row_number_under_skew(spark):
    df = _hot_key_frame(spark)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o", "v")))
    got = sequence_within_key(df, ["k"], ["o", "v"], "seq", F.floor(F.col("o") / 700))
    j = ref.join(got, ["k", "o", "v"])
    assert j.count() == df.count()
    assert j.filter(F.col("rn") != F.col("seq")).count() == 0


def test_sequence_splits_a_hot_key_and_uses_no_python(spark):
    df = _hot_key_frame(spark).withColumn("part", F.floor(F.col("o") / 700))
    most = df.groupBy("k", "part").count().agg(F.max("count")).first()[0]
    assert most < df.filter("k = 42").count() / 5
    plan = explain_text(sequence_within_key(df, ["k"], ["o", "v"], "seq", F.col("part")))
    assert "Pandas" not in plan and "Python" not in plan and "SinglePartition" not in plan


def test_dedup_keeps_minimum_sequence_under_skew(spark):
    df = _hot_key_frame(spark).withColumn("ingest_seq", F.col("o")).withColumn("ticket_id", F.col("k"))
    got = {r.ticket_id: r.ingest_seq for r in cleaning.dedup_first(df).collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg(F.min("o").alias("m")).collect()}
    assert got == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_upper_median_matches_sorted_list(spark, seed):
    rnd = random.Random(seed)
    vals = [round(rnd.uniform(-5, 500), 2) for _ in range(rnd.randrange(1, 3000))]
    vals += [vals[0]] * 500                    # a heavy value
    df = spark.createDataFrame([(v,) for v in vals], "h double")
    want = sorted(vals)[len(vals) // 2]
    assert median.upper_median(df, "h").first()[0] == want


def test_sequence_of_hot_and_null_keys_and_one_shuffle_of_the_rest(spark):
    """Hot keys (a null one too) are numbered in parts, the others by one window over the key: no second one, no wide join."""
    df = _hot_key_frame(spark).withColumn("k", F.expr("nullif(k, 7)")).withColumn("w", F.lit("wide"))
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o", "v", "w")))
    for hot_rows in (1, 20, 1000, 100_000):
        got = sequence_within_key(df, ["k"], ["o", "v"], "seq", F.floor(F.col("o") / 700), hot_rows)
        assert got.columns == [*df.columns, "seq"]
        assert sorted(map(str, got.collect())) == sorted(map(str, ref.withColumnRenamed("rn", "seq").collect()))
    few = sequence_within_key(df, ["k"], ["o", "v"], "seq", F.floor(F.col("o") / 700))
    few.count()
    assert "LeftAnti" in explain_text(few)


def test_tasks_are_sized_by_the_input(spark):
    from queuelens.session import READ_BYTES, TASK_ROWS, bounded_tasks
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    try:
        bounded_tasks(spark, 1000 * TASK_ROWS + 1)
        assert spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() <= READ_BYTES
        assert spark.conf.get(names[1]) == "1001"
        bounded_tasks(spark, 1)
        assert spark.conf.get(names[1]) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        for name in names:
            spark.conf.unset(name)
