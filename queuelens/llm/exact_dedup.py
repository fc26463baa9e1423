"""Exact dedup: tree-merge of sorted digest runs, with DataFrame operations only.

Every scan partition is a leaf run of (digest, length, best row, count)
entries.  Runs meet in binomial rounds: in each round the runs whose numbers
agree above the lowest ``FAN_BITS`` bits exchange their entries by (parent
run, digest) and are merged into one sorted run.  An entry is united with
another only if the whole SHA-256 and the byte length agree, so every level
holds verified survivors.  A digest shared by a third of all rows is reduced
to one entry per run in the map task before it is exchanged, and never meets
in one task in full.

The way back goes down the same tree: each level's entries join their
parent's, the leaves' rows join the lowest level's.  A hot digest has at most
``2**FAN_BITS`` entries per parent on inner levels, and at a leaf as many rows
as the scan partitions of its run hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.llm.common import ASCII_LOWER, ASCII_UPPER, keep_rows, table, text_of, written

RUN_BITS = 12   # leaf runs: scan partitions folded onto 2**12 numbers
FAN_BITS = 4    # 16 runs merge into one in a round
ENTRY = ["digest", "n_bytes"]


def with_digest(df: DataFrame, text_col: str = "text", name: str = "digest") -> DataFrame:
    """``df`` plus the SHA-256 of the text after lower-casing A-Z only."""
    norm = F.translate(text_of(df, text_col), ASCII_UPPER, ASCII_LOWER)
    return df.withColumn(name, F.unhex(F.sha2(norm, 256)))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "max") -> DataFrame:
    """One row per input row: doc_id, text_key, keep_id, group_size, kept, digest.

    Texts are equal when identical after lower-casing A-Z; null is empty.
    ``keep``: of equal texts the row with the largest ("max") or smallest
    ("min") id stays.  Null ids rank below (max) or above (min) all others.  Of
    rows that repeat the id as well, exactly one stays.  An empty table gives
    an empty result; other columns of ``docs`` are not looked at.
    """
    best = {"max": F.max, "min": F.min}[keep]
    rank = F.col("doc_id") if keep == "max" else F.coalesce("doc_id", F.lit(2**63 - 1))
    leaves = written(
        with_digest(docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text")))
        .select("doc_id", F.xxhash64("text").alias("text_key"), "digest", F.octet_length("text").alias("n_bytes"),
                F.spark_partition_id().bitwiseAND((1 << RUN_BITS) - 1).alias("run"),
                F.monotonically_increasing_id().alias("row")),
        "digest_leaves")

    parent = F.shiftright("run", FAN_BITS).alias("run")
    runs = leaves.select("run", *ENTRY, F.struct(rank.alias("rank"), "row", "doc_id").alias("best"),
                         F.lit(1).cast("long").alias("size"))
    levels = []
    for _ in range(RUN_BITS // FAN_BITS):
        merged = (runs.groupBy(parent, *ENTRY).agg(best("best").alias("best"), F.sum("size").alias("size"))
                  .sortWithinPartitions("run", *ENTRY))
        runs = written(merged, "digest_runs")
        levels.append(runs)

    survivors = levels.pop()
    up = F.shiftright("run", FAN_BITS)
    for level in reversed(levels):
        survivors = _join_parent(level.select("run", *ENTRY, up.alias("parent")), survivors).drop("parent")
    rows = _join_parent(leaves.withColumn("parent", up), survivors)
    return rows.select("doc_id", "text_key", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                       (F.col("row") == F.col("best.row")).alias("kept"), "digest")



def _join_parent(children: DataFrame, parents: DataFrame) -> DataFrame:
    above = parents.select(F.col("run").alias("parent"), *ENTRY, "best", "size")
    return children.join(above, ["parent", *ENTRY])


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, exact_duplicates(docs, id_col, text_col, keep).where("kept"), id_col, text_col)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP9_SQL = f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}')) AS h FROM documents)
WINDOW g AS (PARTITION BY h)
"""
