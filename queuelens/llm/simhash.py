"""SimHash near-dedup: fingerprints of word shingles, linked through covering-code anchors."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.llm.common import keep_rows, small_arrow_batches, table, text_of, written
from queuelens.llm.components import components
from queuelens.llm.covering import anchors

SHINGLE = 3      # words
THRESHOLD = 2    # differing bits
SEED = 42        # of XXH64
CHUNK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if set in over half the shingles' hashes.

    ``bytes.lower`` folds A-Z only and ``bytes.split`` cuts at ASCII white space only.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[i:i + n] for i in range(shingle))))
                             if len(words) >= shingle else [b" ".join(words)], repeat(SEED)), "<u8", n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[i:i + CHUNK].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(row, doc_id, text_key, fp) for each row, written."""
    small_arrow_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, shingle) for x in texts], np.uint64).view(np.int64), index=texts.index)

    named = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return written(named.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                F.xxhash64("text").alias("text_key"),
                                of(F.col("text").cast("binary")).alias("fp")), "fingerprints")


def links(fps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` that differ in at most ``threshold`` bits, each once.

    Every fingerprint goes to all anchors within covering radius + threshold,
    and is compared there with those whose home the anchor is.  A fingerprint
    has at most 2080 distinct others within two bits, so the result grows
    linearly however large a group of near copies is.  Both sides are
    shuffled: Spark sizes the anchors, some 150 a fingerprint, like the
    fingerprints, and would broadcast them.
    """
    def replicate(reach: int, name: str) -> DataFrame:
        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                fp = pdf["fp"].to_numpy(np.int64)
                for i in range(0, len(fp), 1 << 12):
                    part = fp[i:i + (1 << 12)]
                    at, anchor = anchors(part.view(np.uint64), reach)
                    yield pd.DataFrame({name: part[at], "anchor": anchor})
        return fps.select("fp").mapInPandas(each, f"{name} long, anchor long")

    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    return (replicate(0, "a").hint("merge").join(replicate(threshold, "b"), "anchor")
            .where((F.col("a") < F.col("b")) & near).select("a", "b"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, text_key, fp, component_id, kept.

    component_id is the smallest doc_id reachable over links, kept marks one
    row of each component (the smallest id's; null ids rank last).  Null and
    empty texts, and those of white space alone, have fingerprint zero and are
    linked like any other.  Repeated rows share fingerprint and component.  An
    empty table gives an empty result.
    """
    rows = fingerprints(docs, id_col, text_col, shingle)
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    fps = written(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct_fingerprints")
    roots = components(links(fps, threshold))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    named = written(named, "fingerprint_roots")
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    group = written(named.join(best, "root").select("fp", "best"), "fingerprint_groups")
    # a hot fingerprint's rows are split by the adaptive skew join: both sides are plain tables
    return rows.join(group, "fp").select("doc_id", "text_key", "fp", F.col("best.doc_id").alias("component_id"),
                                         (F.col("row") == F.col("best.row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns."""
    return keep_rows(docs, simhash_groups(docs, id_col, text_col, shingle, threshold).where("kept"), id_col, text_col)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
