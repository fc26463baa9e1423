"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets of bounded size.  For a query whose
k-th best score so far is t, a bucket whose longest vector has length l can
only hold a better one if its cosine reaches t / (|q| l), the bucket's local
threshold.  Above 1 the bucket is left out; for a low threshold it is scanned
down to the length below which even a parallel vector falls short; for a high
one, coordinates bound the candidates: a unit vector of cosine >= c with q has
each coordinate within [q_f c - s, q_f c + s], s = sqrt((1 - c^2)(1 - q_f^2)).
All products of what is left are verified in whole numbers.

Queries and buckets meet as blocks on a grid: both sides are dealt out in
blocks of bounded size, so each task holds one block of either.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import table, written

SCALE = 1024
K = 10
QUERY_EVERY = 100
BUCKET_ROWS = 4096       # candidates in a block at most, but for the spread of a hash
QUERY_ROWS = 1024        # queries in a block, likewise
LENGTH_CLASSES = 20      # length classes to a factor of e
COORDINATES = 4          # coordinates of a query that prune
HIGH = 0.6               # local cosine threshold from which coordinates prune
EXACT = 2.0 ** 53        # products below are exact in doubles


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v, length2): components floor(scale * x); vectors null, empty or with null or non-finite parts go."""
    x = df[vec_col].cast("array<double>")
    named = df.select(F.monotonically_increasing_id().alias("row"), df[id_col].cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    v = named.select("row", "vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    return v.withColumn("length2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products: in doubles where they are exact, else in 64-bit integers; an error where those could wrap."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if bound < EXACT:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if bound >= 2.0 ** 63:
        raise OverflowError("components are too large: an inner product may not fit into 64 bits")
    return a @ b.T


def best_in_block(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of a block for each query that can still beat the query's ``least`` score."""
    width = max([1, *map(len, queries["v"]), *map(len, block["v"])])
    block = block.sort_values(["length2", "vec_id"], ascending=[False, True], kind="stable")
    c, q = _matrix(block["v"], width), _matrix(queries["v"], width)
    ids, rows = block["vec_id"].to_numpy(), block["row"].to_numpy()
    lengths, q_lengths = np.sqrt((c.astype(float) ** 2).sum(1)), np.sqrt((q.astype(float) ** 2).sum(1))
    unit = c / np.maximum(lengths, 1e-300)[:, None]
    least = queries["least"].to_numpy(float, na_value=-np.inf)
    q_rows, q_ids = queries["row"].to_numpy(), queries["vec_id"].to_numpy()

    # a threshold that is positive prunes; one ulp-sized slack keeps ties on its edge
    slack = 1 - 1e-9
    need = np.where(q_lengths > 0, least * slack / np.maximum(q_lengths, 1e-300), -np.inf)
    reach = np.where(need > 0, np.searchsorted(-lengths, -need, "right"), len(c))   # LENGTH: candidates long enough
    local = np.where(need > 0, need / max(lengths[0], 1e-300), 0.0)                 # local cosine threshold
    out = []

    def keep(n: int, at: np.ndarray, scores: np.ndarray) -> None:
        other = rows[at] != q_rows[n]
        at, scores = at[other], scores[other]
        if np.isfinite(least[n]):
            good = scores >= least[n]
            at, scores = at[good], scores[good]
        if len(at) > k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            good = scores >= edge
            at, scores = at[good], scores[good]
        best = np.lexsort((ids[at], -scores))[:k]
        out.extend(zip(np.repeat(q_rows[n], len(best)), np.repeat(q_ids[n], len(best)), ids[at[best]], scores[best], strict=True))

    scan = np.flatnonzero((local <= HIGH) & (reach > 0))
    for i in range(0, len(scan), 256):
        part = scan[i:i + 256]
        longest = int(reach[part].max())
        scores = _products(q[part], c[:longest])
        for n, s in zip(part, scores, strict=True):
            keep(n, np.arange(reach[n]), s[:reach[n]])
    for n in np.flatnonzero((local > HIGH) & (local <= 1) & (reach > 0)):
        u = q[n] / q_lengths[n]
        cos = np.minimum(need[n] / np.maximum(lengths[:reach[n]], 1e-300), 1.0)   # each candidate's own threshold
        left = np.arange(reach[n])
        for f in np.argsort(-np.abs(u))[:COORDINATES]:
            t = cos[left]
            spread = np.sqrt((1 - t * t) * max(0.0, 1 - u[f] * u[f])) + 1e-9
            left = left[np.abs(unit[left, f] - u[f] * t) <= spread] if u[f] * u[f] < 1e-18 else \
                left[(unit[left, f] >= u[f] * t - spread) if u[f] > 0 else (unit[left, f] <= u[f] * t + spread)]
        if len(left):
            keep(n, left, _products(q[n:n + 1], c[left])[0])
    return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"]).astype("int64")


def _search(grid_queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    def each(_, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({x: np.zeros(0, np.int64) for x in ("query_row", "query_id", "vec_id", "score")})
        return best_in_block(q, c, k)

    return grid_queries.groupBy("q_block", "block").cogroup(blocks.groupBy("q_block", "block")).applyInPandas(
        each, "query_row long, query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_row, query_id, rank, vec_id, score of the k largest inner products, ties to the smaller id.

    Both tables come from ``whole_vectors`` (one numbering: a query's own row
    is not its candidate) and are written.  Shorter vectors count as padded by
    zeros.  Queries without any candidate have no rows.
    """
    size = F.greatest(F.lit(1e-9), F.sqrt("length2"))
    classed = candidates.withColumn("class", F.floor(F.log(size) * LENGTH_CLASSES).cast("int"))
    counts = {r["class"]: r["count"] for r in classed.groupBy("class").count().collect()}  # a few hundred classes at most
    n_queries = queries.count()
    if not counts or not n_queries:
        return candidates.sparkSession.createDataFrame([], "query_row long, query_id long, rank int, vec_id long, score long")
    first, blocks = {}, 0
    for c in sorted(counts, reverse=True):   # longest first
        first[c] = (blocks, math.ceil(counts[c] / BUCKET_ROWS))
        blocks += first[c][1]
    q_blocks = math.ceil(n_queries / QUERY_ROWS)

    lookup = lambda i: F.create_map(*[x for c, v in first.items() for x in (F.lit(c), F.lit(v[i]))])[F.col("class")]
    dealt = classed.withColumn("block", (lookup(0) + F.pmod(F.xxhash64("row"), lookup(1))).cast("int"))
    asked = queries.toDF(*queries.columns).withColumn("q_block", F.pmod(F.xxhash64("row", F.lit("q")), F.lit(q_blocks)).cast("int"))

    every_q = F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block")
    cand = dealt.select("block", "row", "vec_id", "v", "length2", every_q)

    # first the block of the longest vectors: its k-th best score is where the others must begin
    head = asked.select("q_block", F.lit(0).alias("block"), "row", "vec_id", "v", F.lit(None).cast("long").alias("least"))
    top = written(_ranked(_search(head, cand.where("block = 0"), k), k), "topk_first")
    if blocks == 1:
        return _ranked(top.drop("rank"), k).select("query_row", "query_id", "rank", "vec_id", "score")
    least = top.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("least"))
    every = F.explode(F.sequence(F.lit(1), F.lit(blocks - 1))).alias("block")
    rest = asked.join(least, "row", "left").select("q_block", every, "row", "vec_id", "v", "least")
    found = top.drop("rank").union(_search(rest, cand.where("block > 0"), k))
    return _ranked(found, k).select("query_row", "query_id", "rank", "vec_id", "score")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = written(whole_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0)).select("query_id", "rank", "vec_id", "score")


OP6_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
parts AS (SELECT r, vec_id, unnest(e) AS c, generate_subscripts(e, 1) AS i FROM v),
scores AS (
  SELECT q.r, q.vec_id AS query_id, p.r AS pr, p.vec_id, sum(q.c * p.c)::BIGINT AS score
  FROM parts q JOIN parts p ON q.i = p.i AND q.r <> p.r
  WHERE q.vec_id % {QUERY_EVERY} = 0 GROUP BY q.r, q.vec_id, p.r, p.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
WHERE rank <= {K}
"""
