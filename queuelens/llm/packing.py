"""Packing by non-negative least squares over length combinations.

Each document's ids (and an end id) are cut into full windows and one tail.
Piece lengths fall into ``CLASSES`` classes (rounded up), whose histogram is
all that the driver sees.  Shallow combinations of classes that fill a window
are the columns of a non-negative least-squares problem against the histogram;
its rounded solution says how often each combination is laid out, and what is
left over is packed greedily, again by class.  Every piece then finds its
place by its rank within its class: ranks come from counts of hashed buckets,
so a class that holds most pieces is still numbered in many tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import shuffle_partitions, small_arrow_batches, table, text_of, written
from queuelens.llm.wordtokens import encoder

WINDOW = 2048
CLASSES = 128   # of WINDOW // CLASSES ids each
DEPTH = 3       # pieces in an enumerated combination
END_ID = 1

PIECES = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
        end_id: int = END_ID) -> DataFrame:
    """The pieces of every document, written: full windows from its start, then a tail.

    A null or empty text has the end id alone.
    """
    small_arrow_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        for pdf in batches:
            out = []
            for row, doc, ids in zip(pdf["row"], pdf["doc_id"], encode(pdf["text"].tolist()), strict=True):
                ids += end
                n = len(ids) // 4
                out += [(row, doc, s, min(window, n - s), crc32(ids[4 * s:4 * (s + window)]), n) for s in range(0, n, window)]
            frame = pd.DataFrame(out, columns=["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield frame.astype({"doc_id": "Int64"})

    named = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                        text_of(docs, text_col).cast("binary").alias("text"))
    return written(named.mapInPandas(each, PIECES), "pieces")


def combinations_filling(classes: int = CLASSES, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Non-increasing tuples of up to ``depth`` classes whose sum is ``classes``."""
    out, todo = [], [((), classes)]
    while todo:
        head, room = todo.pop()
        for c in range(min(room, head[-1] if head else classes), 0, -1):
            if c == room:
                out.append((*head, c))
            elif len(head) + 1 < depth:
                todo.append(((*head, c), room - c))
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Least squares with x >= 0 by an active set: free the steepest variable, step back to the boundary when one turns negative."""
    x = np.zeros(a.shape[1])
    free: list[int] = []
    tol = 1e-9 * max(1.0, np.abs(b).max())
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        k = int(slope.argmax())
        if slope[k] <= tol:
            break
        free.append(k)
        while free:
            s = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[free] = s
                break
            old = x[free]
            bad = s <= 0
            step = np.min(old[bad] / np.maximum(old[bad] - s[bad], 1e-300))
            moved = old + step * (s - old)
            x[:] = 0
            x[free] = np.maximum(moved, 0)
            free = [f for f, m, w in zip(free, moved, bad, strict=True) if not (w and m <= tol)]
    return x


def plan(histogram: dict[int, int], classes: int = CLASSES, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """[(combination of classes, how many sequences)] that uses up the histogram exactly."""
    left = Counter({c: n for c, n in histogram.items() if n})
    out: list[tuple[tuple[int, ...], int]] = []
    shapes = [s for s in combinations_filling(classes, depth) if all(left[c] for c in s)]
    if shapes:
        a = np.zeros((classes, len(shapes)))
        for k, shape in enumerate(shapes):
            np.add.at(a[:, k], np.array(shape) - 1, 1)
        b = np.array([left[c + 1] for c in range(classes)], float)
        x = nnls(a, b / b.max()) * b.max()
        for k in np.argsort(-x):
            need = Counter(shapes[k])
            n = min([int(x[k] + 0.5), *(left[c] // m for c, m in need.items())])
            if n > 0:
                out.append((shapes[k], n))
                left.subtract({c: n * m for c, m in need.items()})
    while left := +left:  # greedy: the largest class first, then what fits; each round uses up a class
        shape, room, rest = [], classes, Counter(left)
        for c in sorted(left, reverse=True):
            while c <= room and rest[c]:
                shape.append(c)
                room -= c
                rest[c] -= 1
        need = Counter(shape)
        n = min(left[c] // m for c, m in need.items())
        out.append((tuple(shape), n))
        left.subtract({c: n * m for c, m in need.items()})
    return out


def slots(shapes: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """class -> rows (first rank, first sequence, pieces of the class in the shape, first slot), by rank."""
    table_: dict[int, list] = {}
    taken: Counter = Counter()
    first = 0
    for shape, n in shapes:
        for c, m in Counter(shape).items():
            table_.setdefault(c, []).append((taken[c], first, m, shape.index(c)))
            taken[c] += n * m
        first += n
    return {c: np.array(rows, np.int64) for c, rows in table_.items()}


def pack(pieces: DataFrame, window: int = WINDOW, classes: int = CLASSES, depth: int = DEPTH) -> DataFrame:
    """``pieces`` (a written table) plus sequence_id and offset."""
    step = window // classes
    small = pieces.withColumn("class", F.ceil(F.col("length") / step).cast("int"))
    histogram = {r["class"]: r["count"] for r in small.groupBy("class").count().collect()}  # at most ``classes`` rows
    where = slots(plan(histogram, classes, depth))

    buckets = 4 * shuffle_partitions(pieces.sparkSession)
    dealt = small.withColumn("bucket", F.pmod(F.xxhash64("row", "start"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("bucket")
    offsets = counts.select("class", "bucket", (F.sum("n").over(before) - F.col("n")).alias("before"))
    own = Window.partitionBy("class", "bucket").orderBy("row", "start")
    ranked = dealt.withColumn("rank", F.row_number().over(own)).join(offsets, ["class", "bucket"]).withColumn(
        "rank", F.col("rank") + F.col("before") - 1)

    @F.pandas_udf("sequence long, slot long")
    def place(kind: pd.Series, rank: pd.Series) -> pd.DataFrame:
        kinds, ranks = kind.to_numpy(), rank.to_numpy()
        sequence, slot = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for c in np.unique(kinds):
            at = np.flatnonzero(kinds == c)
            rows = where[int(c)][np.searchsorted(where[int(c)][:, 0], ranks[at], "right") - 1]
            turn = ranks[at] - rows[:, 0]
            sequence[at] = rows[:, 1] + turn // rows[:, 2]
            slot[at] = rows[:, 3] + turn % rows[:, 2]
        return pd.DataFrame({"sequence": sequence, "slot": slot})

    placed = ranked.withColumn("place", place("class", "rank")).select(
        *pieces.columns, F.col("place.sequence").alias("sequence_id"), F.col("place.slot").alias("slot"))
    inside = Window.partitionBy("sequence_id").orderBy("slot")
    return placed.withColumn("offset", F.sum("length").over(inside) - F.col("length")).drop("slot")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its place.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, row.  Repeated rows are packed each on their own, null ids stay
    null, an empty table gives no piece.
    """
    return pack(cut(docs, tokenizer, id_col, text_col)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row")


def op5_packing_of(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).drop("row")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_packing_of(table(spark, sf_dir, "documents"))
