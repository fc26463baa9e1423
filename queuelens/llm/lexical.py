"""Ranked lexical search: each range of documents becomes a K2-treap that every item descends best-first.

Items are taken in blocks whose terms are bounded, and each block meets all
documents: a pass over the texts keeps the occurrences of the block's terms, a
second one turns ranges of ``RANGE`` documents into treaps and searches them.
The twentieth best score of an item so far prunes the ranges that a task sees
later; the tasks' best rows are ranked at the end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import known_id, small_arrow_batches, table, text_of, true_id, written
from queuelens.llm.treap import Treap

TOP = 20
RANGE = 16_384          # documents of a treap
BLOCK_TERMS = 400_000   # distinct (item, term) pairs that meet the documents at once, about 60 MB in a Python worker

# The saturation and the length share of the score, in hundredths, and its scale.
K, BASE, SHARE, UNIT = 12, 100, 25, 1_000_000_000

# Every ASCII character but digits and letters separates; A-Z is folded; all else belongs to terms.
_FOLD = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(row, item_id, terms, times, size) of each item, written; a row is an item even if its id repeats."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [Counter(terms_of(t)) for t in pdf["text"]]
            yield pd.DataFrame({"row": pdf["row"], "item_id": pdf["item_id"], "terms": [list(c) for c in found],
                                "times": [list(c.values()) for c in found], "size": [len(c) for c in found]})

    named = items.select(F.monotonically_increasing_id().alias("row"), known_id(items, item_col).alias("item_id"),
                         text_of(items, text_col).cast("binary").alias("text"))
    return written(named.mapInPandas(each, "row long, item_id long, terms array<binary>, times array<long>, size long"), "items")


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, times): terms of the vocabulary in each document that has any term at all, written."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                words = terms_of(text)
                if words:
                    c = Counter(filter(known.__contains__, words))
                    rows.append((doc, len(words), np.fromiter(map(known.__getitem__, c), np.int32, len(c)).tobytes(),
                                 np.fromiter(c.values(), np.int32, len(c)).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "terms", "times"])

    named = docs.select(known_id(docs, id_col).alias("doc_id"), text_of(docs, text_col).cast("binary").alias("text"))
    return written(named.mapInPandas(each, "doc_id long, n long, terms binary, times binary"), "postings")


def document_frequencies(posted: DataFrame, terms: int) -> np.ndarray:
    """By term: how many documents hold it; each task counts its own, Spark sums."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(terms, np.int64)
        for pdf in batches:
            total += np.bincount(np.frombuffer(b"".join(pdf["terms"]), np.int32), minlength=terms)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"term": at, "df": total[at]})

    out = np.zeros(terms, np.int64)
    for r in posted.select("terms").mapInPandas(each, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]   # one row a term of the block
    return out


def impacts(term: np.ndarray, tf: np.ndarray, n: np.ndarray, weight: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Score of one occurrence of each term in an item; whole numbers, division rounds down."""
    m = BASE - SHARE + SHARE * n * documents // length
    return weight[term] * (UNIT * tf // (1000 * tf + K * m))


def _first(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """The places of the best rows: score descending, then id ascending."""
    return np.lexsort((ids, -scores))[:top]


def best_in_tasks(posted: DataFrame, queries: list[tuple], weight: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """(row, doc_id, score): each task's ``top`` documents of every item (queries: row, terms, times).

    A null document id is ``common.NO_ID`` throughout, the largest number: it ranks last.
    """
    spark = posted.sparkSession
    shared = spark.sparkContext.broadcast((queries, weight))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, by_term = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)

        def search(docs: pd.DataFrame) -> None:
            ids = docs["doc_id"].to_numpy(np.int64)
            sizes = [len(x) // 4 for x in docs["terms"]]
            doc = np.repeat(np.arange(len(ids)), sizes)
            term = np.frombuffer(b"".join(docs["terms"]), np.int32).astype(np.int64)
            tf = np.frombuffer(b"".join(docs["times"]), np.int32).astype(np.int64)
            value = impacts(term, tf, docs["n"].to_numpy(np.int64)[doc], by_term, documents, length)
            some = value > 0
            treap = Treap(term[some], doc[some], value[some], len(by_term), len(ids))
            for i, (_, terms, times) in enumerate(items):
                scores, found = best[i]

                def offer(columns, bounds):
                    nonlocal scores, found
                    scores, found = np.concatenate([scores, bounds]), np.concatenate([found, ids[columns]])
                    at = _first(scores, found, top)
                    scores, found = scores[at], found[at]
                    return int(scores[-1]) if len(scores) == top else 1

                treap.search(terms, times, offer, int(scores[-1]) if len(scores) == top else 1)
                best[i] = (scores, found)

        waiting, rows = [], 0
        for pdf in batches:
            waiting.append(pdf)
            rows += len(pdf)
            if rows >= RANGE:
                search(pd.concat(waiting, ignore_index=True))
                waiting, rows = [], 0
        if rows:
            search(pd.concat(waiting, ignore_index=True))
        for (row, _, _), (scores, found) in zip(items, best, strict=True):
            yield pd.DataFrame({"row": row, "doc_id": found, "score": scores})

    return posted.mapInPandas(each, "row long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", item_col: str = "item_id",
                   text_col: str = "text") -> DataFrame:
    """The ``top`` documents with a score above 0 of every item: item_id, rank, doc_id, score.

    Null and empty texts have no term; such items have no row and such
    documents do not count.  Every row is a document or an item of its own, so
    repeated rows appear repeatedly.  Equal scores go to the smaller doc_id, a
    null id last.  Empty tables give an empty result.  Other columns are not
    looked at.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    queries = item_terms(items, item_col, text_col)
    blocks = max(1, -(-(queries.agg(F.sum("size")).first()[0] or 0) // BLOCK_TERMS))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    found = None
    for b in range(blocks):
        block = [r for r in dealt.where((F.col("block") == b) & (F.col("size") > 0)).collect()]
        vocabulary: dict[bytes, int] = {}
        for r in block:
            for t in r["terms"]:
                vocabulary.setdefault(bytes(t), len(vocabulary))
        posted = postings(docs, vocabulary, id_col, text_col)
        total = posted.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        documents, length = total["documents"], total["length"] or 1
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1)))
                           for df in document_frequencies(posted, len(vocabulary))], np.int64)
        asked = [(r["row"], np.array([vocabulary[bytes(t)] for t in r["terms"]], np.int64), np.array(r["times"], np.int64)) for r in block]
        part = written(best_in_tasks(posted, asked, weight, documents, length, top), "best")
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("row").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(queries.select("row", "item_id"), "row").select(true_id("item_id"), "rank", true_id("doc_id"), "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP13_SQL = f"""
WITH items AS (SELECT item_id, row_number() OVER () AS item, {_TERMS_SQL} AS terms FROM benchmark),
asked AS (SELECT item_id, item, term, count(*) AS times FROM (SELECT item_id, item, unnest(terms) AS term FROM items) GROUP BY ALL),
docs AS MATERIALIZED (SELECT * FROM (SELECT doc_id, row_number() OVER () AS doc, {_TERMS_SQL} AS terms FROM documents) WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM docs),
held AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total),
scores AS (
  SELECT item_id, item, doc_id, doc, CAST(sum(times * w * ({UNIT} * tf // (1000 * tf + {K} * ({BASE - SHARE} + {SHARE} * len(terms) * docs // words)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN docs USING (doc), total GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
WHERE rank <= {TOP}
"""
