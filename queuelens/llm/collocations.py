"""Phrase collocations by a level-wise search with double-array tries.

Frequent words get numbers, and a text becomes an array of numbers in which 0
breaks every phrase (the end of a piece, or a word that is not frequent).
Level by level, a position whose phrase of k words is frequent, and whose
right neighbour's is too, proposes a candidate of k + 1 words: no other phrase
can be frequent.  The candidates become shards of a double-array trie,
broadcast one at a time; numpy moves the states of all text positions along it
together, ``bincount`` counts the accepting states of each task, and Spark sums
them.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import small_arrow_batches, table, text_of, written
from queuelens.llm.doublearray import Transitions, build

LEAST = 30            # occurrences of a frequent phrase
LONGEST = 4           # words
COVERED = 80          # percent of a phrase's occurrences inside a longer one that drop it
SCALE = 2_000_000     # of the score
TOP = 2000            # phrases reported a language
UNKNOWN = "und"

WORDS_AT_ONCE = 500_000   # words of a broadcast dictionary, about 75 MB in a Python worker
SHARD = 1_000_000         # transitions of a broadcast trie shard, about 40 MB
HELD_WORDS = 300_000      # words that a task counts before it passes them on
HELD = 2_000_000          # candidates that a task holds before it passes them on
ROW = 4096                # words of a row of texts, about

# What ends a piece.  A piece's end becomes the word ".", which no text can hold.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_END = bytes.maketrans(_ENDS, b"\n" * len(_ENDS))
_BREAK = b"."


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words with ``.`` between pieces."""
    return text.lower().translate(_TO_END).replace(b"\n", b" . ").split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) from (lang, text), pre-counted in each task."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = defaultdict(Counter)

        def out():
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items() if w != _BREAK]
            held.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                held[lang].update(words_of(text))
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield out()
        yield out()

    return texts.mapInPandas(each, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` plus ``id`` = 1, 2, ... in ``order``, written.

    Range partitions are counted, and each numbers its own rows: no task sees
    more than a partition, and the driver only one count of each.
    """
    parts = written(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)
    counts = sorted((r["part"], r["count"]) for r in parts.groupBy("part").count().collect())
    if not counts:
        return parts.withColumn("id", F.lit(0).cast("int")).drop("part")
    first, at = [], 0
    for part, n in counts:
        first += [F.lit(part), F.lit(at)]
        at += n
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return written(parts.withColumn("id", (F.create_map(*first)[F.col("part")] + own).cast("int")).drop("part"), f"{name}_numbered")


def compact(words: np.ndarray, states: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Without what no longer phrase can use: only words inside phrases of ``length`` words that have a state stay.

    What is left out between two stretches, and behind the last, becomes a
    single 0.  The stretches themselves are unchanged, so neighbours stay
    neighbours.
    """
    live = states > 0
    need = live.copy()
    for d in range(1, length):
        need[d:] |= live[:-d]
    keep = need.copy()
    keep[1:] |= need[:-1]
    return np.where(need, words, 0)[keep], states[keep]


def encode(texts: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """(words): the texts' word numbers as int32 bytes, each text closed by a 0, rare words and breaks as one 0; written.

    The dictionary is broadcast in blocks of ``WORDS_AT_ONCE``; a text passes by
    every block.  Several short texts share a row.
    """
    spark = texts.sparkSession
    blocks = max(1, -(-total // WORDS_AT_ONCE))
    out = texts.withColumn("words", F.lit(None).cast("binary"))
    for b in range(blocks):
        lo = b * WORDS_AT_ONCE
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        for r in words.where((F.col("id") > lo) & (F.col("id") <= lo + WORDS_AT_ONCE)).select("lang", "word", "id").toLocalIterator():
            known[r["lang"]][bytes(r["word"])] = r["id"]
        shared = spark.sparkContext.broadcast(dict(known))
        last = b == blocks - 1

        def each(batches: Iterator[pd.DataFrame], shared=shared, last=last) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                ids = []
                for lang, text, old in zip(pdf["lang"], pdf["text"], pdf["words"], strict=True):
                    found = words_of(text)
                    found.append(_BREAK)
                    new = np.fromiter(map(shared.value.get(lang, {}).get, found, repeat(0)), np.int32, len(found))
                    ids.append(new if old is None else np.maximum(new, np.frombuffer(old, np.int32)))
                if not last:
                    yield pd.DataFrame({"lang": pdf["lang"], "text": pdf["text"], "words": [x.tobytes() for x in ids]})
                    continue
                rows, size = [[]], 0
                for x in ids:
                    x = compact(x, x, 1)[0]
                    rows[-1].append(x.tobytes())
                    size += len(x)
                    if size > ROW:
                        rows.append([])
                        size = 0
                yield pd.DataFrame({"lang": None, "text": None, "words": [b"".join(r) for r in rows]})

        out = written(out.mapInPandas(each, "lang string, text binary, words binary"), "encoded")
        shared.unpersist()
    return out.select("words")


def _behind(a: np.ndarray, k: int) -> np.ndarray:
    """The array moved left by k places, with zeros behind its end."""
    return np.concatenate([a[k:], np.zeros(min(k, len(a)), a.dtype)])


def counts_and_candidates(rows: DataFrame, level: int, last: bool) -> DataFrame:
    """(key, suffix, n) from (words, states): pre-counted in each task, summed by key, candidates below ``LEAST`` left out.

    A negative key is an accepted state and n its occurrences (``bincount``; a
    task holds 8 bytes a state).  Any other key, unless ``last``, is a candidate
    one word longer: state << 32 | next word, suffix the state of its words but
    the first (of one word: 0), n its occurrences, at most ``LEAST`` from a
    task's block: enough to tell whether it is frequent.
    """
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states = np.zeros(0, np.int64)
        held: list[tuple] = []
        size = 0

        def merged():
            keys, suffixes, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            return keys[first], suffixes[order][first], np.add.reduceat(n[order], first) if len(first) else n

        def candidates(keys, suffixes, n):
            return pd.DataFrame({"key": keys, "suffix": suffixes, "n": np.minimum(n, LEAST)})

        for pdf in batches:
            s = np.frombuffer(b"".join(pdf["states"]), np.int32)
            counts = np.bincount(s, minlength=len(states))
            counts[:len(states)] += states
            states = counts
            if last:
                continue
            w = np.frombuffer(b"".join(pdf["words"]), np.int32)
            right = _behind(s, 1)
            at = np.flatnonzero((s > 0) & (right > 0))
            keys, first, n = np.unique(s[at].astype(np.int64) << 32 | _behind(w, level)[at], return_index=True, return_counts=True)
            held.append((keys, right[at][first] if level > 1 else np.zeros(len(keys), np.int8), n.astype(np.int32)))
            size += len(keys)
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if 2 * size > HELD:
                    yield candidates(*held[0])
                    held, size = [], 0
        if held:
            yield candidates(*merged())
        states[:1] = 0
        seen = np.flatnonzero(states)
        yield pd.DataFrame({"key": -seen, "suffix": 0, "n": states[seen]})

    found = rows.mapInPandas(each, "key long, suffix int, n long")
    summed = found.groupBy("key").agg(F.max("suffix").alias("suffix"), F.sum("n").alias("n"))
    return summed.where((F.col("key") < 0) | (F.col("n") >= LEAST))


def tries(phrases: DataFrame, total: int) -> list[DataFrame]:
    """One-row tables, each the arrays of a shard of a level's transitions.

    A shard holds the transitions of neighbouring prefixes: numbers run by
    prefix, so a shard is a range of numbers, closed at whole prefixes.
    """
    shards = max(1, -(-total // SHARD))
    edges = phrases.groupBy("prefix").agg(F.min("id").alias("lo")).withColumn("shard", F.floor((F.col("lo") - 1) / SHARD))
    dealt = phrases.join(edges.select("prefix", "shard"), "prefix")

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        t = build(pdf["prefix"].to_numpy(), pdf["word"].to_numpy(), pdf["id"].to_numpy())
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "first": [t.first], "states": [t.states], "digits": [t.digits],
                             "base": [t.base.tobytes()], "check": [t.check.tobytes()], "child": [t.child.tobytes()]})

    rows = written(dealt.select("shard", "prefix", "word", "id").groupBy("shard").applyInPandas(
        each, "shard long, first long, states long, digits int, base binary, check binary, child binary"), "tries")
    return [rows.where(F.col("shard") == i) for i in range(shards)]


def advance(rows: DataFrame, shards: list[DataFrame], level: int) -> DataFrame:
    """``rows`` with every position's state moved on by one word; written once a shard."""
    spark = rows.sparkSession
    out = rows.withColumn("next", F.lit(None).cast("binary"))
    for i, shard in enumerate(shards):
        r = shard.first()
        last = i == len(shards) - 1
        trie = r and Transitions(r["first"], r["states"], r["digits"], *(np.frombuffer(r[c], np.int32) for c in ("base", "check", "child")))
        shared = spark.sparkContext.broadcast(trie)

        def each(batches: Iterator[pd.DataFrame], shared=shared, last=last) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                done = []
                for words, states, old in zip(pdf["words"], pdf["states"], pdf["next"], strict=True):
                    w, s = np.frombuffer(words, np.int32), np.frombuffer(states, np.int32)
                    moved = np.zeros(len(s), np.int32) if old is None else np.frombuffer(old, np.int32).copy()
                    if shared.value:   # a shard may be empty
                        at = np.flatnonzero((s > 0) & (_behind(s, 1) > 0))
                        moved[at] = np.maximum(moved[at], shared.value.advance(s[at].astype(np.int64), _behind(w, level)[at].astype(np.int64)))
                    if last:
                        w, moved = compact(w, moved, level + 1)
                        done.append((w.tobytes(), None, moved.tobytes()))
                    else:
                        done.append((words, states, moved.tobytes()))
                yield pd.DataFrame(done, columns=["words", "states", "next"])

        out = written(out.mapInPandas(each, "words binary, states binary, next binary"), f"states_{level}_{i}")
        shared.unpersist()
    return out.select("words", F.col("next").alias("states"))


def frequent_phrases(texts: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """A written table for each number of words, and the languages' totals, from (lang, text as binary).

    (id, prefix, suffix, lang, phrase, n, heads, tails): every phrase of
    1 to ``LONGEST`` words with ``LEAST`` or more occurrences; prefix and suffix
    are the numbers of its words but the last and but the first, heads and tails
    the occurrences of its first and its last 1, 2, ... words, up to itself.
    Each level takes them from the one before, so nothing has to go back down
    the levels later.  And (lang, n): all word occurrences.
    """
    counts = written(word_counts(texts), "word_counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = numbered(counts.where(F.col("n") >= LEAST).drop("n"), ["lang", "word"], "words")
    total = words.count()
    none, nothing = F.lit(0).cast("int"), F.array().cast("array<long>")
    phrases = words.select("id", none.alias("prefix"), none.alias("suffix"), "lang", F.col("word").cast("string").alias("phrase"),
                           nothing.alias("heads"), nothing.alias("tails"))
    rows = encode(texts, words, total).select("words", F.col("words").alias("states"))   # a word's number is its state
    found = []
    for level in range(1, LONGEST + 1):
        last = level == LONGEST
        seen = written(counts_and_candidates(rows, level, last), f"level_{level}")
        n = seen.where("key < 0").select((-F.col("key")).cast("int").alias("id"), "n")
        own = F.array("n")
        found.append(written(phrases.join(n, "id").select(
            "id", "prefix", "suffix", "lang", "phrase", "n",
            F.concat("heads", own).alias("heads"), F.concat("tails", own).alias("tails")), f"phrases_{level}"))
        if last:
            break
        word = F.col("key").bitwiseAND(0xFFFFFFFF).cast("int")
        longer = seen.where("key > 0").select(
            F.shiftright("key", 32).cast("int").alias("prefix"), (F.col("suffix") if level > 1 else word).alias("suffix"), word.alias("word"))
        longer = numbered(longer, ["prefix", "word"], f"candidates_{level + 1}")
        total = longer.count()
        if not total:
            found += [found[0].where(F.lit(False))] * (LONGEST - level)
            break
        rows = advance(rows, tries(longer, total), level)
        before = found[-1].select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("head"), "heads")
        after = found[-1].select(F.col("id").alias("suffix"), "tails")
        tail = found[0].select(F.col("id").alias("word"), F.col("phrase").alias("tail"))
        phrases = longer.join(before, "prefix").join(after, "suffix").join(tail, "word").select(
            "id", "prefix", "suffix", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "heads", "tails")
        phrases = written(phrases, f"candidate_phrases_{level + 1}")
    return found, totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Null texts count as empty, a null language as ``und``.  Texts are read
    whole, repeated rows count each time, other columns of ``docs`` are not
    looked at.  Languages without a phrase that is frequent enough, and an
    empty table, give no row.
    """
    small_arrow_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        text_of(docs, text_col).cast("binary").alias("text"))
    found, totals = frequent_phrases(texts)
    scored = inside = None
    for k, p in enumerate(found[1:], 2):
        cuts = []
        for j in range(1, k):
            left, right = F.col("heads")[j - 1], F.col("tails")[k - j - 1]
            score = F.expr(f"(cast({SCALE} as decimal(20,0)) * cast(n as decimal(18,0))) div cast(heads[{j - 1}] + tails[{k - j - 1}] as decimal(20,0))")
            cuts.append(F.struct(score.alias("score"), F.lit(j).alias("k"), left.alias("l"), right.alias("r")))
        cut = p.select(F.lit(k).alias("level"), "id", "lang", "phrase", F.col("n").alias("a"), F.array_min(F.array(*cuts)).alias("cut"))
        scored = cut if scored is None else scored.unionByName(cut)
        if k > 2:   # a phrase inside a longer one lies at the head or the tail of one that is one word longer
            parts = p.select(F.lit(k - 1).alias("level"), F.explode(F.array("prefix", "suffix")).alias("id"), "n")
            inside = parts if inside is None else inside.unionByName(parts)
    most = inside.groupBy("level", "id").agg(F.max("n").alias("most"))
    scored = scored.join(most, ["level", "id"], "left").where(F.coalesce(
        F.expr(f"cast(100 as decimal(20,0)) * cast(most as decimal(18,0)) < cast({COVERED} as decimal(20,0)) * cast(a as decimal(18,0))"),
        F.lit(True))).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                              F.col("score").cast("long").alias("score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def _phrases_sql() -> str:
    steps = []
    for k in range(1, LONGEST + 1):
        join = "".join(f" || ' ' || w[i + {j}]" for j in range(1, k))
        steps.append(f"SELECT lang, {k} AS level, w[i]{join} AS phrase FROM pieces, unnest(range(1, len(w) - {k - 2})) AS u(i)")
    return " UNION ALL ".join(steps)


OP11_SQL = f"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (SELECT lang, level, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM ({_phrases_sql()}) GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT c.lang, c.level, c.phrase, c.a, k, l.a AS l, r.a AS r,
         CAST({SCALE}::HUGEINT * c.a // (l.a + r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, level)) AS k FROM f WHERE level > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.k], ' ') AND l.level = c.k
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ') AND r.level = c.level - c.k),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, level, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, level, array_to_string(w[i:i + s - 1], ' ') AS phrase, s, a FROM f, unnest(range(2, level)) AS t(s), unnest(range(1, level - s + 2)) AS u(i)
  WHERE level > 2),
hidden AS (SELECT DISTINCT p.lang, p.s, p.phrase FROM parts p JOIN f ON f.lang = p.lang AND f.level = p.s AND f.phrase = p.phrase
           WHERE 100::HUGEINT * p.a >= {COVERED}::HUGEINT * f.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE NOT EXISTS (SELECT 1 FROM hidden h WHERE h.lang = lowest.lang AND h.s = lowest.level AND h.phrase = lowest.phrase))
JOIN totals USING (lang) WHERE rank <= {TOP}
"""
