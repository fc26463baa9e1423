"""Substring dedup over word suffixes, grouped by variable-length prefixes.

A window of ``WINDOW`` words is a suffix cut at that depth.  Suffixes are
sampled: each window is represented by its least ``PREFIX``-word gram, so equal
windows hang from the same gram at the same place, and one suffix in about
seven carries all windows around it.  The grams are the short prefixes: those
that occur once end the search there.  The suffixes of a repeated prefix form
a group that fits in memory and is cut at the window's depth: a node with two
or more leaves is a repeat, its first leaf stays, and runs of such nodes along
a text are the maximal repeats.  A prefix with more than ``GROUP`` suffixes is
lengthened to the whole window, and each task sends on only the first leaf it
saw of each node, so that a passage that a third of all documents share never
meets in one task.

Documents of equal words are one class; only the first of it takes part.

Grams and windows are compared by 64-bit hashes of a window and of the prefix
inside it; texts travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import small_arrow_batches, table, text_of, written

WINDOW = 20       # words
PREFIX = 6        # words of a short prefix
GROUP = 10_000    # suffixes of a prefix that are held together
CACHED = 300_000  # words whose hashes a Python worker remembers
LAST = 2**63 - 1  # stands for a null id: last in order
NONE = np.zeros(0, np.int64)
TOGETHER = 8192   # suffixes that are compared in one step

KEY = ["doc", "tie"]


class _Hashes(dict):
    """word -> 64-bit hash, kept until there are too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive words."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, np.uint64)
    for j in range(n):   # a polynomial in an odd base, then mixed
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[j:j + m]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def anchors(prefixes: np.ndarray, n_windows: int) -> np.ndarray:
    """Place of the leftmost least prefix (by its upper 60 bits) inside every window; never decreasing."""
    upper = prefixes & ~np.uint64(15)
    best = upper[:n_windows].copy()
    for j in range(1, WINDOW - PREFIX + 1):   # at most 15 places: the offset fits in the lower bits and breaks ties
        np.minimum(best, upper[j:j + n_windows] | np.uint64(j), out=best)
    return (best & np.uint64(15)).astype(np.int64) + np.arange(n_windows)


class Suffixes:
    """The sampled suffixes of a text: prefix hash, place, and the range of windows that each carries."""

    def __init__(self, text: bytes, known: dict):
        words = text.split()
        self.n_windows = max(0, len(words) - WINDOW + 1)
        self.hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) if self.n_windows else np.zeros(0, np.uint64)
        prefixes = grams(self.hashes, PREFIX)
        at = anchors(prefixes, self.n_windows)
        self.first = np.flatnonzero(np.diff(at, prepend=-1))          # first window of each suffix
        self.behind = np.append(self.first[1:], self.n_windows)
        self.prefix = prefixes[at[self.first]].view(np.int64)

    def windows(self) -> np.ndarray:
        return grams(self.hashes, WINDOW)


def _compress(text: Column) -> Column:
    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        import zstandard

        c = zstandard.ZstdCompressor(level=3)
        return pd.Series([c.compress(t) for t in texts], index=texts.index, dtype=object)

    return of(text.cast("binary"))


def _expand(blob: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, tie, doc_id, text: rows are told apart by id and 40 bits of the text's hash."""
    named = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return named.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"),
                        F.shiftrightunsigned(F.xxhash64("text"), 24).alias("tie"), "doc_id", "text")


def _classes(keyed: DataFrame) -> DataFrame:
    """row, doc, tie, doc_id, n_words, words (SHA-256 of the joined words) and first, written."""
    @F.pandas_udf("n long, words binary")
    def digest(texts: pd.Series) -> pd.DataFrame:
        parts = [t.split() for t in texts]
        return pd.DataFrame({"n": [len(p) for p in parts], "words": [sha256(b" ".join(p)).digest() for p in parts]})

    rows = written(keyed.select(F.monotonically_increasing_id().alias("row"), "doc", "tie", "doc_id",
                                digest(F.col("text").cast("binary")).alias("d"))
                   .select("row", *KEY, "doc_id", F.col("d.n").alias("n_words"), F.col("d.words").alias("words")), "substr_rows")
    least = rows.groupBy("words").agg(F.min(F.struct("doc", "row")).alias("least")).select(F.col("least.row").alias("row"))
    firsts = written(least.withColumn("first", F.lit(True)), "substr_firsts")
    return written(rows.join(firsts, "row", "left").withColumn("first", F.coalesce("first", F.lit(False))), "substr_classes")


def _repeated_prefixes(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """For each first document the prefixes that occur more than once: doc, tie, short and long arrays, written."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for pdf in batches:
            prefixes, counts = [NONE], [NONE]
            for text in pdf["text"]:
                prefix, n = np.unique(Suffixes(text, known).prefix, return_counts=True)
                prefixes.append(prefix)
                counts.append(np.minimum(n, 0xFFFFF))
            sizes = list(map(len, prefixes[1:]))
            yield pd.DataFrame({"prefix": np.concatenate(prefixes), "doc": np.repeat(pdf["doc"].to_numpy(), sizes),
                                "packed": np.repeat(pdf["tie"].to_numpy() << 20, sizes) | np.concatenate(counts)})

    found = written(keyed.select(*KEY, F.col("text").cast("binary").alias("text")).mapInPandas(
        each, "prefix long, doc long, packed long"), "substr_found")
    n = F.col("packed").bitwiseAND(0xFFFFF)
    counts = found.select("prefix", n.alias("n")).groupBy("prefix").agg(F.sum("n").alias("n")).where("n > 1")
    repeated = written(counts.select("prefix", (F.col("n") > GROUP).alias("long")), "substr_prefixes")
    # the side with a hot prefix is split by the adaptive skew join: both sides are plain shuffles
    here = found.select("prefix", "doc", F.shiftrightunsigned("packed", 20).alias("tie")).join(repeated, "prefix")
    lists = here.groupBy(*KEY).agg(F.collect_list(F.when(~F.col("long"), F.col("prefix"))).alias("short"),
                                   F.collect_list(F.when(F.col("long"), F.col("prefix"))).alias("long"))
    return lists.join(classes.where("first").select(*KEY), KEY, "left_semi")


def _with_text(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` plus the compressed text of its key, once for rows that repeat."""
    texts = keyed.select(*KEY, _compress(F.col("text")).alias("blob"))
    joined = texts.join(wanted, KEY)
    one = Window.partitionBy(*KEY).orderBy("doc")
    return joined.withColumn("__n", F.row_number().over(one)).where("__n = 1").drop("__n")


SUFFIX = "route long, prefix long, doc long, tie long, start long, n int, kind int, hashes binary"
SHORT, LONG, LEAF = 0, 1, 2   # a suffix with its windows; one whose windows all go unless a leaf says otherwise; a first leaf


def _suffixes(with_text: DataFrame) -> DataFrame:
    """The suffixes of repeated prefixes, each with the hashes of the windows that it carries."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        leaves: dict[tuple[int, int], tuple[int, int, int]] = {}   # (prefix, window) -> first leaf seen in this task
        names = [x.split()[0] for x in SUFFIX.split(", ")]
        for pdf in batches:
            out: list[tuple] = []
            sizes, prefixes, starts, ns, hashes = [], [NONE], [NONE], [NONE], []
            for doc, tie, short, long, blob in zip(pdf["doc"], pdf["tie"], pdf["short"], pdf["long"], pdf["blob"], strict=True):
                s = Suffixes(_expand(blob), known)
                w = s.windows().view(np.int64)
                use = np.flatnonzero(np.isin(s.prefix, short))
                first, behind = s.first[use], s.behind[use]
                sizes.append(len(use))
                prefixes.append(s.prefix[use])
                starts.append(first)
                ns.append(behind - first)
                raw = w.tobytes()
                hashes += [raw[a:b] for a, b in zip((8 * first).tolist(), (8 * behind).tolist(), strict=True)]
                for k in (np.flatnonzero(np.isin(s.prefix, long)).tolist() if len(long) else []):
                    a, b = int(s.first[k]), int(s.behind[k])
                    p = int(s.prefix[k])
                    out.append((doc ^ a, p, doc, tie, a, b - a, LONG, b""))
                    for i in range(a, b):
                        node, leaf = (p, int(w[i])), (doc, tie, i)
                        if leaf < leaves.get(node, (LAST, LAST, LAST)):
                            leaves[node] = leaf
            prefix = np.concatenate(prefixes)
            yield pd.DataFrame({"route": prefix, "prefix": prefix, "doc": np.repeat(pdf["doc"].to_numpy(), sizes),
                                "tie": np.repeat(pdf["tie"].to_numpy(), sizes), "start": np.concatenate(starts),
                                "n": np.concatenate(ns).astype(np.int32), "kind": np.int32(SHORT), "hashes": hashes})
            if out:
                yield pd.DataFrame(out, columns=names)
        for chunk in range(0, len(leaves), 10_000):
            part = list(leaves.items())[chunk:chunk + 10_000]
            yield pd.DataFrame([(h, p, *leaf, 1, LEAF, np.int64(h).tobytes()) for (p, h), leaf in part], columns=names)

    return with_text.select(*KEY, "short", "long", "blob").mapInPandas(each, SUFFIX)


def _marks(suffixes: DataFrame) -> DataFrame:
    """doc, tie, start, mask, stays: windows to remove, and single windows of long prefixes that stay."""
    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= TOGETHER:
                yield pa.Table.from_batches(held).to_pandas()
                held = []
        if held:
            yield pa.Table.from_batches(held).to_pandas()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pdf in compared(together(batches)):
            yield pa.RecordBatch.from_pandas(pdf.astype({"mask": "int64", "stays": bool}), schema=schema, preserve_index=False)

    schema = pa.schema([("doc", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("mask", pa.int64()), ("stays", pa.bool_())])

    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, open_nodes = None, set()   # the group that the next frame may go on with, and its nodes
        for pdf in frames:
            long = pdf[pdf["kind"] == LONG]
            yield pd.DataFrame({"doc": long["doc"], "tie": long["tie"], "start": long["start"],
                                "mask": np.left_shift(np.int64(1), long["n"].to_numpy(np.int64)) - 1, "stays": False})
            pdf = pdf[pdf["kind"] != LONG]
            if not len(pdf):
                continue
            n = pdf["n"].to_numpy(np.int64)
            prefix = np.repeat(pdf["prefix"].to_numpy(), n)
            node = np.frombuffer(b"".join(pdf["hashes"]), np.int64)
            own = np.repeat(np.arange(len(pdf)), n)
            place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            order = np.lexsort((node, prefix))               # stable: leaves of a node stay in their order
            p, h = prefix[order], node[order]
            seen = np.zeros(len(order), bool)
            seen[1:] = (p[1:] == p[:-1]) & (h[1:] == h[:-1])
            again = np.zeros(len(order), bool)
            again[order] = seen
            if last is not None:
                for i in np.flatnonzero(prefix == last).tolist():
                    again[i] |= int(node[i]) in open_nodes
            group = int(pdf["prefix"].iloc[-1])
            mine = node[prefix == group].tolist()
            open_nodes = open_nodes.union(mine) if group == last else set(mine)
            last = group
            mask = np.zeros(len(pdf), np.int64)
            np.bitwise_or.at(mask, own[again], np.int64(1) << place[again])
            leaf = (pdf["kind"] == LEAF).to_numpy()
            stays = leaf & (mask == 0)
            use = stays | (~leaf & (mask != 0))
            yield pd.DataFrame({"doc": pdf["doc"][use], "tie": pdf["tie"][use], "start": pdf["start"][use],
                                "mask": np.where(stays, 1, mask)[use], "stays": stays[use]})

    dealt = suffixes.repartition("route").sortWithinPartitions("prefix", "doc", "tie", "start")
    return dealt.mapInArrow(each, "doc long, tie long, start long, mask long, stays boolean")


def _cut(with_marks: DataFrame) -> DataFrame:
    """doc, tie, n_removed, kept: the words that no removed window covers, joined."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, tie, marks, blob in zip(pdf["doc"], pdf["tie"], pdf["marks"], pdf["blob"], strict=True):
                words = _expand(blob).split()
                gone = np.zeros(max(0, len(words) - WINDOW + 1), bool)
                for stays in (False, True):
                    for m in marks:
                        if m["stays"] == stays:
                            at = [m["start"] + i for i in range(int(m["mask"]).bit_length()) if m["mask"] >> i & 1]
                            gone[at] = not stays
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, np.flatnonzero(gone), 1)
                np.add.at(edge, np.flatnonzero(gone) + WINDOW, -1)
                covered = np.cumsum(edge[:-1]) > 0
                rows.append((doc, tie, int(covered.sum()), b" ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c)))
            yield pd.DataFrame(rows, columns=["doc", "tie", "n_removed", "kept"])

    return with_marks.mapInPandas(each, "doc long, tie long, n_removed long, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (binary: the words that stay, joined by one space), words.

    A word goes if a window of WINDOW words that covers it also starts earlier:
    in a document of smaller id or earlier in the same one.  ``kept`` is null
    where nothing or everything goes; ``words`` is the SHA-256 of all words
    joined.  Null texts have no words, null ids come last, and of rows that
    repeat id and text all but one count as later copies.  An empty table gives
    an empty result.
    """
    small_arrow_batches(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    classes = _classes(keyed)
    marks = _marks(_suffixes(_with_text(keyed, _repeated_prefixes(keyed, classes))))
    by_doc = written(marks.groupBy(*KEY).agg(F.collect_list(F.struct("start", "mask", "stays")).alias("marks")), "substr_marks")
    cut = _cut(_with_text(keyed, by_doc)).withColumn("first", F.lit(True))
    joined = classes.join(cut, [*KEY, "first"], "left")
    whole = ~F.col("first") & (F.col("n_words") >= WINDOW)
    return joined.select("doc_id", "n_words",
                         F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                         F.when(F.col("first"), F.col("kept")).alias("kept"), "words")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    everything = F.col("n_removed") == F.col("n_words")
    digest = F.when(everything, F.unhex(F.sha2(F.lit(""), 256))).when(F.col("n_removed") == 0, F.col("words")).otherwise(
        F.unhex(F.sha2("kept", 256)))
    return done.select("doc_id", "n_words", "n_removed", F.lower(F.hex(digest)).alias("kept_sha256"))
