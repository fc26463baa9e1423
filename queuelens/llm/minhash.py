"""MinHash near-dedup with sequential Bayesian verification.

Documents with the same shingle set collapse into one set first.  Sets that
agree on a whole band of their signature are candidates; a candidate's
signatures are compared batch by batch, and it is dropped as soon as the
posterior probability of reaching the similarity falls below ``MISS``.  What is
left is confirmed on the full sets of shingles, hashed to 64 bits from the
whole texts.

Candidates come in two steps, so that no bucket's pairs are ever written out.
First every set meets the smallest set of each of its buckets, and the
confirmed links give components.  Then only buckets that still hold several
components are looked at again, cut into blocks of bounded size: tasks compare
pairs across components, and of each group only links that join components
leave the task.  A pair inside one component needs no link, so no component is
split by this.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import known_id, small_arrow_batches, table, text_of, true_id, written
from queuelens.llm.components import components

SHINGLE = 5          # words
SIMILAR = 80         # percent of the union in common
BANDS, ROWS = 28, 5  # a pair at 80 percent misses all bands with probability (1 - 0.8 ** 5) ** 28 = 1.5e-5
HASHES = BANDS * ROWS
BATCH = 20           # hashes compared at once
MISS = 1e-6          # a pair is pruned when its posterior chance of being similar is below this
BLOCK_BYTES = 8 << 20   # signatures and shingles of a block of a bucket, about
CHUNK = 1 << 10      # shingles hashed at once
SEED = 42            # of XXH64

# Odd multipliers that mix 64 bits.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; fewer words than ``shingle`` are one shingle.

    ``bytes.lower`` folds A-Z only and ``bytes.split`` cuts at ASCII white space only.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(shingle, len(words))
    out = h[:len(h) - n + 1]
    for j in range(1, n):
        out = _mixed(out * _MIX[0] + h[j:len(h) - n + 1 + j])
    return np.unique(_mixed(out + np.uint64(n)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """By hash function: the upper half of the smallest value over all shingles."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), CHUNK):
        least = np.minimum(least, (shingles[None, i:i + CHUNK] * MULTIPLIERS[:, None]).min(1))
    return (least >> np.uint64(32)).astype("<u4")


@cache
def least_matches(similar: int = SIMILAR, miss: float = MISS) -> tuple[int, ...]:
    """For each batch's end: the fewest equal hashes that leave a pair its chance.

    With a uniform prior, m of n equal hashes give the similarity the posterior
    Beta(m + 1, n - m + 1); its mass at s or more is the chance of at most m
    successes in n + 1 draws of probability s.
    """
    s, out = similar / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass, m = 0.0, 0
        while True:
            mass += math.comb(n + 1, m) * s ** m * (1 - s) ** (n + 1 - m)
            if mass >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def plausible(a: np.ndarray, b: np.ndarray, similar: int = SIMILAR) -> np.ndarray:
    """Places of the rows of ``a`` and ``b`` (signatures) that survive every batch."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(similar)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (a[alive, part] == b[alive, part]).sum(1)
        stay = equal >= least
        alive, equal = alive[stay], equal[stay]
    return alive


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, HASHES)


def _sizes_allow(a: str, b: str, similar: int) -> Column:
    return 100 * F.least(a, b) >= similar * F.greatest(a, b)


def distinct_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, text_key, n, d1, d2) and sets (set_id, doc_id, text_key, n, sig), both written.

    d1 and d2 are a 128-bit digest of the set; set_id is the row that stands for its set.
    """
    small_arrow_batches(docs.sparkSession)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for pdf in batches:
            sets = [shingle_hashes(t, shingle) for t in pdf["text"]]
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
            yield pd.DataFrame({"row": pdf["row"], "doc_id": pdf["doc_id"], "text_key": pdf["text_key"],
                                "n": [len(s) for s in sets], "d1": digests[:, 0], "d2": digests[:, 1],
                                "sig": [signature(s).tobytes() if len(s) else b"" for s in sets]})

    text = text_of(docs, text_col)
    named = docs.select(F.monotonically_increasing_id().alias("row"), known_id(docs, id_col).alias("doc_id"),
                        F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text"))
    rows = written(named.mapInPandas(each, "row long, doc_id long, text_key long, n long, d1 long, d2 long, sig binary")
                   .withColumn("doc_id", true_id()), "shingled")
    chosen = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("row")).select("row")
    sets = rows.join(chosen, "row").select(F.col("row").alias("set_id"), "doc_id", "text_key", "n", "sig")
    return rows.drop("sig"), written(sets, "sets")


def buckets(sets: DataFrame) -> DataFrame:
    """(band, key, set_id): each set under the hash of each of its bands."""
    width = 4 * ROWS
    keys = F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(F.substring("sig", width * i + 1, width)).alias("key")) for i in range(BANDS)])
    return sets.select("set_id", F.explode(keys).alias("k")).select("k.band", "k.key", "set_id")


def survivors(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) that the sequential test on their signatures leaves."""
    def side(x: str) -> DataFrame:
        return sets.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.iloc[plausible(_signatures(pdf["sig_a"]), _signatures(pdf["sig_b"]), similar)][["a", "b"]]

    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_allow("n_a", "n_b", similar))
    return both.select("a", "b", "sig_a", "sig_b").mapInPandas(each, "a long, b long")


def full_sets(wanted: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(set_id, n, sig, shingles) of the wanted set_ids, their 64-bit shingle hashes computed anew from the texts; written."""
    need = wanted.select("set_id").distinct().join(sets, "set_id")
    text = text_of(docs, text_col)
    named = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text"))
    found = named.join(need.select("set_id", "doc_id", "text_key"), named["id"].eqNullSafe(need["doc_id"]) & (named["key"] == need["text_key"]))
    one = Window.partitionBy("set_id").orderBy("set_id")   # rows that repeat id and text: one of them
    texts = found.select("set_id", "text").withColumn("k", F.row_number().over(one)).where("k = 1")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"set_id": pdf["set_id"], "shingles": [shingle_hashes(t, shingle).tobytes() for t in pdf["text"]]})

    hashed = texts.select("set_id", "text").mapInPandas(each, "set_id long, shingles binary")
    return written(hashed.join(need.select("set_id", "n", "sig"), "set_id").select("set_id", "n", "sig", "shingles"), "full_sets")


def confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, similar: int) -> DataFrame:
    """The pairs whose full sets have ``similar`` percent of their union in common; written."""
    pairs = written(pairs, "survivors")
    full = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("set_id")), sets, docs, id_col, text_col, shingle)

    def side(x: str) -> DataFrame:
        return full.select(F.col("set_id").alias(x), F.col("shingles").alias(f"in_{x}"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            stay = []
            for a, b in zip(pdf["in_a"], pdf["in_b"], strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                stay.append(100 * common >= similar * (len(x) + len(y) - common))
            yield pdf.loc[stay, ["a", "b"]]

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return written(both.select("a", "b", "in_a", "in_b").mapInPandas(each, "a long, b long"), "links")


def linked_in_group(sets: pd.DataFrame, band: int, i: int, j: int, similar: int) -> list[tuple[int, int]]:
    """Links across components among one bucket's sets (block i against block j), confirmed on their full sets.

    Components that a link joins count as one from then on, so there are fewer
    links than sets.  A pair is looked at only in the first band it shares.
    """
    ids, sizes, own = (sets[c].to_numpy(np.int64) for c in ("set_id", "n", "own"))
    sig = _signatures(sets["sig"])
    bands = sig.reshape(len(sig), BANDS, ROWS)
    shingles = [np.frombuffer(x, np.uint64) for x in sets["shingles"]]
    label = np.unique(sets["root"], return_inverse=True)[1]
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    links = []
    for x in left:
        ys = right[right > x] if i == j else right
        ys = ys[(label[ys] != label[x]) & (100 * np.minimum(sizes[ys], sizes[x]) >= similar * np.maximum(sizes[ys], sizes[x]))]
        if band and len(ys):
            ys = ys[~(bands[ys, :band] == bands[x, :band]).all(2).any(1)]
        ys = ys[plausible(np.broadcast_to(sig[x], (len(ys), HASHES)), sig[ys], similar)]
        ys = ys[np.argsort(-(sig[ys] == sig[x]).sum(1), kind="stable")]
        step = 8
        while len(ys):   # the likeliest first: a link often leaves nothing more to look at
            part, ys = ys[:step], ys[step:]
            step *= 2
            flat = np.concatenate([shingles[y] for y in part])
            at = np.minimum(np.searchsorted(shingles[x], flat), len(shingles[x]) - 1)
            common = np.add.reduceat(shingles[x][at] == flat, np.cumsum([0, *sizes[part[:-1]]]), dtype=np.int64)
            for y in part[100 * common >= similar * (sizes[x] + sizes[part] - common)]:
                if label[y] != label[x]:
                    links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    label[label == label[y]] = label[x]
            ys = ys[label[ys] != label[x]]
    return links


def across(members: DataFrame, full: DataFrame, similar: int) -> DataFrame:
    """Links (a, b) between components that share a bucket, written.

    members: (band, key, set_id, root), buckets with several components only;
    full: (set_id, n, sig, shingles).  A bucket is cut into blocks of
    ``BLOCK_BYTES``, and every two blocks meet in one group of a task.
    """
    sized = members.join(full.select("set_id", (8 * F.col("n") + 4 * HASHES).alias("bytes")), "set_id")
    blocks = sized.groupBy("band", "key").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("blocks"))
    dealt = members.join(blocks, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("set_id"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "set_id", "root")
    group = ["band", "key", "i", "j"]
    dealt = dealt.join(full, "set_id").repartition(*group).sortWithinPartitions(*group)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            keys = held[group].to_numpy(np.int64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist()]
            links = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):   # the last group may go on in the next batch
                links += linked_in_group(held.iloc[lo:hi], *keys[lo, [0, 2, 3]].tolist(), similar)
            held = held.iloc[cuts[-1]:].reset_index(drop=True)
            yield pd.DataFrame(links, columns=["a", "b"])
        if held is not None and len(held):
            yield pd.DataFrame(linked_in_group(held, *held[["band", "i", "j"]].iloc[0].tolist(), similar), columns=["a", "b"])

    columns = [*group, "own", "set_id", "root", "n", "sig", "shingles"]
    return written(dealt.select(*columns).mapInPandas(each, "a long, b long"), "links_across")


def set_roots(sets: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, similar: int) -> DataFrame:
    """(node, root) of the linked sets."""
    keyed = buckets(sets)
    shared = written(keyed.groupBy("band", "key").agg(F.min("set_id").alias("a"), F.count("*").alias("size")).where("size > 1").drop("size"), "buckets")
    members = written(keyed.join(shared, ["band", "key"]).select("band", "key", "set_id", "a"), "bucket_members")
    leaders = members.where("set_id <> a").select("a", F.col("set_id").alias("b")).distinct()
    links = confirmed(survivors(leaders, sets, similar), sets, docs, id_col, text_col, shingle, similar)
    roots = written(components(links), "leader_roots")

    rooted = members.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    rooted = written(rooted.select("band", "key", "set_id", "root"), "rooted")
    open_ = rooted.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band", "key")
    rest = written(rooted.join(open_, ["band", "key"]), "open_buckets")
    return components(links.union(across(rest, full_sets(rest, sets, docs, id_col, text_col, shingle), similar)))


def minhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   similar: int = SIMILAR) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    component_id is the smallest doc_id reachable over links (null if all of
    them are null).  Null texts and texts without a word have an empty set and
    are linked with nothing, not even with each other.  Repeated rows share
    their component.  An empty table gives an empty result.  Other columns of
    ``docs`` are not looked at.  A pair at exactly ``similar`` percent is missed
    with a probability of about 2e-5, more similar ones more rarely.
    """
    rows, sets = distinct_sets(docs, id_col, text_col, shingle)
    roots = written(set_roots(sets, docs, id_col, text_col, shingle, similar), "set_roots")
    of_digest = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("set_id"), F.min("doc_id").alias("least"))
    named = of_digest.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "d1", "d2", "least", F.coalesce("root", "set_id").alias("root"))
    named = written(named, "digests")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(named.join(smallest, "root").select("d1", "d2", "component_id"), "digest_components")
    # a hot set's rows are split by the adaptive skew join: both sides are plain tables
    linked = rows.where("n > 0").join(groups, ["d1", "d2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(rows.where("n = 0").select("doc_id", "n", "doc_id"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(table(spark, sf_dir, "documents"), shingle=2).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP12_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
docs AS MATERIALIZED (
  SELECT doc_id, list_sort(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
         ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END) AS s FROM words),
sets AS MATERIALIZED (SELECT s, len(s) AS n, min(doc_id) AS id FROM docs WHERE len(s) > 0 GROUP BY s),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.id AS a, y.id AS b, x.n + y.n AS sizes, len(list_intersect(x.s, y.s)) AS common
                    FROM sets x JOIN sets y ON x.id <> y.id AND 100 * least(x.n, y.n) >= {SIMILAR} * greatest(x.n, y.n))
  WHERE 100 * common >= {SIMILAR} * (sizes - common)),
reach AS (SELECT id, id AS least FROM sets UNION SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.id AND r.least < l.b)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) IS NOT DISTINCT FROM d.doc_id AS kept
FROM docs d LEFT JOIN sets USING (s) LEFT JOIN (SELECT id, min(least) AS component_id FROM reach GROUP BY id) c USING (id)
"""
