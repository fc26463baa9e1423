"""Toxicity: a convolutional text classifier over hashed word embeddings, fitted on every labelled document.

A word's embedding is the sum of hashed rows for the word and its first
characters.  Filters of several widths slide over the whole text, each keeps
its largest value, and a logistic unit reads them.  Thresholds are calibrated
by language, which is guessed from the text's words alone: each language's
best threshold is moved to ``CUT``.  Counts, training (numpy inside tasks, whose
parameters are averaged after every pass) and thresholds use all labelled rows,
whose words are hashed once, into a written table that every pass reads.
"""

from __future__ import annotations

import copy
import math
import string
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.llm.common import list_places, small_arrow_batches, table, text_of, written
from queuelens.llm.langid import LANGUAGES, bounded_sample, held_out, words_of

SAMPLE = 2500            # documents a class that labelled_sample draws for a trial in the driver; the query fits on all
LONGEST = 50_000         # characters; longer documents are left out of such a trial
TASK_DOCS = 16384        # labelled documents, about, that a task trains on between two averages
STEPS, LARGEST = 1024, 64   # logits are counted in steps of 1 / STEPS up to LARGEST to find the thresholds
BUCKETS = 1 << 16
PREFIXES = (4, 5, 6)     # hashed besides the word
DIM = 16
CHANNELS = 8             # filters of each width
WIDTHS = (1, 2, 3)
EPOCHS = 4
BATCH = 16
RATE = 0.1
CUT = 0.7                # score from which a document counts as toxic
CACHED = 800_000         # parts of texts between spaces, and beginnings of words, remembered by a Python worker
MARKS = string.punctuation + string.digits + "\t\n\r"   # cut off the ends of such parts; no letters
LONGEST_KEPT = 64        # characters; longer parts are forgotten after their batch
TOGETHER = 1 << 22       # bytes of texts scored or hashed at a time, or one text


def buckets_of(word: str) -> list[int]:
    import xxhash

    parts = [f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES)]
    return [xxhash.xxh64_intdigest(p) % BUCKETS for p in parts]


def buckets_in(codes: np.ndarray) -> np.ndarray:
    """The buckets of each word code (a row each): a code holds them in 16 bits each, the word's own in the lowest."""
    return np.ascontiguousarray(codes, "<i8").view("<u2").reshape(-1, 1 + len(PREFIXES))


@cache
def coder():
    """A function from texts to the codes of their words: codes of the batch's distinct parts between spaces, the place
    there of each word of each text, and where each text's words end.  Remembers parts and beginnings of words."""
    import xxhash

    known: dict[str, bytes] = {}
    heads: dict[str, int] = {}
    digest, longest = xxhash.xxh64_intdigest, max(PREFIXES)

    def code(word: str) -> int:
        head = word[:longest]
        rest = heads.get(head)
        if rest is None:
            if len(heads) >= CACHED:
                heads.clear()
            rest = heads[head] = sum(digest(f"{n}{word[:n]}") % BUCKETS << 16 * k for k, n in enumerate(PREFIXES, 1))
        return digest(f"={word}") % BUCKETS | rest

    def part_codes(part: str) -> bytes:
        low = part.lower()
        if low.isalpha():
            return code(low).to_bytes(8, "little")
        return b"".join(code(w).to_bytes(8, "little") for w in words_of(part))

    def codes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # a word never holds a space, nor does its lower case depend on what follows one or on marks at a part's ends
        cut = pc.split_pattern(texts, " ")
        numbered = pc.ascii_trim(pc.ascii_lower(cut.flatten()), MARKS).dictionary_encode()
        parts = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(known.get, parts))
        new = [i for i, codes in enumerate(found) if codes is None]
        if len(known) + len(new) > CACHED:
            known.clear()
        for i in new:
            found[i] = part_codes(parts[i])
            if len(parts[i]) <= LONGEST_KEPT and len(known) < CACHED:
                known[parts[i]] = found[i]
        at, ends = list_places(np.fromiter(map(len, found), np.int64, len(found)) // 8, numbered.indices.to_numpy())
        return np.frombuffer(b"".join(found), "<i8"), at, ends[cut.offsets.to_numpy()]

    return codes_of


def slices(texts: pa.Array) -> list[pa.Array]:
    """The texts in slices of TOGETHER bytes, about, or of one text."""
    if len(texts) < 2 or texts.nbytes <= TOGETHER:
        return [texts]
    half = len(texts) // 2
    return slices(texts[:half]) + slices(texts[half:])


def embedded(embedding: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The sum of each word's rows."""
    x = embedding[buckets[:, 0]]
    for k in range(1, buckets.shape[1]):
        x += embedding[buckets[:, k]]
    return x


@dataclass
class Model:
    """Rows of ``embedding``: DIM of the classifier, then one log frequency for each of ``languages``."""

    embedding: np.ndarray            # BUCKETS x DIM
    filters: np.ndarray              # DIM x sum(WIDTHS) * CHANNELS
    bias: np.ndarray                 # len(WIDTHS) * CHANNELS
    weight: np.ndarray
    offset: float
    languages: list[str]
    frequency: np.ndarray            # BUCKETS x languages, by the word's own bucket
    thresholds: np.ndarray           # logits, by language


def windows(x: np.ndarray, filters: np.ndarray) -> list[np.ndarray]:
    """Filter values at every place, one array (places x CHANNELS) for each width; past the end counts as zero."""
    y = x @ filters
    out, at = [], 0
    for width in WIDTHS:
        total = y[:, at:at + CHANNELS].copy()
        for j in range(1, width):
            total[:-j] += y[j:, at + j * CHANNELS:at + (j + 1) * CHANNELS]
        out.append(total)
        at += width * CHANNELS
    return out


def logit(model: Model, x: np.ndarray) -> float:
    if not len(x):
        return float(model.offset)
    best = np.concatenate([v.max(0) for v in windows(x, model.filters)])
    return float(np.maximum(best + model.bias, 0) @ model.weight + model.offset)


@dataclass
class State:
    """What training changes: the parameters of a model and Adagrad's sums of squares."""

    e: np.ndarray
    f: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: np.ndarray
    g_e: np.ndarray
    g_f: np.ndarray
    g_b: np.ndarray
    g_w: np.ndarray
    g_o: np.ndarray

    def dense(self) -> list[np.ndarray]:
        return [self.f, self.bias, self.weight, self.offset, self.g_f, self.g_b, self.g_w, self.g_o]

    def model(self) -> Model:
        return Model(self.e, self.f, self.bias.astype(np.float32), self.weight.astype(np.float32), float(self.offset[0]), [],
                     np.zeros((BUCKETS, 0), np.float32), np.zeros(0))


def start(seen: np.ndarray, n: np.ndarray, rng: np.random.Generator) -> State:
    """``seen``: documents of each label that hold a bucket; ``n``: documents of each label."""
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    e = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    e[:, 0] = odds * (seen.sum(0) / (seen.sum(0) + 5)) / 4      # a start from each bucket's log odds
    f = rng.normal(0, 0.2, (DIM, sum(WIDTHS) * CHANNELS)).astype(np.float32)
    f[0] = np.abs(f[0]) + 0.2
    bias = np.full(len(WIDTHS) * CHANNELS, -0.3)
    weight = np.full(len(bias), 0.1)
    return State(e, f, bias, weight, np.full(1, -1.0), np.full(BUCKETS, 1e-2), np.full(f.shape, 1e-2), np.full(bias.shape, 1e-2),
                 np.full(weight.shape, 1e-2), np.full(1, 1e-2))


def epoch(s: State, docs: list[np.ndarray], words: np.ndarray, labels: np.ndarray, share: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One pass over ``docs`` in random order, changing ``s``; returns the buckets whose embeddings have changed.

    ``docs``: word numbers of each text; ``words``: buckets of each word number; ``share``: weight of each label."""
    starts = np.concatenate([[0], np.cumsum([w * CHANNELS for w in WIDTHS])])
    usable = np.array([i for i, d in enumerate(docs) if len(d)], np.int64)
    changed = np.zeros(BUCKETS, bool)
    for order in np.array_split(rng.permutation(usable), max(1, len(usable) // BATCH)) if len(usable) else []:
        d_f = np.zeros(s.f.shape)
        touched: list[np.ndarray] = []
        grads: list[np.ndarray] = []
        d_b, d_w, d_o = np.zeros(s.bias.shape), np.zeros(s.weight.shape), 0.0
        for i in order:
            d = docs[i]
            x = embedded(s.e, words[d])
            values = windows(x, s.f)
            place = np.concatenate([v.argmax(0) for v in values])
            best = np.concatenate([v.max(0) for v in values]) + s.bias
            h = np.maximum(best, 0)
            g = 1 / (1 + np.exp(-(h @ s.weight + s.offset[0]))) - labels[i]
            g *= share[labels[i]]
            d_w += g * h
            d_o += g
            d_h = g * s.weight * (best > 0)
            d_b += d_h
            for k, width in enumerate(WIDTHS):
                own = slice(k * CHANNELS, (k + 1) * CHANNELS)
                for j in range(width):
                    at = place[own] + j
                    ok = at < len(d)
                    cols = np.arange(starts[k] + j * CHANNELS, starts[k] + (j + 1) * CHANNELS)[ok]
                    d_f[:, cols] += x[at[ok]].T * d_h[own][ok]
                    touched.append(d[at[ok]])
                    grads.append(s.f[:, cols].T * d_h[own][ok][:, None])
        rows = words[np.concatenate(touched)]                                   # places x buckets of a word
        d_e = np.repeat(np.concatenate(grads), rows.shape[1], axis=0)
        unique, inverse = np.unique(rows.ravel(), return_inverse=True)
        total = np.zeros((len(unique), DIM))
        np.add.at(total, inverse, d_e)
        s.g_e[unique] += (total ** 2).mean(1)
        s.e[unique] -= (RATE * total / np.sqrt(s.g_e[unique])[:, None]).astype(np.float32) / BATCH
        changed[unique] = True
        for p, grad, acc in ((s.f, d_f, s.g_f), (s.bias, d_b, s.g_b), (s.weight, d_w, s.g_w), (s.offset, np.full(1, d_o), s.g_o)):
            acc += grad ** 2
            p -= (RATE * grad / np.sqrt(acc) / 4).astype(p.dtype)
    return np.flatnonzero(changed)


def label_share(n: np.ndarray) -> np.ndarray:
    return n.max() / np.maximum(n, 1)                                # both classes weigh the same


def train(docs: list[np.ndarray], words: np.ndarray, labels: np.ndarray, seed: int = 1) -> Model:
    """``docs``: word numbers of each text; ``words``: buckets of each word number."""
    rng = np.random.default_rng(seed)
    n = np.bincount(labels, minlength=2)
    state = start(seen_in(docs, words, labels), n, rng)
    for _ in range(EPOCHS):
        epoch(state, docs, words, labels, label_share(n), rng)
    return state.model()


def seen_in(docs: list[np.ndarray], words: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Documents of each label that hold a bucket."""
    seen = np.zeros((2, BUCKETS))
    for d, y in zip(docs, labels, strict=True):
        seen[y, np.unique(words[np.unique(d)])] += 1
    return seen


def numbered_words(texts) -> tuple[list[np.ndarray], np.ndarray]:
    """Word numbers of each text, and the buckets of each word number."""
    codes, at, ends = coder()(pa.array([t or "" for t in texts], pa.string()))
    return np.split(at, ends[1:-1]) if len(ends) > 1 else [], buckets_in(codes)


def coded_words(codes: pd.Series) -> tuple[list[np.ndarray], np.ndarray]:
    """:func:`numbered_words` of texts whose words are coded."""
    ends = np.cumsum([0, *map(len, codes)])
    buckets = buckets_in(np.concatenate([np.zeros(0, np.int64), *codes]))
    return [np.arange(a, b) for a, b in zip(ends, ends[1:], strict=False)], buckets


def languages_of(docs: list[np.ndarray], words: np.ndarray, langs: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Log frequency of each word bucket in each language, smoothed and centred."""
    names = sorted({x for x in langs if x is not None})
    counts = np.zeros((BUCKETS, len(names)))
    for d, x in zip(docs, langs, strict=True):
        if x is not None:
            counts[:, names.index(x)] += np.bincount(words[d, 0], minlength=BUCKETS)
    return names, log_frequencies(counts)


def log_frequencies(counts: np.ndarray) -> np.ndarray:
    logs = np.log((counts + 0.5) / (counts.sum(0) + BUCKETS / 2))
    return (logs - logs.mean(1, keepdims=True) if counts.shape[1] else logs).astype(np.float32)


def best_cut(values: np.ndarray, hits: np.ndarray, wrongs: np.ndarray, default: float) -> float:
    """The cut of the best F1 over values in any order, each with its toxic and its clean documents, halfway to the next value."""
    if not hits.sum() or not wrongs.sum():
        return default
    order = np.argsort(-values)
    hit, wrong = np.cumsum(hits[order]), np.cumsum(wrongs[order])
    f1 = 2 * hit / (hit + wrong + hits.sum())
    k = int(f1.argmax())
    below = values[order[k + 1]] if k + 1 < len(order) else values[order[k]] - 2
    return float((values[order[k]] + below) / 2)


def best_threshold(logits: np.ndarray, labels: np.ndarray, clean_weight: float, default: float) -> float:
    """The cut of the best F1 when each clean document stands for ``clean_weight``."""
    return best_cut(logits, labels, (1 - labels) * clean_weight, default)


def fit(sample: pd.DataFrame, clean_weight: float = 1.0) -> Model:
    """The model of rows in the driver: text, toxic (0 or 1), lang; a third calibrates the thresholds.  :func:`fit_all` fits a table."""
    docs, words = numbered_words(sample["text"])
    labels = sample["toxic"].to_numpy(np.int64)
    tuning = np.arange(len(docs)) % 3 == 0
    pick = lambda m: [d for d, x in zip(docs, m, strict=True) if x]
    model = train(pick(~tuning), words, labels[~tuning])
    model.languages, model.frequency = languages_of(docs, words, list(sample["lang"]))
    values = np.array([logit(model, embedded(model.embedding, words[d])) for d in docs])
    guess = np.array([int(model.frequency[words[d, 0]].sum(0).argmax()) if model.languages and len(d) else 0 for d in docs])
    whole = best_threshold(values[tuning], labels[tuning], clean_weight, 0.0)
    model.thresholds = np.array([best_threshold(values[tuning & (guess == k)], labels[tuning & (guess == k)], clean_weight, whole)
                                 for k in range(max(1, len(model.languages)))])
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[pd.DataFrame, float]:
    """About SAMPLE documents of each label (text, toxic, lang), and how many clean ones each sampled one stands for.

    The ids are chosen first, so that only a table of bounded size is joined to the texts.
    """
    usable = labels.where(labels["doc_id"].isNotNull() & labels["toxic"].isin(0, 1)).groupBy(
        labels["doc_id"].cast("long").alias("doc_id")).agg(F.max("toxic").cast("string").alias("lang"))
    ids, classes = bounded_sample(usable, F.col("lang"), F.col("doc_id").cast("string"), SAMPLE)
    ids = ids.select(F.col("doc_id").alias("__id"), F.col("lang").cast("int").alias("toxic"))
    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), docs["lang"].cast("string").alias("lang"))
    found = named.where(F.length("text") <= LONGEST).join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
    sample = found.select("doc_id", "text", "toxic", "lang").toPandas().sort_values(["doc_id", "text"], kind="stable")
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()} if len(classes) == 2 else {}
    taken = sample["toxic"].value_counts().to_dict()
    weight = (counts["0"] / max(1, taken.get(0, 0))) / (counts["1"] / max(1, taken.get(1, 0))) if counts else 1.0
    return sample.sample(frac=1, random_state=0), weight


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with a label (text, toxic, lang); ``tuning`` marks the third that calibrates the thresholds."""
    usable = labels.where(labels["doc_id"].isNotNull() & labels["toxic"].isin(0, 1)).groupBy(
        labels["doc_id"].cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"), docs["lang"].cast("string").alias("lang"))
    tasks = max(1, math.ceil(usable.count() / TASK_DOCS))
    # both sides dealt alike, so that every file holds a random share of the documents
    rows = named.repartition(tasks, "doc_id").join(usable.repartition(tasks, "doc_id"), "doc_id")
    tuning = F.pmod(F.xxhash64("doc_id", F.lit("tuning")), F.lit(3)) == 0
    return rows.select("text", "toxic", "lang", tuning.alias("tuning"))


def coded(rows: DataFrame) -> DataFrame:
    """``rows`` with the codes of each text's words, in order, in place of the text."""
    if "text" not in rows.columns:
        return rows

    @F.arrow_udf("array<bigint>")
    def codes_of(texts: pa.Array) -> pa.Array:
        out = []
        for some in slices(texts):
            codes, at, ends = coder()(some)
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes[at])))
        return pa.concat_arrays(out)

    return rows.select(codes_of(text_of(rows)).alias("codes"), *[c for c in rows.columns if c != "text"])


def counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Over all rows: documents of each label with a bucket and documents of each label (without the tuning third),
    the most frequent languages, and the words of each bucket in each of them."""
    rows = coded(rows)
    langs = rows.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    names = sorted(r["lang"] for r in langs.collect())

    def count(batches):
        seen, n, words_in = np.zeros((2, BUCKETS)), np.zeros(2), np.zeros((BUCKETS, len(names)))
        place = {x: i for i, x in enumerate(names)}
        for b in batches:
            docs, words = coded_words(b["codes"])
            labels, fits = b["toxic"].to_numpy(np.int64), ~b["tuning"].to_numpy(bool)
            seen += seen_in([d for d, x in zip(docs, fits, strict=True) if x], words, labels[fits])
            n += np.bincount(labels[fits], minlength=2)
            for d, x in zip(docs, b["lang"], strict=True):
                if x in place:
                    words_in[:, place[x]] += np.bincount(words[d, 0], minlength=BUCKETS)
        for kind, values in [(0, seen[0]), (1, seen[1]), (2, n), *[(3 + i, words_in[:, i]) for i in range(len(names))]]:
            at = np.flatnonzero(values)
            yield pd.DataFrame({"kind": np.full(len(at), kind, np.int32), "at": at.astype(np.int32), "n": values[at]})

    found = rows.mapInPandas(count, "kind int, at int, n double").groupBy("kind", "at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((3 + len(names), BUCKETS))
    kind, at, n = (found[c].to_numpy() for c in ("kind", "at", "n"))
    total[kind, at] = n
    return total[:2], total[2, :2], names, total[3:].T


VALUES = [f"v{i}" for i in range(DIM)]


def trained_once(rows: DataFrame, state: State, share: np.ndarray, seed: int) -> State:
    """One pass over all rows: each task trains on its own from ``state``; the parameters are then averaged by documents.

    An embedding is averaged over the tasks that changed it.  A task sends at most one row a bucket."""
    shared = rows.sparkSession.sparkContext.broadcast(state)  # bounded by BUCKETS

    def task(batches):
        s = copy.deepcopy(shared.value)
        rng, changed, n = np.random.default_rng(seed), np.zeros(BUCKETS, bool), 0
        for b in batches:
            docs, words = coded_words(b["codes"])
            changed[epoch(s, docs, words, b["toxic"].to_numpy(np.int64), share, rng)] = True
            n += len(b)
        if not n:
            return
        at = np.flatnonzero(changed)
        flat = np.concatenate([v.ravel() for v in s.dense()])
        flat = np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)
        values = np.concatenate([s.e[at].astype(float), flat])
        out = pd.DataFrame(values, columns=VALUES)
        out["at"] = np.concatenate([at, BUCKETS + np.arange(len(flat))]).astype(np.int32)
        out["g"] = np.concatenate([s.g_e[at], np.zeros(len(flat))])
        out["n"] = float(n)
        yield out[["at", "n", "g", *VALUES]]

    kinds = ", ".join(f"{c} float" for c in ("n", "g", *VALUES))
    sent = rows.mapInPandas(task, f"at int, {kinds}")
    mean = sent.groupBy("at").agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in ("g", *VALUES)]).orderBy("at").toArrow()
    at, out = mean["at"].to_numpy(), copy.deepcopy(state)
    values = np.column_stack([mean[c].to_numpy() for c in VALUES])
    own = at < BUCKETS
    out.e[at[own]] = values[own].astype(np.float32)
    out.g_e[at[own]] = mean["g"].to_numpy()[own]
    flat, i = values[~own].ravel(), 0
    for v in out.dense() if len(flat) else []:
        v[...] = flat[i:i + v.size].reshape(v.shape).astype(v.dtype)
        i += v.size
    return out


def calibrated(rows: DataFrame, model: Model) -> np.ndarray:
    """Each guessed language's best threshold, from the logits of all rows, counted in steps of 1 / STEPS."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def value(batches):
        m = shared.value
        for b in batches:
            docs, words = coded_words(b["codes"])
            guess = [int(m.frequency[words[d, 0]].sum(0).argmax()) if m.languages and len(d) else 0 for d in docs]
            at = [round(STEPS * max(-LARGEST, min(LARGEST, logit(m, embedded(m.embedding, words[d]))))) for d in docs]
            yield pd.DataFrame({"guess": np.array(guess, np.int32), "at": np.array(at, np.int32), "toxic": b["toxic"].to_numpy(np.int64)})

    found = rows.mapInPandas(value, "guess int, at int, toxic long").groupBy("guess", "at").agg(
        F.sum("toxic").alias("hits"), F.sum(1 - F.col("toxic")).alias("wrongs")).orderBy("guess", "at").toArrow()
    guess, at, hits, wrongs = (found[c].to_numpy() for c in ("guess", "at", "hits", "wrongs"))
    steps, place = np.unique(at, return_inverse=True)
    whole = best_cut(steps / STEPS, np.bincount(place, hits, len(steps)), np.bincount(place, wrongs, len(steps)), 0.0)
    return np.array([best_cut(at[guess == k] / STEPS, hits[guess == k], wrongs[guess == k], whole) for k in range(max(1, len(model.languages)))])


def fit_all(docs: DataFrame, labels: DataFrame, seed: int = 1) -> Model:
    """The model of every labelled document: counts, training and thresholds are Spark jobs over all of them."""
    small_arrow_batches(docs.sparkSession)
    rows = written(coded(labelled_rows(docs, labels)), "toxicity_labelled", "zstd")
    seen, n, names, words_in = counted(rows)
    state = start(seen, n, np.random.default_rng(seed))
    for k in range(EPOCHS):
        state = trained_once(rows.where(~F.col("tuning")), state, label_share(n), seed + k)
    model = state.model()
    model.languages, model.frequency = names, log_frequencies(words_in)
    model.thresholds = calibrated(rows.where("tuning"), model)
    return model


def scorer(model: Model):
    """A function from texts to scores."""
    shift = np.log(CUT / (1 - CUT))

    def score(texts: pa.Array) -> list[float]:
        codes, at, ends = coder()(texts)
        buckets = buckets_in(codes)
        x, languages = embedded(model.embedding, buckets), model.frequency[buckets[:, 0]]
        out = []
        for a, b in zip(ends, ends[1:], strict=False):
            own = at[a:b]
            k = int(languages[own].sum(0).argmax()) if model.languages and len(own) else 0
            value = logit(model, x[own]) - model.thresholds[k] + shift
            out.append(float(1 / (1 + np.exp(-np.clip(value, -50, 50)))))
        return out

    return score


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` plus a score from 0 to 1 of the whole text; null texts count as empty and score the model's offset."""
    small_arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by BUCKETS and the languages

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        score = scorer(shared.value)
        return pa.array([y for some in slices(texts) for y in score(some)], pa.float64())

    return docs.withColumn(out, of(text_of(docs, text_col)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels")
    model = fit_all(docs.where(~held_out(docs["doc_id"], 3, 1)), labels.where(~held_out(labels["doc_id"], 3, 1)))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), F.col("toxicity").alias("score"),
                         F.when(F.col("toxicity") >= CUT, 1).otherwise(0).cast("int").alias("predicted"))
