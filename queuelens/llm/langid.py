"""Language ID by word-first backoff.

Known words are scored by their log frequency in each language.  A word that
is not known falls back to character n-grams: at each place of the word the
longest known n-gram counts, from ``ORDER`` characters down to one.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.llm.common import small_arrow_batches, table, text_of

SAMPLE = 1500      # documents a language at most that the model is fitted on, chosen by hash
LANGUAGES = 256    # most frequent languages learned
LEAST = 2          # occurrences in the sample of a word or n-gram that is learned
ORDER = 4
EVIDENCE = 10.0    # words' worth of evidence behind a score: longer texts do not saturate it
CACHED = 200_000   # unseen words remembered by a Python worker
UNKNOWN = "und"
LEAST_LIFT = 1.05  # the pipeline rejects a document whose score is not this many times that of a blind guess

# A word is a maximal run of letters (Unicode category L), in fitting and in predicting.
_ALNUM = re.compile(r"[^\W\d_]+")   # letters and numbers that are no digits, such as a half
LETTERS = r"\p{L}+"


def words_of(text: str) -> list[str]:
    found = _ALNUM.findall(text.lower())
    return found if "".join(found).isalpha() else regex.findall(LETTERS, text.lower())


@dataclass
class Model:
    """Log frequencies: matrix rows for known words, and n-gram vectors, over ``languages``."""

    languages: list[str]
    words: dict[str, int] = field(default_factory=dict)
    matrix: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    grams: dict[str, np.ndarray] = field(default_factory=dict)

    def backoff(self, word: str) -> np.ndarray:
        padded = f" {word} "
        total = np.zeros(len(self.languages))
        n = 0
        for i in range(len(padded)):
            for k in range(min(ORDER, len(padded) - i), 0, -1):
                v = self.grams.get(padded[i:i + k])
                if v is not None:
                    total += v
                    n += 1
                    break
        return total / max(n, 1)


def _log_frequencies(rows: list, languages: list[str]) -> dict[str, np.ndarray]:
    """item -> log((count + 1) / (language's total + items)), centred, from rows (lang, item, n)."""
    counts: dict[str, np.ndarray] = {}
    place = {x: i for i, x in enumerate(languages)}
    for r in rows:
        counts.setdefault(r["item"], np.zeros(len(languages)))[place[r["lang"]]] += r["n"]
    total = sum(counts.values(), np.zeros(len(languages)))
    out = {}
    for item, c in counts.items():
        v = np.log((c + 1) / (total + len(counts)))
        out[item] = v - v.mean()
    return out


def bounded_sample(docs: DataFrame, lang: Column, key: Column, per_language: int) -> tuple[DataFrame, list[str]]:
    """About ``per_language`` documents of each language at most, chosen by a hash of ``key``."""
    named = docs.withColumns({"lang": lang, "draw": F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_000))})
    counts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return named.where(F.lit(False)), []
    limit = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(math.ceil(1e6 * per_language / n)))])
    return named.where(F.col("draw") < limit[F.col("lang")]), sorted(counts)   # other languages have no limit, so no row


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Model of the labelled rows; rows whose language is null are left out."""
    rows = labelled.where(labelled[lang_col].isNotNull()).select(
        F.coalesce(labelled[id_col].cast("string"), F.lit("")).alias("key"), text_of(labelled, text_col).alias("text"),
        labelled[lang_col].cast("string").alias("lang"))
    sample, languages = bounded_sample(rows, F.col("lang"), F.col("key"), SAMPLE)
    if not languages:
        return Model([])
    words = (sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0))).alias("item"))
             .groupBy("lang", "item").agg(F.count("*").alias("n"))).persist()
    padded = F.concat(F.lit(" "), F.col("item"), F.lit(" "))
    grams = words.select("lang", "n", padded.alias("p")).select("lang", "n", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), F.least(F.lit(ORDER), F.length("p"))),
        lambda k: F.transform(F.sequence(F.lit(1), F.length("p") - k + 1), lambda i: F.substring(F.col("p"), i, k))))).alias("item"))
    grams = grams.groupBy("lang", "item").agg(F.sum("n").alias("n"))

    def often(counts: DataFrame) -> DataFrame:
        """Rows of the items seen ``LEAST`` times in all; the sample bounds their number."""
        return counts.join(counts.groupBy("item").agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST).select("item"), "item", "left_semi")

    try:
        known = _log_frequencies(often(words).collect(), languages)
        short = _log_frequencies(often(grams).collect(), languages)
    finally:
        words.unpersist()
    matrix = np.array(list(known.values())) if known else np.zeros((0, len(languages)))
    return Model(languages, {w: i for i, w in enumerate(known)}, matrix, short)


def predictor(model: Model):
    """A function from texts to (languages, scores); keeps what it worked out for unseen words."""
    seen: dict[str, int] = dict(model.words)
    matrix = np.zeros((len(seen) + CACHED, max(1, len(model.languages))))
    if seen:
        matrix[:len(seen)] = model.matrix

    def predict(texts) -> tuple[list[str], list[float]]:
        nonlocal seen
        langs, scores = [], []
        for text in texts:
            words = words_of(text) if text else []
            if not words or not model.languages:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            new = set(words).difference(seen)
            if len(seen) + len(new) > len(matrix):
                seen = dict(model.words)
                new = set(words).difference(seen)
            total = np.zeros(len(model.languages))
            for w in new:
                if len(seen) < len(matrix):
                    matrix[len(seen)] = model.backoff(w)
                    seen[w] = len(seen)
            if len(new) <= CACHED:
                total = matrix[np.fromiter(map(seen.__getitem__, words), np.int64, len(words))].sum(0)
            else:  # one text with more unseen words than are remembered
                for w in words:
                    total += matrix[seen[w]] if w in seen else model.backoff(w)
            total *= min(1.0, EVIDENCE / len(words))
            p = np.exp(total - total.max())
            best = int(p.argmax())
            langs.append(model.languages[best])
            scores.append(float(p[best] / p.sum()))
        return langs, scores

    return predict


def identify(docs: DataFrame, model: Model, text_col: str = "text", pred: str = "lang_pred",
             score: str = "lang_score") -> DataFrame:
    """``docs`` plus the predicted language and its score from the whole text.

    ``und`` with score 0 stands for null texts and texts without a letter;
    equal scores go to the first language in alphabetical order; without any
    labelled row every text is ``und``.
    """
    small_arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE and LANGUAGES
    state: dict = {}

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        if "predict" not in state:
            state["predict"] = predictor(shared.value)
        langs, scores = state["predict"](texts)
        return pd.DataFrame({"lang": langs, "score": scores})

    # marked as not deterministic so that a filter and a column on it share one evaluation
    return (docs.withColumn("__found", of.asNondeterministic()(text_of(docs, text_col)))
            .withColumns({pred: F.col("__found.lang"), score: F.col("__found.score")}).drop("__found"))


def held_out(doc_id: Column, divisor: int, remainder: int) -> Column:
    """crc32 of the id as text falls on the remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor == remainder


def fitted(docs: DataFrame) -> Model:
    """The model of the documents outside the held-out quarter."""
    return fit(docs.where(~held_out(docs["doc_id"], 4, 2)))


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """``docs`` without those that have no letter or fit no language; a null ``lang`` is filled in."""
    model = fitted(docs)
    found = identify(docs, model, pred="__lang", score="__score")
    least = LEAST_LIFT / len(model.languages) if len(model.languages) > 1 else 0.0
    stay = found.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= least))
    return stay.withColumn("lang", F.coalesce("lang", "__lang")).select(*docs.columns)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, fitted(docs)).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
