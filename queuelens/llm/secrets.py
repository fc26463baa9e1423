"""Secret scans with corpus-wide ownership frequency, with DataFrame operations only.

Fixed patterns find candidates in whole texts.  A candidate's value is hashed,
and the hashes are counted over the corpus by distinct repositories and
owners: a value that many owners or repositories hold is a copied example, a
value that one owner alone holds in a few places is a live-looking credential.
The patterns of ``BASE`` are spans whatever their frequency says;
generic candidates become spans (kind ``owned``) only when they are live-looking.

Offsets come from lengths: splitting a text by a pattern gives the gaps
between the matches, and the running sum of gap and match lengths gives every
match's place in code points, linear in the number of matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.llm.common import table, text_of, written

# Kinds in their order, patterns (Java syntax, ASCII case folding), least lengths.
# Runs of one character class need no second length test: {16,} finds the maximal
# runs of 16 or more just as + does.  The assignment must be matched with + first,
# since a short value hides what follows it.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
GENERIC = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = [*BASE, "owned"]
LEAST_ASSIGN = 12

MAX_OWNERS = 1         # a live-looking credential has one owner ...
MAX_REPOSITORIES = 2   # ... and lies in this many repositories at most
LEAST_DISTINCT = 10    # distinct characters of a generic candidate


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """array<struct<kind, gap, value>>: for each match the length of the gap before it, and its text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("value")),
        lambda x: F.struct(F.lit(kind).alias("kind"), x["gap"].alias("gap"), x["value"].alias("value")))
    return F.when(text.rlike(pattern), pairs).otherwise(F.slice(pairs, 1, 0))


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                    repo_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, candidates), both written tables.

    rows: row, doc_id, text_key, one for each input row.  candidates: row,
    doc_id, owner, repo, kind (place in KINDS), start, end, hash (SHA-256 of
    the secret value).  Without ``repo_col`` each document is a repository of its owner.
    """
    named = docs.select(
        docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"),
        F.coalesce(docs[owner_col].cast("string"), F.lit("")).alias("owner"),
        F.coalesce((docs[repo_col] if repo_col else docs[id_col]).cast("string"), F.lit("")).alias("repo"))
    patterns = [*BASE.values(), GENERIC]
    scanned = written(named.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repo",
        F.xxhash64("text").alias("text_key"),
        F.array(*[_matches(F.col("text"), k, p) for k, p in enumerate(patterns)]).alias("found")), "secrets_scanned")

    each = (scanned.where(F.exists("found", lambda x: F.size(x) > 0))
            .select("row", "doc_id", "owner", "repo", F.explode("found").alias("f"))
            .select("row", "doc_id", "owner", "repo", F.posexplode("f").alias("n", "f"))
            .select("row", "doc_id", "owner", "repo", "n", "f.*"))
    so_far = Window.partitionBy("row", "kind").orderBy("n")
    length = F.length("value")
    placed = each.withColumn("end", F.sum(F.col("gap") + length).over(so_far)).withColumn("start", F.col("end") - length)
    secret = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 2)).otherwise(F.col("value"))
    varied = F.size(F.array_distinct(F.split("secret", "")))
    is_kind = {k: F.col("kind") == n for n, k in enumerate(KINDS)}
    candidates = placed.withColumn("secret", secret).where(
        F.when(is_kind["assign"], F.length("secret") >= LEAST_ASSIGN)
        .when(is_kind["owned"], F.col("secret").rlike("[0-9]") & F.col("secret").rlike("[A-Za-z]") & (varied >= LEAST_DISTINCT))
        .otherwise(F.lit(True)))
    return (scanned.select("row", "doc_id", "text_key"),
            written(candidates.select("row", "doc_id", "owner", "repo", "kind", "start", "end",
                                      F.unhex(F.sha2("secret", 256)).alias("hash")), "secrets_candidates"))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash -> n_found, n_repos, n_owners.

    Three steps, each pre-aggregated in the map tasks: a value copied into a
    third of all documents crosses the network as one row per task and step.
    """
    by_repo = candidates.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_found"), F.sum("repos").alias("n_repos"),
                                        F.count("*").alias("n_owners"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str | None = None, max_owners: int = MAX_OWNERS,
                 max_repos: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per input row: doc_id, text_key, spans array<struct<start,ord,end,kind,live>>, sorted.

    ``live``: the value belongs to one owner and few repositories.  Null texts
    count as empty and have no spans; null owners and repositories count as
    one; an empty table gives an empty result.  Repeated rows give repeated
    results.
    """
    rows, candidates = find_candidates(docs, id_col, text_col, owner_col, repo_col)
    rates = ownership(candidates).select(
        "hash", ((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)).alias("live"))
    # the hot side of this join is split by the adaptive skew join; the rates have one row a hash
    judged = candidates.join(rates, "hash").where((F.col("kind") < len(BASE)) | F.col("live"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.col("kind").alias("ord"), "end", kind.alias("kind"), "live"))).alias("spans"))
    return rows.join(spans, "row", "left").select(
        "doc_id", "text_key", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                   mask: str = "<secret>") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; overlapping spans become one mask.

    Null texts stay null, texts without a span and all other columns stay as
    they are, repeated rows are masked alike, an empty table stays empty.  The
    text is cut in an encoding of four bytes a character, where a piece costs
    its own length, so a text with many spans takes linear time.
    """
    one = scan_secrets(docs, id_col, text_col, owner_col).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "spans").dropDuplicates(["__id", "__key"])
    each = one.select("__id", "__key", F.explode("spans").alias("s")).select("__id", "__key", "s.start", "s.end")
    order = Window.partitionBy("__id", "__key").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = each.withColumn("new", F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0))
    masks = fresh.withColumn("mask", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("__id", "__key", "mask").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    found = masks.groupBy("__id", "__key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__masks"))
    text = text_of(docs, text_col)
    named = docs.withColumns({"__doc": docs[id_col].cast("long"), "__text": F.xxhash64(text)})
    joined = named.join(found, named["__doc"].eqNullSafe(found["__id"]) & (named["__text"] == found["__key"]), "left")
    joined = joined.withColumn("__wide", F.when(F.col("__masks").isNotNull(), F.encode(text, "UTF-32")))

    def piece(start: Column, end: Column) -> Column:
        return F.decode(F.substring("__wide", (4 * start + 1).cast("int"), (4 * (end - start)).cast("int")), "UTF-32")

    # "__wide" is named twice below, so Spark evaluates it once a row and not once a piece
    heads = F.transform("__masks", lambda m, i: piece(F.when(i > 0, F.get("__masks", i - 1)["end"]).otherwise(F.lit(0)), m["start"]))
    tail = piece(F.element_at("__masks", -1)["end"], F.length("__wide") / 4)
    done = F.array_join(F.concat(heads, F.array(tail)), mask)
    return joined.withColumn(text_col, F.when(F.col("__masks").isNull(), docs[text_col]).otherwise(done)).select(*docs.columns)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["ord"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"))
