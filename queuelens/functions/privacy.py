"""pii_mask, pii_hmac: tokenize customer ids before they reach analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelens.functions.text import strip_ws

BLOCK = 64            # bytes that SHA-256 takes at a time
INNER, OUTER = 0x36, 0x5C   # fixed values: the pads of a keyed hash


def mask_customer(col: Column | str, salt: str) -> Column:
    """Salted SHA-256 of the normalised id (hex).  Same id -> same token.

    The salt is a literal of the plan, so whoever may read plans may guess
    ids; :func:`mask_customers` keeps its key out of them."""
    return F.sha2(F.concat(F.lit(salt), F.upper(strip_ws(col))), 256)


def _padded(key: Column, pad: int) -> Column:
    """The key, filled up to a block with zeros and combined with the pad, as bytes; a longer key counts by its hash."""
    short = F.when(F.octet_length(key) > BLOCK, F.unhex(F.sha2(key, 256))).otherwise(key)
    digits = F.rpad(F.hex(short), 2 * BLOCK, "0")
    byte = lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
    mixed = F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: F.lpad(F.hex(byte(i).bitwiseXOR(F.lit(pad))), 2, "0"))
    return F.unhex(F.array_join(mixed, ""))


def hmac_sha256(message: Column, inner: Column, outer: Column) -> Column:
    """HMAC-SHA-256 (hex) of a message's bytes, from the key's two padded blocks."""
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def key_blocks(spark: SparkSession, key_path: str) -> DataFrame:
    """One row (inner, outer) from the bytes of a key file; an error unless there is exactly one non-empty file."""
    found = spark.read.format("binaryFile").load(key_path).agg(F.count("*").alias("n"), F.min("content").alias("key"))
    usable = (F.col("n") == 1) & (F.octet_length("key") > 0)
    key = F.when(usable, F.col("key")).otherwise(F.raise_error(F.lit("the key is not one file with content")).cast("binary"))
    return found.select(key.alias("key")).select(_padded(F.col("key"), INNER).alias("inner"), _padded(F.col("key"), OUTER).alias("outer"))


def mask_customers(df: DataFrame, key_path: str, col: str = "customer_id", out: str = "customer_token") -> DataFrame:
    """pii_hmac: ``df`` plus a keyed token of the normalised id; same key and id -> same token, null stays null.

    The key is read by Spark from a file that only the job may read, and
    reaches the rows as a scalar subquery: neither the plan nor the event log
    holds it, and without it a token cannot be tried against guessed ids.
    """
    blocks = key_blocks(df.sparkSession, key_path)
    message = F.upper(strip_ws(col)).cast("binary")
    return df.withColumn(out, hmac_sha256(message, blocks.select("inner").scalar(), blocks.select("outer").scalar()))
