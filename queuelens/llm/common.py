"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelens.session import scratch_path

# ASCII letters, and the white space that separates words.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_of(df: DataFrame, text_col: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


NO_ID = 2 ** 63 - 1   # a null id on its way through pandas, which would turn a column with nulls into floats


def known_id(df: DataFrame, id_col: str = "doc_id") -> Column:
    """The id as a long that is never null; see :func:`true_id`."""
    return F.coalesce(df[id_col].cast("long"), F.lit(NO_ID))


def true_id(col: str = "doc_id") -> Column:
    return F.nullif(F.col(col), F.lit(NO_ID)).alias(col)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: ``df`` as a Parquet table in the cluster's shared folder.

    A later stage that loses an executor rereads the table instead of
    computing everything anew, and values such as generated row numbers are
    frozen in it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small_arrow_batches(spark: SparkSession, rows: int = 256) -> None:
    """Rows per Arrow batch, so that long texts do not fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def list_places(lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists of these lengths that lie one after another: the places of the entries of the lists ``numbers``, in
    their order, and where each of these ends among them (0 first)."""
    n = lengths[numbers]
    ends = np.concatenate([[0], np.cumsum(n)])
    return np.arange(ends[-1]) + np.repeat((np.cumsum(lengths) - lengths)[numbers] - ends[:-1], n), ends


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_rows(docs: DataFrame, stay: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` named by ``stay``(doc_id, text_key), one for each, with all their columns.

    text_key is the text's xxhash64.  Rows that repeat id and text meet in the
    join's own partitioning and order, so keeping one of them costs no shuffle.
    """
    named = docs.withColumns({"__id": docs[id_col].cast("long"), "__key": F.xxhash64(text_of(docs, text_col))})
    wanted = stay.select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__text"))
    left = named.join(wanted, named["__id"].eqNullSafe(wanted["__doc"]) & (named["__key"] == wanted["__text"]), "left_semi")
    one = Window.partitionBy("__id", "__key").orderBy("__id")
    return left.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*docs.columns)
