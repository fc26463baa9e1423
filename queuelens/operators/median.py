"""Exact upper median without sorting the rows.

The reference takes ``ORDER BY x LIMIT 1 OFFSET count/2`` -- the value at
0-based position ``n // 2``, i.e. the *upper* median for even ``n``.  A global
sort or ``row_number()`` over all rows would put everything through one
ordering; instead:

1. coarse histogram: ``floor(x)`` -> count (partial aggregate; one row per
   whole unit of x, e.g. per hour);
2. a running sum over that small histogram picks the one bin holding
   position ``n // 2`` and the number of values below it;
3. fine histogram of exact values inside that bin only (the chosen bin is
   one row, broadcast) and a running sum over it picks the value.

Both windows run over histograms, never over rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upper_median(df: DataFrame, col: str, out_col: str = "median",
                 mean_col: str | None = None, mean_digits: int | None = None,
                 mean_scale: int = 2) -> DataFrame:
    """One row: value at position ``count(col) // 2`` ascending (NULL if none).

    With ``mean_col`` the row also carries the mean of ``col``, taken from an
    exact DECIMAL(18, ``mean_scale``) sum kept in the same coarse histogram
    (rounded to ``mean_digits``), so mean and median cost one scan together.
    """
    vals = df.select(F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    dec_sum = (F.sum(F.col("_v").cast(f"decimal(18,{mean_scale})")) if mean_col
               else F.lit(None).cast(f"decimal(28,{mean_scale})"))
    bins = vals.groupBy(F.floor("_v").alias("_bin")).agg(F.count(F.lit(1)).alias("_c"), dec_sum.alias("_s"))
    running = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()     # over the histogram rows only
    chosen = (bins
              .withColumn("_cum", F.sum("_c").over(running))
              .withColumn("_n", F.sum("_c").over(everything))
              .withColumn("_sum", F.sum("_s").over(everything))
              .withColumn("_k", F.floor(F.col("_n") / 2))
              .filter((F.col("_cum") - F.col("_c") <= F.col("_k")) & (F.col("_k") < F.col("_cum")))
              .select("_bin", (F.col("_cum") - F.col("_c")).alias("_below"), "_k", "_n", "_sum"))
    inside = (vals.withColumn("_bin", F.floor("_v"))
              .join(F.broadcast(chosen), "_bin", "inner")       # exactly one bin row
              .groupBy("_v", "_below", "_k", "_n", "_sum").agg(F.count(F.lit(1)).alias("_c")))
    fine = Window.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = (inside.withColumn("_cum", F.sum("_c").over(fine) + F.col("_below"))
              .filter((F.col("_cum") - F.col("_c") <= F.col("_k")) & (F.col("_k") < F.col("_cum"))))
    outs = [F.max("_v").alias(out_col)]
    if mean_col:
        mean = F.try_divide(F.max("_sum").cast("double"), F.max("_n").cast("double"))
        outs.insert(0, (F.round(mean, mean_digits) if mean_digits is not None else mean).alias(mean_col))
    return picked.agg(*outs)
