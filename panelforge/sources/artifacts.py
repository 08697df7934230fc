"""Daily artifacts: a folder of rows for each day, a summary row for each, and the batch's manifest over the days that were due.

The manifest is read from what lies in the folders, not from what was meant to be written. A day that was not due but has
rows is extra; a day that was due and has none is missing. A run over the same days replaces them and leaves the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_days(rows: DataFrame, path: str, day: str = "trade_date") -> None:
    """One folder a day, whole days replaced. Rows of a day come from one task unless there are too many for one."""
    rows.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 5_000_000).partitionBy(day).parquet(path)


def summaries(spark: SparkSession, path: str, day: str = "trade_date", key: str = "symbol") -> DataFrame:
    """day, n_rows, n_keys, first_key, last_key of each folder."""
    found = spark.read.parquet(path)
    return found.groupBy(F.col(day).cast("date").alias("day")).agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def batch_manifest(summary: DataFrame, due: DataFrame, batch: str = "yyyy-MM") -> DataFrame:
    """batch, due, found, extra, missing_days, n_rows, status over the days of ``due`` and of the summaries."""
    both = due.select("day").distinct().withColumn("due", F.lit(True)).join(summary, "day", "full")
    is_due, there = F.coalesce("due", F.lit(False)), F.col("n_rows").isNotNull()
    told = both.groupBy(F.date_format("day", batch).alias("batch")).agg(
        F.count(F.when(is_due, 1)).alias("due"), F.count(F.when(is_due & there, 1)).alias("found"), F.count(F.when(~is_due, 1)).alias("extra"),
        F.array_sort(F.collect_list(F.when(is_due & ~there, F.col("day")))).alias("missing_days"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )
    return told.withColumn("status", F.when(F.size("missing_days") == 0, "COMPLETE").when(F.col("found") > 0, "PARTIAL").otherwise("MISSING"))
