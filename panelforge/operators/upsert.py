"""Upserts, snapshots and incremental loads as joins; nothing is overwritten while it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.plans.recipe import Recipe

KEY = ["symbol", "trade_date", "timeframe", "adjusted"]


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def upsert(target: DataFrame, source: DataFrame, key: list[str], order: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Target rows whose key the source lacks, and the source's first row of each key, told by ``action``.

    The key is unique in the target. Columns in ``keep`` stay as they are in rows that are updated. One join."""
    others = [c for c in target.columns if c not in key]
    new = first_wins(source, key, order).select(*key, *[F.col(c).alias(f"_new_{c}") for c in others], F.lit(True).alias("_new"))
    both = target.withColumn("_old", F.lit(True)).join(new, key, "full")
    taken = {c: F.col("_new") if c not in keep else F.col("_old").isNull() for c in others}
    columns = [F.when(taken[c], F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in others]
    action = F.when(F.col("_new").isNull(), "kept").when(F.col("_old"), "updated").otherwise("inserted")
    return both.select(*key, *columns, action.alias("action"))


def _write_status(key: str, dry_run: bool = False) -> Column:
    return F.when(F.col(key).isNull(), "REJECTED").when(F.col("_same"), "IDEMPOTENT_NOOP").when(F.col("_taken"), "CONFLICT").otherwise("DRY_RUN_READY" if dry_run else "WRITE_ACCEPTED")


def snapshot_status(target: DataFrame, source: DataFrame, grain: list[str], key: str, dry_run: bool = False) -> DataFrame:
    """Source rows with what a write would do: no key is rejected, same key is a no-op, same grain under another key a conflict."""
    keys = target.select(key).distinct().withColumn("_same", F.lit(True))
    grains = target.select(*grain).distinct().withColumn("_taken", F.lit(True))
    both = source.join(keys, key, "left").join(grains, grain, "left")
    return both.withColumn("write_status", _write_status(key, dry_run)).drop("_same", "_taken")


def snapshot_status_by_grain(both: DataFrame, grain: list[str], key: str, stored: str) -> DataFrame:
    """The same where the key is a digest of the grain and more, so that rows of one key share their grain.

    ``both`` holds the rows of target and source, those of the target told by ``stored``; where they lie together by columns
    of the grain nothing is dealt anew."""
    place = Window.partitionBy(*grain)
    told = both.withColumns({"_taken": F.max(stored).over(place), "_held": F.collect_set(F.when(F.col(stored), F.col(key))).over(place)})
    told = told.withColumn("_same", F.array_contains("_held", F.col(key)))
    return told.where(~F.col(stored)).withColumn("write_status", _write_status(key)).drop("_same", "_taken", "_held", stored)


def load_summary(source: DataFrame, checkpoints: DataFrame, checked: Recipe, requested_start: str) -> DataFrame:
    """Per symbol: rows received, new, valid and first of their key, its next checkpoint and status.

    New rows come after the symbol's checkpoint and not before the requested start; undated rows are new. ``checked`` adds
    ``valid``. One pass: every row is told by flags, which one grouping counts."""
    start = F.greatest(F.lit(requested_start).cast("date"), F.date_add("last_success", 1))
    rows = source.join(checkpoints.select("symbol", "last_success"), "symbol", "left")
    rows = checked.apply(rows.withColumn("_fresh", F.col("trade_date").isNull() | (F.col("trade_date") >= start)))
    good = F.col("_fresh") & F.col("valid")
    place = F.row_number().over(Window.partitionBy(*KEY, good).orderBy("seq"))
    rows = rows.withColumn("_taken", good & (place == 1))
    told = rows.groupBy("symbol").agg(
        F.count("*").alias("received"), F.count(F.when(F.col("_fresh"), 1)).alias("fresh"), F.count(F.when(F.col("_taken"), 1)).alias("written"),
        F.coalesce(F.max(F.when(F.col("_taken"), F.col("trade_date"))), F.max("last_success")).alias("checkpoint"),
    )
    return told.withColumn("status", F.when(F.col("fresh") == 0, "skipped_already_current").when(F.col("written") == 0, "failed").otherwise("completed"))
