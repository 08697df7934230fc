"""Loads that commit: bars by month, and run, quality, lineage and checkpoint rows by load.

A load upserts its fresh, valid rows into the months that they touch and then writes its states. Every write replaces
whole partitions (months of bars, the load's own partition of a state table), bars first, the run row last. A load is
committed by its run row, and checkpoints count only if their load is; a load that ended early and is run again reads
the same checkpoints and so takes the same rows, finds its own earlier inserts by their load, and leaves the same
tables as one that ran through. A load that is committed does nothing when it is run again.

Defined cases: undated rows are fresh; a symbol without fresh rows is skipped, one whose fresh rows are all invalid fails;
an empty source gives a run of no rows. Extra columns of the source are left out; equal keys go to the least ``seq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import quality
from panelforge.operators.upsert import KEY, first_wins
from panelforge.sources.files import folder

VALUES = ["open", "high", "low", "close", "volume"]
BARS = "symbol string, trade_date date, timeframe string, adjusted boolean, open double, high double, low double, close double, volume double, created_load string, created_at string, load string, updated_at string, month string"
STATES = {
    "runs": "dataset string, received long, fresh long, written long, inserted long, updated long, completed long, skipped long, failed long, status string, at string, load string",
    "quality": "rule string, failed long, load string",
    "lineage": "symbol string, rows long, first_day date, last_day date, load string",
    "checkpoints": "symbol string, last_success date, status string, load string",
}


class Killed(Exception):
    """Raised in place of the step after which a load was told to end."""


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A state table; before its first load it has no rows."""
    return _read(spark, f"{root}/{name}", STATES[name])


def read_bars(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/bars", BARS)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def last_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """symbol, last_success over all committed loads."""
    done = read_state(spark, root, "runs").select("load").distinct()
    return read_state(spark, root, "checkpoints").join(F.broadcast(done), "load", "left_semi").groupBy("symbol").agg(F.max("last_success").alias("last_success"))


def _replace(df: DataFrame, path: str, part: str) -> None:
    # a part's rows meet before they are written, or each task would leave a file in each part; large parts are split again
    df.hint("rebalance", F.col(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def load(source: DataFrame, root: str, load_id: str, at: str, requested_start: str, resume: bool = True, end_after: str | None = None) -> None:
    """Run a load of raw rows (key, values, ``seq``). ``resume``: rows up to a symbol's checkpoint are not taken again.

    ``end_after``: end with ``Killed`` behind the step of this name, as a load that dies there; for tests of recovery."""
    spark = source.sparkSession

    def step(name: str) -> None:
        if name == end_after:
            raise Killed(name)

    if not read_state(spark, root, "runs").where(F.col("load") == load_id).isEmpty():
        return
    rows = source.select(*KEY, *VALUES, "seq")
    start = F.lit(requested_start).cast("date")
    if resume:
        # as many rows as symbols: the size of the join's other side is the plan's to judge
        rows = rows.join(last_checkpoints(spark, root), "symbol", "left")
        start = F.greatest(start, F.date_add("last_success", 1))
    rows = quality.CHECKED.apply(rows.withColumn("fresh", F.col("trade_date").isNull() | (F.col("trade_date") >= start)))
    staged = f"{folder(spark)}/rows"
    rows.withColumn("valid", F.col("fresh") & F.col("valid")).write.parquet(staged)
    rows = spark.read.parquet(staged)
    new = first_wins(rows.where("valid"), KEY, ["seq"]).select(*KEY, *VALUES, F.date_format("trade_date", "yyyy-MM").alias("month"))

    merged = f"{folder(spark)}/bars"
    old = read_bars(spark, root).join(new.select("month").distinct(), "month", "left_semi")
    old = old.select(*KEY, "month", F.struct(*VALUES, "created_load", "created_at", "load", "updated_at").alias("o"))
    both = old.join(new.select(*KEY, "month", F.struct(*VALUES).alias("n")), [*KEY, "month"], "full")
    taken, there = F.col("n").isNotNull(), F.col("o").isNotNull()
    columns = [F.when(taken, F.col(f"n.{v}")).otherwise(F.col(f"o.{v}")).alias(v) for v in VALUES]
    born = [F.when(there, F.col(f"o.{c}")).otherwise(F.lit(x)).alias(c) for c, x in (("created_load", load_id), ("created_at", at))]
    last = [F.when(taken, F.lit(x)).otherwise(F.col(f"o.{c}")).alias(c) for c, x in (("load", load_id), ("updated_at", at))]
    both.select(*KEY, *columns, *born, *last, "month").write.parquet(merged)
    step("stage")
    done = spark.read.schema(BARS).parquet(merged)
    _replace(done, f"{root}/bars", "month")
    step("bars")

    mine = done.where(F.col("load") == load_id)
    told = rows.groupBy("symbol").agg(F.count("*").alias("received"), F.count(F.when(F.col("fresh"), 1)).alias("fresh"))
    written = mine.groupBy("symbol").agg(F.count("*").alias("rows"), F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"), F.count(F.when(F.col("created_load") == load_id, 1)).alias("inserted"))
    by_symbol = f"{folder(spark)}/symbols"
    status = F.when(F.col("fresh") == 0, "skipped_already_current").when(F.col("rows").isNull(), "failed").otherwise("completed")
    told.join(written, "symbol", "left").withColumn("status", status).withColumn("load", F.lit(load_id)).write.parquet(by_symbol)
    symbols = spark.read.parquet(by_symbol)

    counts = rows.where("fresh").agg(*[F.count(F.when(F.expr(e), 1)).alias(rule) for rule, e in quality.BAR_RULES.items()])
    per_rule = counts.select(F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("failed")) for rule in quality.BAR_RULES])).alias("r"))
    _replace(per_rule.select("r.*", F.lit(load_id).alias("load")), f"{root}/quality", "load")
    _replace(symbols.where("rows > 0").select("symbol", "rows", "first_day", "last_day", "load"), f"{root}/lineage", "load")
    step("lineage")
    _replace(symbols.select("symbol", F.col("last_day").alias("last_success"), "status", "load"), f"{root}/checkpoints", "load")
    step("checkpoints")
    is_ = lambda s: F.count(F.when(F.col("status") == s, 1))
    total = symbols.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("received", "fresh")], F.coalesce(F.sum("rows"), F.lit(0)).alias("written"), F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted"), is_("completed").alias("completed"), is_("skipped_already_current").alias("skipped"), is_("failed").alias("failed"))
    ended = F.when(F.col("failed") == 0, "SUCCESS").when(F.col("completed") + F.col("skipped") == 0, "FAILED").otherwise("PARTIAL")
    run = total.select(F.lit("bars").alias("dataset"), "received", "fresh", "written", "inserted", (F.col("written") - F.col("inserted")).alias("updated"), "completed", "skipped", "failed", ended.alias("status"), F.lit(at).alias("at"), F.lit(load_id).alias("load"))
    _replace(run, f"{root}/runs", "load")
