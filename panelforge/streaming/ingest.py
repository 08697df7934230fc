"""Streamed ingest of raw bars: new files are checked, good rows deduplicated and appended, the rest quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelforge.operators import normalize
from panelforge.operators.upsert import first_wins

RAW = T.StructType([T.StructField(n, T.StringType()) for n in ("ticker", "date", "open", "high", "low", "close", "volume", "transactions", "adjusted")])


def stream_bars(spark: SparkSession, folder: str, lateness: str = "30 days") -> DataFrame:
    """Checked bars of a folder of CSV files, with a watermark; ``dedupe`` keeps each key once, here every row passes."""
    raw = spark.readStream.schema(RAW).option("header", True).csv(folder)
    checked = normalize.STOCK_DAY.apply(raw).withColumn("event_time", F.col("trade_date").cast("timestamp"))
    return checked.withWatermark("event_time", lateness)


def ingest(spark: SparkSession, folder: str, accepted: str, quarantine: str, checkpoint: str) -> StreamingQuery:
    """Drain what is new in ``folder``. The stream's checkpoint is the load's: a rerun starts after it.

    Each micro-batch overwrites a folder named by its number, so a batch that is run again leaves no second copy."""

    def write(batch: DataFrame, number: int) -> None:
        good = batch.where("accepted").select("symbol", "trade_date", *[F.col(f"{p}_value").alias(p) for p in normalize.PRICES], F.col("volume_value").alias("volume"), F.col("is_adjusted").alias("adjusted"))
        first_wins(good, ["symbol", "trade_date", "adjusted"], [*normalize.PRICES, "volume"]).write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        batch.where("NOT accepted").select("ticker", "date", "reasons").write.mode("overwrite").json(f"{quarantine}/batch={number}")

    checked = stream_bars(spark, folder)
    return checked.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bars_so_far(spark: SparkSession, accepted: str) -> DataFrame:
    """First row of each key over all batches."""
    return first_wins(spark.read.parquet(accepted), ["symbol", "trade_date", "adjusted"], ["batch"]).drop("batch")


def event_windows(events: DataFrame, width: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Counts and sums by type and window; works on a stream and on a table alike."""
    counted = events.withWatermark("ts", lateness).groupBy(F.window("ts", width).alias("w"), "event_type")
    return counted.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
