"""A stateful stream: raw bars of a folder, checked, each key once across batches and restarts, late rows counted.

State is kept for the keys of the last ``lateness`` of event time, so it does not grow with the history; rows that come
later than that are dropped and counted. Keys live in RocksDB, outside the heap. Good and bad rows are two queries with
checkpoints of their own, as rows without a date have no event time.

Defined cases: equal keys within a batch or across batches, also over a restart, pass once; a stopped query goes on
behind its last committed batch; a folder without new files adds nothing and counts no late rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import normalize
from panelforge.streaming.ingest import RAW

KEY = ["symbol", "trade_date", "adjusted"]
BARS = "symbol string, trade_date date, adjusted boolean, open double, high double, low double, close double, volume double, event_time timestamp"
REJECTED = "ticker string, date string, reasons string"
STORE = "spark.sql.streaming.stateStore.providerClass"


def checked(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    raw = spark.readStream.schema(RAW).option("header", True).option("maxFilesPerTrigger", files_a_batch).csv(folder)
    return normalize.STOCK_DAY.apply(raw)


def first_of_keys(rows: DataFrame, lateness: str) -> DataFrame:
    """Good rows, each key's first within the watermark."""
    good = rows.where("accepted").select(F.upper("symbol").alias("symbol"), "trade_date", F.col("is_adjusted").alias("adjusted"), *[F.col(f"{p}_value").alias(p) for p in normalize.PRICES], F.col("volume_value").alias("volume"), F.col("trade_date").cast("timestamp").alias("event_time"))
    return good.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(KEY)


def drain(spark: SparkSession, folder: str, bars: str, bad: str, checkpoint: str, lateness: str = "30 days") -> int:
    """Take what is new in ``folder`` and stop; how many rows came too late."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = checked(spark, folder)
        out = first_of_keys(rows, lateness).writeStream.format("parquet").option("path", bars).option("checkpointLocation", f"{checkpoint}/bars").trigger(availableNow=True).start()
        rest = rows.where("NOT accepted").select("ticker", "date", "reasons").writeStream.format("json").option("path", bad).option("checkpointLocation", f"{checkpoint}/rejected").trigger(availableNow=True).start()
        for query in (out, rest):
            query.awaitTermination()
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
    return sum(s["numRowsDroppedByWatermark"] for p in out.recentProgress for s in p["stateOperators"])


def accepted(spark: SparkSession, bars: str) -> DataFrame:
    return spark.read.schema(BARS).parquet(bars)


def rejected(spark: SparkSession, bad: str) -> DataFrame:
    return spark.read.schema(REJECTED).json(bad)
