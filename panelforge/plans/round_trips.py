"""Queries of the file sources and sinks: test tables are written to a folder of their own and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.plans.catalog import Catalog
from panelforge.sources import files, views
from panelforge.sources.files import folder
from panelforge.sources.views import table


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.NAMED_BARS.apply(table(spark, sf_dir, "lineitem")).withColumn("month", F.date_format("trade_date", "yyyy-MM"))


def daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as CSV in a folder a month, each with its manifest; rows whose manifest is missing or failed are told apart."""
    path = folder(spark)
    bars = _bars(spark, sf_dir)
    bars.select("month", F.col("symbol").alias("Ticker"), F.col("trade_date").alias("date"), "close", "volume").write.partitionBy("month").option("header", True).option("compression", "gzip").csv(path)
    manifests = bars.select("month").distinct().where("month NOT LIKE '%-07'")
    manifests = manifests.select("month", F.lit("vendor").alias("vendor"), F.concat(F.lit("l-"), "month").alias("lineage_id"), F.when(F.col("month").like("%-02"), "FAIL").otherwise("PASS").alias("validation_status"))
    manifests.write.mode("append").partitionBy("month").json(path)
    read = files.read_daily_ohlcv_csv(spark, f"{path}/*/*.csv.gz", f"{path}/*/*.json")
    months = F.regexp_extract("source_file", "month=([0-9-]+)", 1)
    return read.groupBy(months.alias("month"), "vendor", "lineage_id", "validation_status").agg(F.count("*").alias("n"), F.countDistinct("ticker").alias("tickers"), F.expr("CAST(sum(CAST(volume AS DOUBLE)) AS BIGINT)").alias("volume"))


_BARS_SQL = f"(SELECT *, strftime(trade_date, '%Y-%m') AS month FROM {views.NAMED_BARS.sql('lineitem')})"
DAILY_SQL = f"""
SELECT month, CASE WHEN month NOT LIKE '%-07' THEN 'vendor' END AS vendor, CASE WHEN month NOT LIKE '%-07' THEN 'l-' || month END AS lineage_id,
       CASE WHEN month LIKE '%-02' THEN 'FAIL' WHEN month NOT LIKE '%-07' THEN 'PASS' END AS validation_status, count(*) AS n, count(DISTINCT symbol) AS tickers, CAST(sum(volume) AS BIGINT) AS volume
FROM {_BARS_SQL} GROUP BY ALL
"""


def split_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with errors go to quarantine with their record and reasons; the others are stamped."""
    path = folder(spark)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    errors = F.concat_ws(",", F.when(F.col("price") > 300000, "price_range"), F.when(F.col("o_orderstatus") == "P", "pending"))
    files.write_split(rows, errors, f"{path}/accepted", f"{path}/quarantine", vendor="v")
    good = spark.read.schema("o_orderkey long, vendor string").json(f"{path}/accepted").select("o_orderkey", F.col("vendor").alias("vendor"), F.lit("").alias("reasons"))
    bad = spark.read.schema("reasons string, record string").json(f"{path}/quarantine").select(F.get_json_object("record", "$.o_orderkey").cast("long").alias("o_orderkey"), F.lit(None).cast("string").alias("vendor"), "reasons")
    return good.unionByName(bad)


SPLIT_SQL = """
SELECT o_orderkey, CASE WHEN reasons = '' THEN 'v' END AS vendor, reasons
FROM (SELECT o_orderkey, concat_ws(',', CASE WHEN o_totalprice > 300000 THEN 'price_range' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END) AS reasons FROM orders)
"""


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response for each symbol, with its rows in a list, written as a line of JSON and unpacked."""
    path = folder(spark)
    bars = _bars(spark, sf_dir)
    row = F.struct(F.col("trade_date").cast("string").alias("day"), F.col("transactions").alias("n"))
    # a symbol's response carries one month, so that no list grows with the history
    bars.groupBy("symbol", "month").agg(F.collect_list(row).alias("results")).write.json(path)
    read = files.explode_envelope(files.read_jsonl_strict(spark, path, "symbol string, month string, results array<struct<day:string,n:long>>"))
    return read.groupBy("symbol", "month").agg(F.count("*").alias("days"), F.sum("n").alias("n"), F.max("day").alias("last_day"))


ENVELOPES_SQL = f"SELECT symbol, month, count(*) AS days, CAST(sum(transactions) AS BIGINT) AS n, CAST(max(trade_date) AS VARCHAR) AS last_day FROM {_BARS_SQL} GROUP BY ALL"


def option_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option aggregates in the fixed column order, through a CSV file."""
    path = folder(spark)
    part = table(spark, sf_dir, "part")
    names = {"ticker": "'O:' || p_partkey", "volume": "p_size", "open": "p_retailprice", "close": "p_retailprice", "high": "p_retailprice", "low": "p_retailprice", "window_start": "p_partkey", "transactions": "p_size"}
    part.selectExpr(*[f"{names[n]} AS {n}" for n in files.OPTION_HEADER]).write.option("header", True).csv(path)
    read = files.read_options_day_aggs(spark, path)
    return read.selectExpr("ticker", "CAST(volume AS BIGINT) AS volume", "CAST(window_start AS BIGINT) AS window_start")


def stock_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day aggregates whose header says symbol and window_start."""
    path = folder(spark)
    _bars(spark, sf_dir).selectExpr("symbol", "trade_date AS window_start", "close", "volume").write.option("header", True).csv(path)
    return files.read_stock_day_aggs(spark, path).groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.max("transactions").alias("transactions"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects written a line each and read with a schema that must fit."""
    path = folder(spark)
    table(spark, sf_dir, "customer").select("c_custkey", "c_name").write.json(path)
    return files.read_jsonl_strict(spark, path, "c_custkey long, c_name string")


def daily_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in one folder a month; the manifest counts what is there, and a scan reads the wanted symbols' days."""
    return files.write_daily(_bars(spark, sf_dir).drop("trade_date"), folder(spark), "month").withColumn("month", F.col("month").cast("string"))


def canonical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    _bars(spark, sf_dir).write.parquet(path)
    return files.scan_canonical(spark.read.parquet(path), ["SPY", "QQQ"], "1996-01-01", "1997-01-01").select("symbol", "trade_date", "transactions")


def register(c: Catalog) -> None:
    c.plan("daily_files", daily_files, DAILY_SQL)
    c.plan("split_write", split_write, SPLIT_SQL)
    c.plan("json_envelopes", envelopes, ENVELOPES_SQL)
    c.plan("option_files", option_files, "SELECT 'O:' || p_partkey AS ticker, CAST(p_size AS BIGINT) AS volume, CAST(p_partkey AS BIGINT) AS window_start FROM part")
    c.plan("stock_files", stock_files, f"SELECT symbol AS ticker, count(*) AS n, CAST(min(trade_date) AS VARCHAR) AS first_day, CAST(max(trade_date) AS VARCHAR) AS last_day, '' AS transactions FROM {_BARS_SQL} GROUP BY symbol")
    c.plan("json_lines", json_lines, "SELECT c_custkey, c_name FROM customer")
    c.plan("daily_folders", daily_folders, f"SELECT month, count(*) AS n, count(DISTINCT symbol) AS symbols FROM {_BARS_SQL} GROUP BY month")
    c.plan("canonical_scan", canonical_scan, f"SELECT symbol, trade_date, transactions FROM {_BARS_SQL} WHERE symbol IN ('SPY', 'QQQ') AND trade_date >= DATE '1996-01-01' AND trade_date < DATE '1997-01-01'")
