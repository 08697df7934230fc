"""File sources and sinks: vendor CSV, JSON lines with malformed rows kept apart, envelopes, split writes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of option files in their order, and names of the lists in responses.
OPTION_HEADER = ["ticker", "volume", "open", "close", "high", "low", "window_start", "transactions"]
LISTS = ("historical_ohlcv", "rows", "data", "ohlcv", "historical", "results", "observations")


_own_dirs: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset and all runs in one process, below a temporary one that goes with it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _own_dirs:
            own = tempfile.mkdtemp(prefix="panelforge-files-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _own_dirs[context.applicationId] = "file://" + own
        base = _own_dirs[context.applicationId]
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, plain or gzip, all columns as text in lower case, with the file it came from."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.select(*[F.col(f"`{c}`").alias(c.strip().lower()) for c in df.columns], F.col("_metadata.file_path").alias("source_file"))


def read_daily_ohlcv_csv(spark: SparkSession, path: str, manifest_path: str) -> DataFrame:
    """Daily bars as text with their manifest's vendor, lineage and checksum.

    Both sides are joined on the folder: one manifest row for each folder of files."""
    folder = lambda c: F.regexp_extract(c, r"^(.*)/[^/]*$", 1)
    manifest = spark.read.option("multiLine", True).json(manifest_path)
    names = [c for c in ("vendor", "asset_class", "lineage_id", "source_file_sha256", "dataset_version", "certification_status", "validation_status") if c in manifest.columns]
    manifest = manifest.select(folder(F.col("_metadata.file_path")).alias("folder"), *names)
    return read_text_csv(spark, path).withColumn("folder", folder(F.col("source_file"))).join(manifest, "folder", "left")


def read_stock_day_aggs(spark: SparkSession, path: str) -> DataFrame:
    """Day aggregates whose headers may say ticker or symbol, date or window_start."""
    df = read_text_csv(spark, path)
    first = lambda *names: F.coalesce(*[F.nullif(F.trim(F.col(n)), F.lit("")) for n in names if n in df.columns], F.lit(None).cast("string"))
    plain = [F.col(n) if n in df.columns else F.lit("").alias(n) for n in ("open", "high", "low", "close", "volume", "transactions")]
    return df.select(first("ticker", "symbol").alias("ticker"), first("date", "window_start").alias("date"), *plain, "source_file")


def read_options_day_aggs(spark: SparkSession, path: str) -> DataFrame:
    """Option aggregates; a header in any other order fails the whole file."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in OPTION_HEADER])
    header = spark.read.option("header", True).csv(path).columns
    if [h.strip() for h in header] != OPTION_HEADER:
        raise ValueError(f"header is {header}, not {OPTION_HEADER}")
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def split_json_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows of JSON objects, and the lines that are none; blank lines are skipped."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    kept = lines.where(F.length(F.trim(F.col(column))) > 0)
    parsed = kept.withColumn("_row", F.from_json(F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    bad = F.col("_row").isNull() | F.col("_row._corrupt_record").isNotNull() | ~F.trim(F.col(column)).startswith("{")
    others = [c for c in lines.columns if c != column]
    good = parsed.where(~bad).select(*others, *[F.col(f"_row.`{f.name}`").alias(f.name) for f in schema.fields])
    return good, parsed.where(bad).select(*others, F.col(column).alias("line"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return split_json_lines(lines, schema)


def read_jsonl_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def explode_envelope(df: DataFrame, names: tuple[str, ...] = LISTS) -> DataFrame:
    """Rows of the first list that a response carries."""
    present = [F.col(n) for n in names if n in df.columns]
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.explode(F.coalesce(*present)).alias("_row")).select(*rest, "_row.*")


def scan_canonical(df: DataFrame, symbols: list[str], start: str, end: str, source: str | None = None) -> DataFrame:
    """Bars of [start, end) for some symbols; the filters reach the scan."""
    out = df.where(F.col("symbol").isin(symbols) & (F.col("trade_date") >= F.lit(start).cast("date")) & (F.col("trade_date") < F.lit(end).cast("date")))
    return out.where(F.col("source") == source) if source else out


def write_split(df: DataFrame, errors: Column, accepted: str, quarantine: str, **stamps: str) -> None:
    """Rows without errors to one folder of JSON lines, the rest with their reasons to another."""
    told = df.withColumn("reasons", errors)
    good = told.where("reasons = ''").drop("reasons")
    for name, value in stamps.items():
        good = good.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))
    good.write.mode("append").json(accepted)
    told.where("reasons <> ''").select("reasons", F.to_json(F.struct(*df.columns)).alias("record")).write.mode("append").json(quarantine)


def sample(df: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """The first rows in order, 1 to 1,000 of them."""
    return df.orderBy(*order).limit(max(1, min(1000, n)))


def write_daily(df: DataFrame, path: str, day: str = "trade_date") -> DataFrame:
    """Rows in one folder a day; returns the manifest: rows and symbols by day."""
    df.write.mode("overwrite").partitionBy(day).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.groupBy(day).agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols"))


def numbered(df: DataFrame) -> DataFrame:
    """``seq``: place of each row in its file, from the order in which an unsplit file is read."""
    return df.withColumn("_at", F.monotonically_increasing_id()).withColumn("seq", F.row_number().over(Window.partitionBy("source_file").orderBy("_at"))).drop("_at")
