"""Gates of whole batches: option day aggregates whose bad rows drop and fail their file, bar handoffs that a manifest blocks.

A batch's status is one grouping joined back to its rows by the batch's key, so that a batch of any size is nowhere gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Errors of rows that block a handoff.
BLOCKING = ("INVALID_OHLC", "NEGATIVE_VOLUME", "DUPLICATE_SYMBOL_DATE", "SCHEMA_VERSION_MISMATCH", "ASSET_CLASS_MISMATCH", "CHECKSUM_MISMATCH")


def parse_contract(df: DataFrame, column: str = "ticker") -> DataFrame:
    """``contract``: underlying, expiration, type and strike of an option symbol, or the warning for which it has none."""
    plain = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), "^O:", "")
    root, end = F.expr("substring(_plain, 1, length(_plain) - 15)"), F.expr("substring(_plain, -15, 15)")
    shaped = end.rlike("^[0-9]{6}[CP][0-9]{8}$") & (root != "")
    day = F.expr("try_to_date(concat('20', substring(_end, 1, 6)), 'yyyyMMdd')")
    out = df.withColumn("_plain", plain).withColumn("_end", end).withColumn("_day", F.when(shaped, day))
    warning = F.when(F.length("_plain") < 15, "symbol too short").when(~shaped, "symbol format not recognized").when(F.col("_day").isNull(), "symbol parse failed")
    ok = lambda c: F.when(warning.isNull(), c)
    contract = F.struct(ok(root).alias("underlying_symbol"), ok(F.col("_day")).alias("expiration_date"), ok(F.substring("_end", 7, 1)).alias("option_type"), ok((F.substring("_end", 8, 8).cast("decimal(12,0)") / 1000).cast("decimal(18,3)")).alias("strike_price"), warning.alias("warning"))
    return out.withColumn("contract", contract).drop("_plain", "_end", "_day")


def normalize_option_aggregates(rows: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (file, row_number, ticker, high, low, volume, transactions, ...) of files (file, path, sha256) to records and errors.

    Negative counts drop the row and fail its file; an odd symbol or a high below the low is a warning and the row stays."""
    error = F.when(F.coalesce("volume", F.lit(0)) < 0, "NEGATIVE_VOLUME").when(F.coalesce("transactions", F.lit(0)) < 0, "NEGATIVE_TRANSACTIONS")
    told = parse_contract(rows).withColumn("error", error)
    at = lambda text: F.concat(F.lit("row "), F.col("row_number").cast("string"), F.lit(": "), text)
    warnings = F.array_compact(F.array(F.when(F.col("contract.warning").isNotNull(), at(F.col("contract.warning"))), F.when(F.col("high") < F.col("low"), at(F.lit("high lower than low")))))
    status = told.groupBy("file").agg(F.when(F.count("error") > 0, "FAIL").otherwise("PASS").alias("normalization_status"))
    held = files.select("file", F.struct("path", "sha256").alias("_source"))
    kept = told.where("error IS NULL").withColumn("warnings", warnings).join(status, "file").join(held, "file", "left")
    lineage = F.struct(F.col("_source.path").alias("source_file_path"), F.col("_source.sha256").alias("source_file_sha256"), "row_number")
    records = kept.withColumn("lineage", lineage).withColumns({"volume": F.coalesce("volume", F.lit(0)), "transactions": F.coalesce("transactions", F.lit(0))}).drop("error", "_source")
    return records, told.where("error IS NOT NULL").select("file", "row_number", F.col("error").alias("code"))


def handoff(rows: DataFrame, manifests: DataFrame) -> DataFrame:
    """Rows (batch, symbol, trade_date, file_day, code: error or null, adjusted) with their batch's ``handoff_status`` and errors, and a key.

    Missing checksum, validation or certification, a fixture, and row errors of the list block a batch; a batch that has other errors fails."""
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    rows = rows.withColumn("code", F.coalesce("code", F.when(~F.col("trade_date").eqNullSafe(F.col("file_day")), "TRADE_DATE_MISMATCH")))
    bad = rows.groupBy("batch").agg(F.count("code").alias("row_errors"), F.count(F.when(F.col("code").isin(*BLOCKING) | F.col("code").startswith("REQUIRED_"), 1)).alias("blocking"), F.count("*").alias("n_rows"))
    gate = manifests.join(bad, "batch", "left").fillna(0, ["row_errors", "blocking", "n_rows"])
    unsound = blank("validation_status") | (F.col("validation_status") != "PASS") | (F.col("blocking") > 0)
    blocks = {"HANDOFF_BLOCKED_CHECKSUM_MISSING": blank("source_file_sha256"), "HANDOFF_BLOCKED_CERTIFICATION_MISSING": blank("certification_status"), "HANDOFF_BLOCKED_FIXTURE_ONLY": F.coalesce(F.col("certification_status") == "FIXTURE_ONLY", F.lit(False)), "HANDOFF_BLOCKED_VALIDATION_FAILED": unsound}
    gate = gate.withColumn("batch_errors", F.array_compact(F.array(*[F.when(F.coalesce(e, F.lit(True)), name) for name, e in blocks.items()])))
    gate = gate.withColumn("handoff_status", F.when(F.size("batch_errors") > 0, "BLOCKED").when(F.col("row_errors") > 0, "FAIL").otherwise("PASS"))
    adjustment = F.when(F.col("adjusted"), "adjusted").when(~F.col("adjusted"), "unadjusted").otherwise("unknown_or_vendor_default")
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    out = rows.where("code IS NULL").join(gate, "batch").withColumn("adjustment_status", adjustment)
    key = F.sha2(F.concat_ws("|", part("vendor"), part("asset_class"), F.upper(part("symbol")), part("trade_date"), part("dataset_version"), part("source_file_sha256"), "adjustment_status"), 256)
    return out.withColumn("idempotency_key", key)
