"""Producer payloads: a bundle's sections as nested rows, its status, and a key over the canonical JSON of all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.canonical import canonical_json
from panelforge.operators.acceptance import FLAGS

#: Sections in their order.
RAW = ("breadth", "sector_rotation", "cross_asset", "liquidity_rates", "volatility", "event_calendar", "news_sentiment", "earnings", "fundamentals", "flows_positioning", "options")
SYNTHESIZED = ("macro_liquidity", "market_risk", "market_regime")


def sections(labels: dict[str, Column], scores: dict[str, Column]) -> Column:
    """A struct for each section: its label, and its score where it has one."""
    parts = [F.struct(labels[s].alias("label"), *([scores[s].alias("composite_score")] if s in scores else [])).alias(s) for s in (*RAW, *SYNTHESIZED)]
    return F.struct(*parts)


def producer_payload(bundles: DataFrame, generated_at: str, universe: str = "SPY", schema_version: str = "market_feature_bundle.v1", dataset_version: str = "fixture.v1", source: str = "panelforge") -> DataFrame:
    """(observation_date, bundle, safety_flags, warnings) to payloads with ``idempotency_key``.

    A section without a label is an error. Without errors a payload passes, or is a warning if there are warnings; it is
    certified only if it passes and every safety flag is set. The key covers all fields but itself, ``generated_at`` too,
    which is therefore a parameter and not the clock."""
    names = (*RAW, *SYNTHESIZED)
    blank = lambda s: F.coalesce(F.trim(F.col(f"bundle.{s}.label")), F.lit("")) == ""
    error = lambda s: F.when(blank(s), F.struct(F.lit(s).alias("field_name"), F.lit("section has no label").alias("message")))
    out = bundles.withColumn("validation_errors", F.array_compact(F.array(*map(error, names))))
    out = out.withColumn("total_warnings", F.coalesce(F.size("warnings"), F.lit(0)))
    out = out.withColumn("validation_status", F.when(F.size("validation_errors") > 0, "FAIL").when(F.col("total_warnings") > 0, "WARN").otherwise("PASS"))
    safe = F.lit(True)
    for flag in FLAGS:
        safe = safe & F.coalesce(F.col(f"safety_flags.{flag}"), F.lit(False))
    out = out.withColumn("certification_status", F.when((F.col("validation_status") == "PASS") & safe, "CERTIFIED").otherwise("UNCERTIFIED"))
    present = lambda some: F.array_compact(F.array(*[F.when(~blank(s), F.lit(s)) for s in some]))
    counts = F.struct(*[F.when(blank(s), 0).otherwise(1).alias(s) for s in names])
    labels = F.struct(*[F.col(f"bundle.{s}.label").alias(s) for s in names])
    payload = F.struct(
        F.col("observation_date").cast("string").alias("observation_date"), F.lit(generated_at).alias("generated_at"), F.lit(universe).alias("universe"), F.lit(schema_version).alias("schema_version"), F.lit(dataset_version).alias("dataset_version"),
        F.lit(source).alias("source_repo"), F.col("bundle").alias("full_bundle_payload"), present(RAW).alias("raw_sections"), present(SYNTHESIZED).alias("synthesized_sections"), counts.alias("section_record_counts"), labels.alias("section_labels"),
        "validation_status", "validation_errors", F.col("warnings").alias("validation_warnings"), "total_warnings", "safety_flags", "certification_status",
    )
    out = out.withColumn("payload", payload)
    return out.withColumn("payload_json", canonical_json(out, "payload")).withColumn("idempotency_key", F.sha2("payload_json", 256)).drop("bundle", "warnings")


def price_report(panel: DataFrame) -> DataFrame:
    """Rows of the price panel regrouped into nested contexts."""
    group = lambda *names: F.struct(*names)
    return panel.select(
        "symbol", F.col("trade_date").alias("observation_date"), F.col("close").alias("latest_close"), F.col("trend_state").alias("price_trend_state"),
        group("return_1d", "return_5d", "return_20d", "return_60d", "return_252d").alias("returns"),
        group("ma_20", "ma_50", "ma_100", "ma_200", "distance_ma_20", "distance_ma_50", "above_ma_20", "above_ma_50", "above_ma_100", "above_ma_200").alias("moving_average_context"),
        group("drawdown_20d", "drawdown_60d").alias("drawdown_context"), group("range_20d", "range_60d").alias("range_context"), group("volatility_20d", "volatility_60d").alias("volatility_context"),
        group("atr_14", "dollar_volume", "adv_20", "relative_volume_20", "liquidity_score").alias("liquidity_context"),
        *[F.lit(True).alias(f) for f in ("no_db_writes", "no_vendor_calls", "no_scheduler_activation")],
    )


def reports_in_parts(rows: DataFrame, day: str, order: list[str], fields: list[str], name: str, most: int = 100) -> DataFrame:
    """day, part (from 0), parts, n (rows of the day), and ``name``: the day's rows in order as structs, at most ``most`` in a row.

    A day of any number of rows becomes as many parts as it needs, so that nothing is left out and no list is unbounded."""
    place = F.row_number().over(Window.partitionBy(day).orderBy(*order)) - 1
    numbered = rows.select(day, *{c: None for c in (*order, *fields)}).withColumn("_place", place)
    counts = rows.groupBy(day).agg(F.count("*").alias("n"))
    one = F.struct("_place", F.struct(*fields).alias("row"))
    parts = numbered.groupBy(day, F.floor(F.col("_place") / most).alias("part")).agg(F.array_sort(F.collect_list(one)).alias("_rows"))
    listed = F.transform("_rows", lambda r: r["row"]).alias(name)
    return parts.join(counts, day).select(day, "part", F.ceil(F.col("n") / most).alias("parts"), "n", listed)
