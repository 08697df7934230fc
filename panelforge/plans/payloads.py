"""Queries of producer payloads and nested price reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions.canonical import canonical_json
from panelforge.operators import calendar_news, payload, prices
from panelforge.operators.acceptance import FLAGS
from panelforge.plans.catalog import Catalog
from panelforge.plans.features import bundle, bundle_sql
from panelforge.sources import views
from panelforge.sources.views import table

GENERATED = "2024-01-01T00:00:00+00:00"
#: Columns of the daily bundle by section.
_LABELS = {
    "breadth": "breadth_state", "sector_rotation": "rotation_state", "cross_asset": "cross_state", "liquidity_rates": "rates_state", "volatility": "volatility_state", "event_calendar": "event_state", "news_sentiment": "news_state",
    "earnings": "earnings_state", "fundamentals": "fundamental_state", "flows_positioning": "flow_state", "options": "option_state", "macro_liquidity": "macro_state", "market_risk": "risk_state", "market_regime": "regime_state",
}
_SCORES = {"macro_liquidity": "macro_score", "market_risk": "risk_score", "market_regime": "regime_score"}
#: Sections that a day may lack are taken as quiet, but on some days, so that payloads of all statuses arise.
_QUIET = ("event_calendar", "news_sentiment", "flows_positioning", "earnings", "fundamentals", "options", "sector_rotation", "cross_asset", "liquidity_rates", "volatility")


def producer_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = bundle(spark, sf_dir)
    day = F.dayofmonth("observation_date")
    label = lambda s: F.when(day % 4 != 0, F.coalesce(_LABELS[s], F.lit("QUIET"))).otherwise(F.col(_LABELS[s])) if s in _QUIET else F.col(_LABELS[s])
    parts = payload.sections({s: label(s) for s in _LABELS}, {s: F.col(c) for s, c in _SCORES.items()})
    flags = F.struct(*[(day % (11 + 2 * i) != 1).alias(f) for i, f in enumerate(FLAGS)])
    warnings = F.when(day % 5 == 0, F.array(F.lit('late "é" data'), F.lit("a\\b"))).when(day % 5 == 1, F.lit(None)).otherwise(F.array().cast("array<string>"))
    out = payload.producer_payload(days.select("observation_date", parts.alias("bundle"), flags.alias("safety_flags"), warnings.alias("warnings")), GENERATED)
    return out.select("observation_date", "validation_status", "certification_status", F.size("validation_errors").cast("long").alias("errors"), "payload_json", "idempotency_key")


def _object(pairs: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{k}': {pairs[k]}" for k in sorted(pairs)) + "}"


_NAMES = (*payload.RAW, *payload.SYNTHESIZED)
_LABEL = {s: f"CASE WHEN d % 4 <> 0 THEN coalesce({c}, 'QUIET') ELSE {c} END" if s in _QUIET else c for s, c in _LABELS.items()}
_FILLED = {s: f"coalesce(trim({_LABEL[s]}), '') <> ''" for s in _NAMES}
PAYLOADS_SQL = f"""
WITH days AS (SELECT *, day(observation_date) AS d FROM ({bundle_sql()})),
told AS (
    SELECT *, list_filter([{', '.join(f"CASE WHEN NOT {_FILLED[s]} THEN {{'field_name': '{s}', 'message': 'section has no label'}} END" for s in _NAMES)}], lambda x: x IS NOT NULL) AS errors,
        CASE d % 5 WHEN 0 THEN ['late "é" data', 'a\\b'] WHEN 1 THEN NULL ELSE CAST([] AS VARCHAR[]) END AS warnings
    FROM days
),
judged AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'FAIL' WHEN coalesce(len(warnings), 0) > 0 THEN 'WARN' ELSE 'PASS' END AS v FROM told),
certified AS (SELECT *, CASE WHEN v = 'PASS' AND d % 11 <> 1 AND d % 13 <> 1 AND d % 15 <> 1 AND d % 17 <> 1 THEN 'CERTIFIED' ELSE 'UNCERTIFIED' END AS c FROM judged),
texts AS (SELECT observation_date, v AS validation_status, c AS certification_status, len(errors) AS errors, CAST(to_json({_object({
    'observation_date': 'CAST(observation_date AS VARCHAR)', 'generated_at': f"'{GENERATED}'", 'universe': "'SPY'", 'schema_version': "'market_feature_bundle.v1'", 'dataset_version': "'fixture.v1'", 'source_repo': "'panelforge'",
    'full_bundle_payload': _object({s: _object({'label': _LABEL[s]} | ({'composite_score': _SCORES[s]} if s in _SCORES else {})) for s in _NAMES}),
    'raw_sections': f"list_filter([{', '.join(f'CASE WHEN {_FILLED[s]} THEN {s!r} END' for s in payload.RAW)}], lambda x: x IS NOT NULL)",
    'synthesized_sections': f"list_filter([{', '.join(f'CASE WHEN {_FILLED[s]} THEN {s!r} END' for s in payload.SYNTHESIZED)}], lambda x: x IS NOT NULL)",
    'section_record_counts': _object({s: f'CASE WHEN {_FILLED[s]} THEN 1 ELSE 0 END' for s in _NAMES}), 'section_labels': _object({s: _LABEL[s] for s in _NAMES}),
    'validation_status': 'v', 'validation_errors': 'errors', 'validation_warnings': 'warnings', 'total_warnings': 'coalesce(len(warnings), 0)', 'certification_status': 'c',
    'safety_flags': _object({f: f'd % {11 + 2 * i} <> 1' for i, f in enumerate(FLAGS)}),
})}) AS VARCHAR) AS payload_json FROM certified)
SELECT *, sha256(payload_json) AS idempotency_key FROM texts
"""


def price_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last report of each symbol as canonical JSON, scores to six places."""
    panel = views.BARS.then(prices.PANEL).apply(table(spark, sf_dir, "lineitem"))
    # rows of a symbol lie together in the panel, so that its last day is told without a join
    last = F.max("trade_date").over(Window.partitionBy("symbol"))
    panel = panel.withColumn("_last", last).where("trade_date <=> _last").drop("_last")
    doubles = [f.name for f in panel.schema if f.dataType.typeName() == "double"]
    panel = panel.withColumns({c: F.floor(F.col(c) * 10000 + 0.5) / 10000.0 for c in doubles})
    report = payload.price_report(panel)
    rows = report.select("symbol", "observation_date", F.struct(*report.columns).alias("report"))
    return rows.select("symbol", "observation_date", canonical_json(rows, "report").alias("report_json"))


_PANEL_SQL = views.BARS.then(prices.PANEL).sql("lineitem")
_four = lambda c: f"floor({c} * 10000 + 0.5) / 10000.0"
REPORTS_SQL = f"""
WITH panel AS (SELECT * FROM {_PANEL_SQL}),
last AS (SELECT * FROM panel QUALIFY trade_date = max(trade_date) OVER (PARTITION BY symbol))
SELECT symbol, trade_date AS observation_date, CAST(to_json({_object({
    'symbol': 'symbol', 'observation_date': 'CAST(trade_date AS VARCHAR)', 'latest_close': _four('close'), 'price_trend_state': 'trend_state',
    'returns': _object({c: _four(c) for c in ('return_1d', 'return_5d', 'return_20d', 'return_60d', 'return_252d')}),
    'moving_average_context': _object({c: _four(c) for c in ('ma_20', 'ma_50', 'ma_100', 'ma_200', 'distance_ma_20', 'distance_ma_50')} | {f'above_ma_{n}': f'above_ma_{n}' for n in (20, 50, 100, 200)}),
    'drawdown_context': _object({c: _four(c) for c in ('drawdown_20d', 'drawdown_60d')}), 'range_context': _object({c: _four(c) for c in ('range_20d', 'range_60d')}), 'volatility_context': _object({c: _four(c) for c in ('volatility_20d', 'volatility_60d')}),
    'liquidity_context': _object({c: _four(c) for c in ('atr_14', 'dollar_volume', 'adv_20', 'relative_volume_20', 'liquidity_score')}),
    'no_db_writes': 'true', 'no_vendor_calls': 'true', 'no_scheduler_activation': 'true',
})}) AS VARCHAR) AS report_json FROM last
"""


_EVENT_FIELDS, _NEWS_FIELDS = ["event_id", "event_date", "event_type", "impact"], ["article_id", "source", "symbol", "kind", "bucket", "sentiment_score"]
_RANK = "CASE impact WHEN 'EXTREME' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END"


def event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ahead of each day, the soonest and gravest first, in parts of 50."""
    rows = views.CALENDAR.then(calendar_news.EVENT_WINDOWS).apply(table(spark, sf_dir, "orders")).withColumn("rank", F.expr(_RANK))
    out = payload.reports_in_parts(rows, "observation_date", ["event_date", "rank", "event_id"], _EVENT_FIELDS, "events", 50)
    return out.withColumn("events", canonical_json(out, "events"))


def news_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles behind each day, the latest first, in parts of 20."""
    rows = views.ARTICLES.then(calendar_news.NEWS_WINDOWS).apply(table(spark, sf_dir, "documents")).withColumn("latest", -F.unix_micros("published_at"))
    out = payload.reports_in_parts(rows, "observation_date", ["latest", "article_id"], _NEWS_FIELDS, "articles", 20)
    return out.withColumn("articles", canonical_json(out, "articles"))


def _parts_sql(source: str, order: str, fields: list[str], name: str, most: int) -> str:
    values = {f: f"CAST({f} AS VARCHAR)" if f == "event_date" else f for f in fields}
    return f"""
WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY observation_date ORDER BY {order}) - 1 AS place, count(*) OVER (PARTITION BY observation_date) AS n FROM {source})
SELECT observation_date, place // {most} AS part, (max(n) + {most - 1}) // {most} AS parts, max(n) AS n, CAST(to_json(list({_object(values)} ORDER BY place)) AS VARCHAR) AS {name} FROM numbered GROUP BY observation_date, place // {most}
"""


def register(c: Catalog) -> None:
    c.plan("event_reports", event_reports, _parts_sql(views.CALENDAR.then(calendar_news.EVENT_WINDOWS).sql("orders"), f"event_date, {_RANK}, event_id", _EVENT_FIELDS, "events", 50))
    c.plan("news_reports", news_reports, _parts_sql(views.ARTICLES.then(calendar_news.NEWS_WINDOWS).sql("documents"), "published_at DESC, article_id", _NEWS_FIELDS, "articles", 20))
    c.plan("producer_payloads", producer_payloads, PAYLOADS_SQL)
    c.plan("price_reports", price_reports, REPORTS_SQL)
