"""Vendor records: aggregate bars, macro observations, money flow, news fixtures, events; and batch-level evidence."""

from __future__ import annotations

from panelforge.functions import expr as x
from panelforge.operators.calendar_news import EVENT_TYPES, IMPACTS, state_text
from panelforge.operators.handoff import REQUIRED, missing
from panelforge.plans.recipe import Recipe, listed, lookup, sha256

#: Index symbols by vendor symbol.
INDEX_SYMBOLS = {"I:VIX": "VIX", "I:VVIX": "VVIX", "I:VXN": "VXN", "I:RVX": "RVX", "VIX": "VIX", "VVIX": "VVIX", "VXN": "VXN", "RVX": "RVX"}

#: Short-key bars (ticker, t in milliseconds, o, h, l, c, v) with their errors; unknown index symbols are rejected.
AGGREGATE_BARS = (
    Recipe()
    .add(trade_date=x.day_of_seconds("t / CAST(1000 AS DOUBLE)"), symbol=lookup("upper(trim(ticker))", {k: f"'{v}'" for k, v in INDEX_SYMBOLS.items()}, "NULL"))
    .add(errors=x.reasons(missing_ticker="coalesce(trim(ticker), '') = ''", unsupported_symbol="symbol IS NULL", missing_date="trade_date IS NULL", **{f"missing_{c}": f"{c} IS NULL" for c in ("o", "h", "l", "c", "v")}))
    .pick("ticker", "symbol", "trade_date", open="o", high="h", low="l", close="c", volume="v", adjusted="true", errors="errors")
)
#: (series_id, observation_text, value_text) to observations; a point stands for a missing value.
MACRO_OBSERVATIONS = (
    Recipe()
    .add(series_key=x.symbol("series_id"), observation_date=x.safe_date("observation_text"), value=x.safe_number("nullif(trim(value_text), '.')"))
    .add(errors=x.reasons(series_required="series_key IS NULL", date_invalid="observation_date IS NULL", value_missing="value IS NULL"))
    .pick("series_key", "observation_date", "value", "errors", kept="series_key IS NOT NULL AND observation_date IS NOT NULL AND value IS NOT NULL")
)
#: Failed observations of each series, by reason and in all.
SERIES_FAILURES = MACRO_OBSERVATIONS.group(
    ["series_key"],
    n="count(*)",
    failed="count(CASE WHEN NOT kept THEN 1 END)",
    date_invalid="count(CASE WHEN observation_date IS NULL THEN 1 END)",
    value_missing="count(CASE WHEN value IS NULL THEN 1 END)",
    first_day="min(observation_date)",
    last_day="max(observation_date)",
)
#: Row value, else the batch's.
MONEY_FLOW = (
    Recipe()
    .add(vendor="coalesce(row_vendor, batch_vendor)", dataset="coalesce(row_dataset, batch_dataset)", dollar_volume="close * volume")
    .add(flow_key=sha256("vendor", "dataset", "file_sha", "trade_date", "symbol", "'1d'"))
    .pick("symbol", "trade_date", "vendor", "dataset", "dollar_volume", "flow_key")
)
#: (source, url, published_at, tickers as text) to news records.
NEWS_FIXTURES = (
    Recipe()
    .add(published=("date_format(published_at, \"yyyy-MM-dd'T'HH:mm:ss\") || '+00:00'", "strftime(published_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'"))
    .add(domain=("parse_url(url, 'HOST')", "nullif(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '')"), language="coalesce(lang_text, 'en')")
    .add(news_id=("'news-' || substr(" + sha256("source", "url", "title", "published", nul=True)[0] + ", 1, 24)", "'news-' || substr(" + sha256("source", "url", "title", "published", nul=True)[1] + ", 1, 24)"))
    .pick("news_id", "source", "domain", "language", "url")
)
EVENTS = (
    Recipe()
    .add(t=state_text("event_type"), i="upper(trim(impact))")
    .add(event_kind=lookup("t", {k: f"'{v}'" for k, v in EVENT_TYPES.items()}, "t"), impact_kind=lookup("i", {k: f"'{v}'" for k, v in IMPACTS.items()}, "i"))
    .add(errors=x.reasons(**{k: v for k, v in missing("events", ["event_id", "event_date", "event_type", "impact", "title", "source", "vendor"]).items()}, bad_impact="impact_kind NOT IN ('LOW', 'MEDIUM', 'HIGH', 'EXTREME')"))
)


def requirement_counts(kind: str, present: list[str]) -> Recipe:
    """Rows that lack each required field."""
    return Recipe().group([], rows="count(*)", **{f"lacking_{f}": f"count(CASE WHEN {e} THEN 1 END)" for f, e in zip(REQUIRED[kind], missing(kind, present).values())})


#: Per symbol: rows, failed rows, checkpoint and last day in; component states and the worst of them out.
EVIDENCE = (
    Recipe()
    .add(
        rows_rank="CASE WHEN coalesce(n, 0) = 0 THEN 2 ELSE 0 END",
        quality_rank="CASE WHEN failed IS NULL THEN 2 WHEN failed = 0 THEN 0 WHEN failed * 10 <= n * 6 THEN 1 ELSE 2 END",
        checkpoint_rank="CASE WHEN last_success IS NULL THEN 1 WHEN last_success >= last_day THEN 0 ELSE 1 END",
    )
    .add(worst="greatest(rows_rank, quality_rank, checkpoint_rank)")
    .pick("symbol", "n", "failed", "last_success", **{f"{c}_state": f"CASE {c}_rank WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' ELSE 'FAIL' END" for c in ("rows", "quality", "checkpoint")}, status="CASE worst WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARN' ELSE 'FAIL' END")
)
#: Write results: histogram and last success and failure of each writer.
ROLLUP = Recipe().add(place="row_number() OVER (PARTITION BY writer, write_status ORDER BY written_on)").group(
    ["writer"],
    n="count(*)",
    accepted="count(CASE WHEN write_status = 'WRITE_ACCEPTED' THEN 1 END)",
    conflicts="count(CASE WHEN write_status = 'CONFLICT' THEN 1 END)",
    rejected="count(CASE WHEN write_status = 'REJECTED' THEN 1 END)",
    last_success="max(CASE WHEN write_status = 'WRITE_ACCEPTED' THEN written_on END)",
    last_failure="max(CASE WHEN write_status <> 'WRITE_ACCEPTED' THEN written_on END)",
    statuses=listed("CASE WHEN place = 1 THEN write_status END", "write_status"),
)
#: Checkpoint keys from optional parts.
CHECKPOINT_KEYS = Recipe().add(checkpoint_key="concat_ws(':', vendor, dataset, symbol, timeframe)")
#: Universe members by group.
GROUPS = Recipe().add(
    kind="CASE WHEN symbol IN ('SPY', 'QQQ', 'IWM', 'DIA') THEN 'index_proxy' WHEN symbol LIKE 'XL%' THEN 'sector' WHEN symbol IN ('VIX', 'VVIX', 'VXN', 'RVX') THEN 'volatility' ELSE 'cross_asset' END"
).group(["kind"], symbols="count(DISTINCT symbol)", bars="count(*)")
