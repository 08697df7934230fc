"""Feature panels over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.operators import breadth, calendar_news, macro, prices, rotation, scores, synthesis
from panelforge.plans.catalog import Catalog
from panelforge.plans.recipe import Recipe, query, rounded
from panelforge.sources import views
from panelforge.sources.files import folder
from panelforge.sources.views import table


def _except(columns: list[str], *exact: str) -> tuple[str, ...]:
    return tuple(c for c in columns if c not in exact)


_PART = Recipe().pick(
    symbol="'P' || CAST(p_partkey AS STRING)",
    k="p_partkey",
    x="CAST(p_size AS DOUBLE)",
    y="p_retailprice",
)
OPTION_METRICS = _PART.pick(
    "symbol",
    iv_30d="CASE WHEN k % 11 = 0 THEN NULL ELSE (k % 97) / CAST(80 AS DOUBLE) END",
    iv_60d="CASE WHEN k % 11 < 2 THEN NULL ELSE (k % 89) / CAST(80 AS DOUBLE) END",
    rv_20d="CASE WHEN k % 13 = 0 THEN NULL ELSE (k % 83) / CAST(100 AS DOUBLE) END",
    iv_rank="x * 2",
    iv_percentile="CASE WHEN k % 5 = 0 THEN NULL ELSE x * 3 END",
    put_call_ratio="CASE WHEN k % 7 = 0 THEN NULL ELSE (k % 30) / CAST(10 AS DOUBLE) END",
    call_volume="CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(k % 41 AS DOUBLE) END",
    put_volume="CAST(k % 17 AS DOUBLE)",
    gamma_exposure="(y - 1200) * 20000",
    skew_25_delta="(k % 21 - 10) / CAST(20 AS DOUBLE)",
    term_slope="CASE WHEN k % 19 = 0 THEN NULL ELSE (k % 15 - 7) / CAST(10 AS DOUBLE) END",
)
EARNINGS_ROWS = _PART.pick(
    "symbol",
    as_of="DATE '1998-06-15'",
    earnings_date=("date_add(DATE '1998-06-15', CAST(k % 61 - 30 AS INT))", "DATE '1998-06-15' + CAST(k % 61 - 30 AS INTEGER)"),
    eps_actual="CASE WHEN k % 9 = 0 THEN NULL ELSE (k % 37 - 10) / CAST(10 AS DOUBLE) END",
    eps_estimate="(k % 31 - 8) / CAST(10 AS DOUBLE)",
    revenue_actual="y",
    revenue_estimate="CASE WHEN k % 8 = 0 THEN NULL ELSE y + (k % 50 - 25) * 10 END",
    guidance="CASE k % 6 WHEN 0 THEN 'Raise' WHEN 1 THEN ' lowered ' WHEN 2 THEN 'reaffirm' WHEN 3 THEN 'odd' WHEN 4 THEN NULL ELSE 'withdrew' END",
    revision="CASE k % 5 WHEN 0 THEN 'up' WHEN 1 THEN 'Deteriorating' WHEN 2 THEN NULL WHEN 3 THEN 'flat' ELSE 'improving' END",
    pre_change_5d="(k % 23 - 11) / CAST(2 AS DOUBLE)",
    post_change_1d="CASE WHEN k % 4 = 0 THEN NULL ELSE (k % 19 - 9) / CAST(2 AS DOUBLE) END",
    post_change_5d="CASE WHEN k % 4 < 2 THEN NULL ELSE (k % 29 - 14) / CAST(1 AS DOUBLE) END",
    implied_move="CAST(k % 6 AS DOUBLE)",
    actual_move="(k % 13 - 6) / CAST(1 AS DOUBLE)",
)
FUNDAMENTAL_ROWS = _PART.pick(
    "symbol",
    **{
        n: f"CASE WHEN k % {13 + i} = 0 THEN NULL ELSE (k % {101 + 2 * i} - {30 + i}) / CAST({d} AS DOUBLE) END"
        for i, (n, d) in enumerate(
            {"revenue_growth": 60, "eps_growth": 50, "gross_margin": 90, "operating_margin": 90, "net_margin": 100, "roe": 80, "debt_to_equity": 20, "current_ratio": 25, "pe": 2, "forward_pe": 2, "price_to_sales": 9, "price_to_fcf": 3, "free_cash_flow": 0.000000001, "fcf_margin": 120}.items()
        )
    },
)
FLOW_ROWS = Recipe().pick(
    flow_date="CAST(o_orderdate AS DATE)",
    symbol="CASE o_orderkey % 7 WHEN 0 THEN 'XLP' WHEN 1 THEN 'XLU' WHEN 2 THEN 'HYG' WHEN 3 THEN 'XLV' ELSE 'SPY' END",
    flow_1d="CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE (o_totalprice - 200000) * 300 END",
    flow_5d="(o_orderkey % 41 - 20) * CAST(2000000 AS DOUBLE)",
    flow_20d="CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_orderkey % 53 - 26) * CAST(3000000 AS DOUBLE) END",
    aum="CASE WHEN o_orderkey % 15 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice * 100000000000 END",
    put_call="(o_orderkey % 25) / CAST(10 AS DOUBLE)",
    equity_put_call="CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 23) / CAST(10 AS DOUBLE) END",
    index_put_call="(o_orderkey % 27) / CAST(10 AS DOUBLE)",
    net_percentile="(o_orderkey % 101) / CAST(100 AS DOUBLE)",
    short_pct="(o_orderkey % 33) / CAST(100 AS DOUBLE)",
    days_to_cover="(o_orderkey % 14) / CAST(1 AS DOUBLE)",
    gross_exposure="(o_orderkey % 20) / CAST(10 AS DOUBLE)",
    net_exposure="(o_orderkey % 11) / CAST(10 AS DOUBLE)",
    cash_level="CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_orderkey % 10) / CAST(20 AS DOUBLE) END",
)


#: Bars with holes: closes, volumes and highs that are missing, closes of zero.
GAPPY = views.BARS.add(n="CAST(day(trade_date) AS BIGINT) + transactions").pick(
    "symbol", "trade_date", open="open", low="low",
    high="CASE WHEN n % 5 = 0 THEN NULL ELSE high END", close="CASE WHEN n % 11 = 0 THEN NULL WHEN n % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE close END", volume="CASE WHEN n % 7 = 0 THEN NULL ELSE CAST(volume AS DOUBLE) END",
)
GAP_COLUMNS = ["symbol", "trade_date", "true_range", "atr_14", "adv_20", "relative_volume_20", "volatility_20d", "volatility_60d"]
#: The same windows written by hand over lists of the values that exist; no value looks back further than 150 rows.
GAPPY_SQL = f"""
WITH priced AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS before FROM {GAPPY.sql('lineitem')} WHERE close IS NOT NULL),
valued AS (SELECT symbol, trade_date, volume, close * volume AS traded, (close - before) / nullif(before, 0) AS gain,
                  CASE WHEN high IS NULL OR low IS NULL THEN NULL WHEN before IS NULL THEN high - low ELSE greatest(high - low, abs(high - before), abs(low - before)) END AS spread FROM priced),
lists AS (SELECT *, list(gain) FILTER (WHERE gain IS NOT NULL) OVER w AS gains, list(spread) FILTER (WHERE spread IS NOT NULL) OVER w AS spreads,
                 list(volume) FILTER (WHERE volume IS NOT NULL) OVER w AS volumes, list(traded) FILTER (WHERE traded IS NOT NULL) OVER w AS trades
          FROM valued WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 150 PRECEDING AND CURRENT ROW)),
windows AS (SELECT symbol, trade_date, spread AS true_range, CASE WHEN len(spreads) >= 14 THEN list_avg(spreads[-14:]) END AS atr_14, CASE WHEN len(trades) >= 20 THEN list_avg(trades[-20:]) END AS adv_20,
                   volume / nullif(CASE WHEN len(volumes) >= 20 THEN list_avg(volumes[-20:]) END, 0) AS relative_volume_20,
                   CASE WHEN len(gains) >= 20 THEN list_aggregate(gains[-20:], 'stddev_pop') * sqrt(252) END AS volatility_20d, CASE WHEN len(gains) >= 60 THEN list_aggregate(gains[-60:], 'stddev_pop') * sqrt(252) END AS volatility_60d FROM lists)
SELECT symbol, trade_date, {', '.join(f'{rounded(x)} AS {x}' for x in GAP_COLUMNS[2:])} FROM windows
"""
#: Leaders and laggards by hand: the three best and worst 20-day strengths, ties by symbol.
_STRENGTH = "SELECT s.symbol, s.trade_date, s.r20 - b.r20 AS rs FROM r s JOIN r b ON b.trade_date = s.trade_date AND b.symbol = 'SPY' WHERE s.symbol <> 'SPY' AND s.symbol IN (" + ", ".join(f"'{n}'" for n in rotation.SECTORS) + ")"
ENDS_SQL = f"""
WITH n AS (SELECT symbol, trade_date, close, lag(close, 20) OVER (PARTITION BY symbol ORDER BY trade_date) AS past FROM {views.NAMED_BARS.sql('lineitem')}),
r AS (SELECT symbol, trade_date, CASE WHEN close > 0 AND past > 0 THEN close / past - 1 END AS r20 FROM n), s AS ({_STRENGTH})
SELECT trade_date, coalesce(array_to_string((list(symbol ORDER BY rs DESC, symbol) FILTER (WHERE rs IS NOT NULL))[:3], ','), '') AS top_symbols,
       coalesce(array_to_string((list(symbol ORDER BY rs, symbol) FILTER (WHERE rs IS NOT NULL))[:3], ','), '') AS bottom_symbols FROM s GROUP BY trade_date
"""


def register(c: Catalog) -> None:
    c.recipe("price_windows_with_gaps", "lineitem", GAPPY, prices.PANEL, columns=GAP_COLUMNS, doubles=tuple(GAP_COLUMNS[2:]))
    c.sql["price_windows_with_gaps"] = GAPPY_SQL
    c.recipe("rotation_ends", "lineitem", views.NAMED_BARS, rotation.DAILY, columns=["trade_date", "top_symbols", "bottom_symbols"])
    c.sql["rotation_ends"] = ENDS_SQL
    flags = [f"above_ma_{n}" for n in prices.AVERAGES]
    c.recipe("price_panel", "lineitem", views.BARS, prices.PANEL, columns=prices.COLUMNS, doubles=_except(prices.COLUMNS, "symbol", "trade_date", "trend_state", *flags))
    c.recipe("price_trend_histogram", "lineitem", views.BARS, prices.TREND_HISTOGRAM)
    counts = ("trade_date", "advancers", "decliners", "unchanged", "observed", "new_highs", "new_lows", "ad_line", "participation_label")
    c.recipe("breadth_daily", "lineitem", views.BARS, breadth.BREADTH, columns=breadth.COLUMNS, doubles=_except(breadth.COLUMNS, *counts))
    exact = ("symbol", "trade_date", "rank_5d", "rank_20d", "rank_60d", "rank_change_5d", "rank_change_20d", "leader", "deteriorating")
    c.recipe("rotation_sectors", "lineitem", views.NAMED_BARS, rotation.SECTOR_DAYS, columns=rotation.SECTOR_COLUMNS, doubles=_except(rotation.SECTOR_COLUMNS, *exact))
    exact = ("trade_date", "sectors", "scored", "broad", "narrow", "improving", "any_deteriorating", "top_symbols", "bottom_symbols", "leaders", "rotation_state")
    c.recipe("rotation_daily", "lineitem", views.NAMED_BARS, rotation.DAILY, columns=rotation.DAILY_COLUMNS, doubles=_except(rotation.DAILY_COLUMNS, *exact))
    c.recipe("cross_asset_daily", "lineitem", views.NAMED_BARS, macro.CROSS_ASSET, columns=macro.CROSS_ASSET_COLUMNS, doubles=_except(macro.CROSS_ASSET_COLUMNS, "trade_date", "risk_on", "risk_off", "divergence", "intermarket_state"))
    c.recipe("liquidity_rates_daily", "lineitem", views.SERIES_POINTS, macro.RATES, columns=macro.RATES_COLUMNS, doubles=_except(macro.RATES_COLUMNS, "observation_date", "liquidity_regime"))
    c.recipe("volatility_daily", "lineitem", views.NAMED_BARS, macro.VOLATILITY, columns=macro.VOLATILITY_COLUMNS, doubles=_except(macro.VOLATILITY_COLUMNS, "trade_date", "volatility_regime"))
    for name, source, rows, recipe, columns, exact in (
        ("options_scores", "part", OPTION_METRICS, scores.OPTIONS, scores.OPTIONS_COLUMNS, ("symbol", "options_regime")),
        ("earnings_scores", "part", EARNINGS_ROWS, scores.EARNINGS, scores.EARNINGS_COLUMNS, ("symbol", "days_to", "earnings_regime")),
        ("fundamental_scores", "part", FUNDAMENTAL_ROWS, scores.FUNDAMENTALS, scores.FUNDAMENTALS_COLUMNS, ("symbol", "fundamental_label")),
        ("flows_daily", "orders", FLOW_ROWS, scores.FLOWS, scores.FLOWS_COLUMNS, ("flow_date", "flow_regime")),
        ("news_daily", "documents", views.ARTICLES, calendar_news.NEWS_DAYS, calendar_news.NEWS_COLUMNS, _except(calendar_news.NEWS_COLUMNS, "avg_sentiment", "avg_relevance", "avg_impact", "weighted", "pressure")),
        ("event_days", "orders", views.CALENDAR, calendar_news.EVENT_DAYS, calendar_news.EVENT_COLUMNS, _except(calendar_news.EVENT_COLUMNS, "event_risk_score")),
    ):
        c.recipe(name, source, rows, recipe, columns=columns, doubles=_except(columns, *exact))
    c.recipe("news_top_symbols", "documents", views.ARTICLES, calendar_news.TOP_SYMBOLS)
    c.recipe("news_kinds", "documents", views.ARTICLES, calendar_news.KIND_HISTOGRAM)
    c.recipe("opex_calendar", "orders", Recipe().pick(day="CAST(o_orderdate AS DATE)"), calendar_news.OPEX_DAYS)
    c.plan("market_bundle", bundle, bundle_sql())


#: Panels that give a day's states: table (or the named symbols' bars), recipe, day column, state columns by their name in the bundle.
_SECTIONS = [
    ("named bars", breadth.BREADTH, "trade_date", {"breadth_state": "participation_label"}),
    ("named bars", rotation.DAILY, "trade_date", {"rotation_state": "rotation_state"}),
    ("named bars", macro.CROSS_ASSET, "trade_date", {"cross_state": "intermarket_state"}),
    ("lineitem", views.SERIES_POINTS.then(macro.RATES), "observation_date", {"rates_state": "liquidity_regime"}),
    ("named bars", macro.VOLATILITY, "trade_date", {"volatility_state": "volatility_regime"}),
    ("orders", views.CALENDAR.then(calendar_news.EVENT_DAYS), "observation_date", {"event_state": "event_risk"}),
    ("orders", FLOW_ROWS.then(scores.FLOWS), "flow_date", {"flow_state": "flow_regime"}),
    ("documents", views.ARTICLES.then(calendar_news.NEWS_DAYS), "observation_date", {"news_state": "sentiment_regime"}),
    ("named bars", prices.PANEL.group(["trade_date"], trend=(f"bround(avg({synthesis.trend_score('trend_state')}), 3)", f"round_even(avg({synthesis.trend_score('trend_state')}), 3)")), "trade_date", {"price_trend_score": "trend"}),
]
#: Panels by symbol; a symbol reports on one day, and the day's most frequent label, of equals the first, stands for its section.
_REPORTED = ("date_add(DATE '1995-01-02', CAST(CAST(substr(symbol, 2) AS BIGINT) % 2500 AS INT))", "DATE '1995-01-02' + CAST(CAST(substr(symbol, 2) AS BIGINT) % 2500 AS INTEGER)")
_SECTIONS += [
    ("part", recipe.add(report_day=_REPORTED).group(["report_day", label], n="count(*)").group(["report_day"], **{name: f"substr(min(lpad(CAST(1000000000000 - n AS STRING), 13, '0') || {label}), 14)"}), "report_day", {name: name})
    for recipe, label, name in (
        (OPTION_METRICS.then(scores.OPTIONS), "options_regime", "option_state"),
        (EARNINGS_ROWS.then(scores.EARNINGS), "earnings_regime", "earnings_state"),
        (FUNDAMENTAL_ROWS.then(scores.FUNDAMENTALS), "fundamental_label", "fundamental_state"),
    )
]


def _section(recipe: Recipe, day: str, states: dict[str, str]) -> Recipe:
    return recipe.pick(observation_date=day, **states)


def bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each day of the breadth panel, all sections joined to it by day."""
    # five sections share the bars, which are a row for each named symbol and day however large the table
    path = folder(spark)
    views.NAMED_BARS.apply(table(spark, sf_dir, "lineitem")).write.parquet(path)
    bars, whole = spark.read.parquet(path), None
    for source, recipe, day, states in _SECTIONS:
        part = _section(recipe, day, states).apply(bars if source == "named bars" else table(spark, sf_dir, source))
        whole = part if whole is None else whole.join(part, "observation_date", "left")
    return synthesis.SYNTHESIS.pick(*synthesis.COLUMNS).apply(whole)


def bundle_sql() -> str:
    parts = [_section(r, d, s).sql(views.NAMED_BARS.sql("lineitem") if t == "named bars" else t) for t, r, d, s in _SECTIONS]
    joined = f"{parts[0]} t0" + "".join(f" LEFT JOIN {p} t{i} USING (observation_date)" for i, p in enumerate(parts[1:], 1))
    return query(synthesis.SYNTHESIS.pick(*synthesis.COLUMNS).sql(f"(SELECT * FROM {joined})"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols by trend state for each day."""
    return views.BARS.then(prices.TREND_HISTOGRAM).apply(table(spark, sf_dir, "lineitem"))
