"""Queries of the vendor-row normalizers: the test tables, written out as texts some of which are broken."""

from __future__ import annotations

from panelforge.operators import vendor_rows as v
from panelforge.plans.catalog import Catalog
from panelforge.plans.recipe import Recipe
from panelforge.sources import views


def _broken(value: str, k: str, every: int, bad: str = "'n/a'") -> str:
    return f"CASE WHEN {k} % {every} = 0 THEN {bad} WHEN {k} % {every} = 1 THEN NULL WHEN {k} % {every} = 2 THEN '  ' ELSE ' ' || CAST({value} AS STRING) || ' ' END"


_EVENT_TIME = ("date_format(ts, 'yyyy-MM-dd HH:mm:ss')", "strftime(ts, '%Y-%m-%d %H:%M:%S')")
EVENT_STAMPS = Recipe().add(t=_EVENT_TIME).pick(
    stamp="CASE event_id % 8 WHEN 0 THEN t WHEN 1 THEN replace(t, ' ', 'T') || 'Z' WHEN 2 THEN t || '+02:00' WHEN 3 THEN substr(t, 1, 10) WHEN 4 THEN 'soon' WHEN 5 THEN '' WHEN 6 THEN replace(t, ' ', 'T') || '.25-05:30' ELSE substr(t, 1, 16) END"
)
BAR_TEXTS = views.BARS.add(k="CAST(substr(symbol, 2) AS BIGINT) * 5 + CAST(day(trade_date) AS BIGINT)").pick(
    ticker=_broken("symbol", "k", 47), symbol_text=_broken("symbol", "k", 31), ts_text="CASE k % 9 WHEN 0 THEN 'never' WHEN 1 THEN CAST(trade_date AS STRING) || 'T21:00:00Z' WHEN 2 THEN CAST(trade_date AS STRING) || ' 16:00:00-04:00' ELSE CAST(trade_date AS STRING) END",
    date_text=_broken("trade_date", "k", 53), tf="CASE WHEN k % 3 = 0 THEN NULL ELSE '1d' END", adjusted_text="CASE k % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN 'maybe' ELSE NULL END", adj_close_text="CASE WHEN k % 2 = 0 THEN 'x' END",
    open_text=_broken("open", "k", 29), high_text=_broken("high", "k", 37), low_text=_broken("low", "k", 41), close_text=_broken("close", "k", 43), volume_text=_broken("CAST(volume AS BIGINT)", "k", 59), vendor="' v '", quality="CASE WHEN k % 7 = 0 THEN ' ' ELSE 'pending' END",
)
FLOW_TEXTS = Recipe().pick(
    record_id="' f' || CAST(o_orderkey AS STRING)", record_type=_broken("o_orderstatus", "o_orderkey", 13), observation_date="CAST(CAST(o_orderdate AS DATE) AS STRING)", symbol=_broken("o_custkey", "o_orderkey", 17),
    asset_class="'etf '", value=_broken("o_totalprice", "o_orderkey", 11), unit="'usd'", source="''", raw_source_id="CAST(NULL AS STRING)", notes=_broken("o_orderpriority", "o_orderkey", 5),
)
BREADTH_TEXTS = Recipe().pick(
    metric_id="' m' || CAST(o_orderkey AS STRING)", metric_type="o_orderstatus", observation_date="CAST(CAST(o_orderdate AS DATE) AS STRING)", universe="' US '", symbol=_broken("o_custkey", "o_orderkey", 7),
    value=_broken("o_totalprice", "o_orderkey", 19), numerator="CAST(o_custkey AS STRING)", denominator="CASE WHEN o_orderkey % 4 = 0 THEN '1e3' ELSE '--' END", source="'s'", notes="' '",
)
CROSS_TEXTS = views.NAMED_BARS.add(k="CAST(day(trade_date) AS BIGINT)").pick(
    symbol="' ' || symbol", asset_group="CASE WHEN k = 3 THEN '' ELSE 'group' END", market_date=_broken("trade_date", "k", 10), open=_broken("open", "k", 12), high="CAST(high AS STRING)", low="CAST(low AS STRING)", close=_broken("close", "k", 14), volume="CAST(volume AS STRING)",
    source="'s'", vendor_symbol="'I:' || symbol", notes="CAST(NULL AS STRING)",
)
FILING_TEXTS = Recipe().pick(
    record_family="p_type_text", symbol="'P' || CAST(p_partkey AS STRING)", source="' s '", record_date="CASE WHEN p_partkey % 6 = 0 THEN 'Q1' ELSE '1997-0' || CAST(1 + p_partkey % 9 AS STRING) || '-15' END", period="CASE WHEN p_partkey % 5 = 0 THEN ' ' ELSE 'FY' END",
    payload="CASE p_partkey % 3 WHEN 0 THEN '{\"size\": ' || CAST(p_size AS STRING) || '}' WHEN 1 THEN '[1]' ELSE 'text' END", notes="''",
)
QUOTE_TEXTS = Recipe().pick(
    contract_symbol="'O:P' || CAST(p_partkey AS STRING)", underlying_symbol=_broken("p_partkey", "p_partkey", 9), expiration_date="' 1999-01-15'", strike="CAST(p_size AS STRING)", option_type="CASE WHEN p_partkey % 2 = 0 THEN 'call' ELSE ' ' END", bid=_broken("p_retailprice", "p_partkey", 8), ask="CAST(p_retailprice AS STRING)",
    last="'.'", volume="CAST(p_partkey AS STRING)", open_interest="CAST(NULL AS STRING)", implied_volatility="'0.' || CAST(p_size AS STRING)", source="'s'", notes="' n '",
)
VOL_TEXTS = views.NAMED_BARS.where("symbol IN ('VIX', 'VVIX', 'VXN', 'RVX', 'SPY')").add(k="CAST(day(trade_date) AS BIGINT)").pick(
    "symbol", day_text="CAST(trade_date AS STRING)", plain_symbol="CASE WHEN k % 6 = 0 THEN NULL ELSE symbol END", vendor_symbol="CASE WHEN k % 5 = 0 THEN NULL ELSE 'I:' || symbol END", raw_value="close", value="CASE WHEN k % 11 = 0 THEN NULL ELSE close END",
    kind="CASE k % 3 WHEN 0 THEN 'int' WHEN 1 THEN 'float' ELSE 'text' END", ts_text="CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(trade_date AS STRING) END", source="CASE k % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'other' ELSE 'vendor_index' END", unit="'index'",
)
_TITLE = ("split(text, '\\n')[0]", "string_split(text, chr(10))[1]")
ITEMS = Recipe().add(head=_TITLE).pick(
    id_text="CASE WHEN doc_id % 9 = 0 THEN 'own-' || CAST(doc_id AS STRING) END", guid_text="CASE WHEN doc_id % 4 = 0 THEN ' ' ELSE 'g' || CAST(doc_id AS STRING) END", title_text="head", published_text="CASE WHEN doc_id % 6 = 0 THEN 'today' ELSE '2024-02-0' || CAST(1 + doc_id % 9 AS STRING) || 'T10:00:00+01:00' END",
    link_text="'https://wire.example/' || CAST(doc_id AS STRING) || CASE doc_id % 10 WHEN 0 THEN '?Token=1' WHEN 1 THEN '/my-secret' ELSE '' END", source_name="CASE WHEN doc_id % 3 = 0 THEN NULL ELSE ' ' END", source_text="CASE WHEN doc_id % 2 = 0 THEN source END",
)
NEWS_TEXTS = Recipe().add(head=_TITLE).pick(
    news_id="' n' || CAST(doc_id AS STRING)", published_at="'2024-01-05'", source="source", publisher="' '", title="head", summary="''", url="'u'", sentiment_label="lang", raw_source_id="CAST(NULL AS STRING)", notes="''",
    sentiment_score="CASE WHEN doc_id % 3 = 0 THEN 'good' ELSE '-0.' || CAST(doc_id % 10 AS STRING) END", tickers="CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' SPY , ,QQQ' WHEN 2 THEN '' ELSE 'TLT' END",
)


def register(c: Catalog) -> None:
    c.recipe("utc_times", "events", EVENT_STAMPS, v.TIMES)
    c.recipe("first_present_keys", "events", v.PRESENT)
    c.recipe("vendor_bars", "lineitem", BAR_TEXTS, v.OHLCV)
    c.recipe("eod_bars", "lineitem", BAR_TEXTS, v.EOD)
    c.recipe("flow_rows", "orders", FLOW_TEXTS, v.FLOWS)
    c.recipe("breadth_rows", "orders", BREADTH_TEXTS, v.BREADTH)
    c.recipe("cross_asset_rows", "lineitem", CROSS_TEXTS, v.CROSS_ASSET)
    c.recipe("fundamental_rows", "part", Recipe().add(p_type_text="CASE WHEN p_partkey % 8 = 0 THEN '' ELSE 'filing' END"), FILING_TEXTS, v.FUNDAMENTALS)
    c.recipe("option_quotes", "part", QUOTE_TEXTS, v.OPTION_QUOTES)
    c.recipe("volatility_rows", "lineitem", VOL_TEXTS, v.VOL_INDEX)
    c.recipe("volatility_observations", "lineitem", VOL_TEXTS, v.VOL_OBSERVATIONS)
    c.recipe("rss_items", "documents", ITEMS, v.RSS)
    c.recipe("news_rows", "documents", NEWS_TEXTS, v.NEWS_ROWS)
    c.recipe("wanted_events", "orders", views.CALENDAR, v.only("event_type", ("cpi", " FOMC ", "opex")))
