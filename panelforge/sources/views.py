"""Domain views over the star-schema test tables, as recipes both engines can run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.plans.recipe import Recipe, rounded

#: Names of the panel's universe, by key modulo their number.
NAMES = (
    "SPY QQQ IWM DIA XLB XLC XLE XLF XLI XLK XLP XLRE XLU XLV XLY HYG TLT GLD USO DXY VIX VVIX VXN RVX".split()
)
#: Macro series.
SERIES = "FED_FUNDS US10Y US2Y REAL_YIELD_10Y DXY HYG SPY M2 QT_QE_PROXY".split()


def _name(key: str, names: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {key} % {len(names)} = {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def _ends(key: str) -> dict:
    return {
        "open": (f"min_by(px, {key})", f"arg_min(px, {key})"),
        "close": (f"max_by(px, {key})", f"arg_max(px, {key})"),
    }


#: Lines of a day in order as one number, so that first and last come from a hash aggregation; prices settle the order of equal keys.
_ORDER = "CAST(l_orderkey AS DECIMAL(19, 0)) * CAST(1000000000000000 AS DECIMAL(16, 0)) + CAST(l_linenumber AS DECIMAL(5, 0)) * CAST(10000000000 AS DECIMAL(11, 0)) + CAST(floor(px * 100) AS DECIMAL(10, 0))"
_PX = Recipe().add(trade_date="CAST(l_shipdate AS DATE)", px="l_extendedprice / l_quantity").add(line_key=_ORDER)
_OF_A_DAY = Recipe().group(["symbol", "trade_date"], **_ends("line_key"), high="max(px)", low="min(px)", volume="sum(l_quantity)", transactions="count(*)")


def _bars(symbol: str) -> Recipe:
    return _PX.add(symbol=symbol).then(_OF_A_DAY)


_SYMBOL = "concat('S', CAST(l_suppkey AS STRING))"
#: A supplier rarely ships two lines a day, so that a part of a group is wider than its lines: these meet, by symbol, before they are grouped.
_GATHERED = Recipe().add(symbol=_SYMBOL, trade_date="CAST(l_shipdate AS DATE)").gathered("symbol").add(px="l_extendedprice / l_quantity").add(line_key=_ORDER).then(_OF_A_DAY)
BARS = Recipe().either(_GATHERED, _bars(_SYMBOL))
NAMED_BARS = _bars(_name("l_partkey", NAMES))
SERIES_POINTS = (
    Recipe()
    .add(series=_name("l_partkey", SERIES), observation_date="CAST(l_shipdate AS DATE)")
    .group(["series", "observation_date"], value=rounded("avg(l_discount) * 100"))
)
CALENDAR = Recipe().pick(
    event_id="CAST(o_orderkey AS STRING)",
    event_date="CAST(o_orderdate AS DATE)",
    event_type="CASE o_orderkey % 13 WHEN 0 THEN 'fomc' WHEN 1 THEN 'CPI' WHEN 2 THEN 'ppi' WHEN 3 THEN 'nfp' WHEN 4 THEN 'GDP' WHEN 5 THEN 'auction' WHEN 6 THEN 'OPEX' WHEN 7 THEN 'half-day' WHEN 8 THEN 'pce' ELSE 'EARNINGS' END",
    impact="CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'critical' WHEN '2' THEN 'High' WHEN '3' THEN 'med' WHEN '4' THEN 'LOW' ELSE 'extreme' END",
)
ARTICLES = Recipe().pick(
    article_id="CAST(doc_id AS STRING)",
    published_at="CAST('2024-01-01 00:00:00' AS TIMESTAMP) + (doc_id % 40000) * INTERVAL '7' MINUTE",
    source="source",
    category="CASE doc_id % 7 WHEN 0 THEN 'macro' WHEN 1 THEN 'Fed' WHEN 2 THEN 'earnings' WHEN 3 THEN 'company' WHEN 4 THEN 'geopolitical' ELSE 'other' END",
    symbol="CASE doc_id % 5 WHEN 0 THEN 'SPY' WHEN 1 THEN 'QQQ' WHEN 2 THEN 'XLK' WHEN 3 THEN 'XLF' ELSE 'TLT' END",
    sentiment_score="CASE WHEN doc_id % 11 = 0 THEN NULL ELSE ((doc_id * 37) % 201 - 100) / CAST(100 AS DOUBLE) END",
    relevance_score="CASE WHEN doc_id % 13 = 0 THEN NULL ELSE ((doc_id * 53) % 101) / CAST(100 AS DOUBLE) END",
    impact_score="CASE WHEN doc_id % 17 = 0 THEN NULL ELSE ((doc_id * 71) % 101) / CAST(100 AS DOUBLE) END",
)
#: Bars as text, some of them broken, some twice.
RAW_BARS = (
    BARS.add(k="CAST(substr(symbol, 2) AS BIGINT) * 7 + CAST(day(trade_date) AS BIGINT) * 3 + CAST(month(trade_date) AS BIGINT)")
    .pick(
        "k",
        ticker="CASE WHEN k % 41 = 0 THEN '  ' WHEN k % 2 = 0 THEN lower(symbol) ELSE ' ' || symbol END",
        date="CASE WHEN k % 37 = 0 THEN 'n/a' ELSE CAST(trade_date AS STRING) END",
        open="CASE WHEN k % 31 = 0 THEN '' ELSE CAST(open AS STRING) END",
        high="CAST(CASE WHEN k % 29 = 0 THEN low - 1 ELSE high END AS STRING)",
        low="CAST(low AS STRING)",
        close="CASE WHEN k % 43 = 0 THEN 'x' ELSE CAST(close AS STRING) END",
        volume="CASE WHEN k % 23 = 0 THEN '-5' ELSE CAST(CAST(volume AS BIGINT) AS STRING) END",
        transactions="CASE WHEN k % 19 = 0 THEN '' ELSE CAST(transactions AS STRING) END",
        adjusted="CASE k % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'false' WHEN 2 THEN 'maybe' ELSE '1' END",
    )
)
REFERENCE_TICKERS = Recipe().pick(
    ticker="'C' || CAST(c_custkey AS STRING)",
    name="CASE WHEN c_custkey % 9 = 0 THEN ' ' ELSE c_name END",
    active="CASE c_custkey % 5 WHEN 0 THEN NULL ELSE c_acctbal >= 0 END",
    delisted="c_custkey % 7 = 0",
    exchange="CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'X' || CAST(c_nationkey AS STRING) END",
    type="CASE c_mktsegment WHEN 'BUILDING' THEN 'CS' WHEN 'MACHINERY' THEN 'ETF' WHEN 'HOUSEHOLD' THEN 'INDEX' ELSE 'ADRC' END",
    currency="CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'usd' END",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
