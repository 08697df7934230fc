"""Vendor-record and batch-evidence queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import coverage, quality, records, rotation
from panelforge.plans.catalog import Catalog
from panelforge.plans.ingestion import CHECKPOINTS, TYPED
from panelforge.plans.recipe import Recipe
from panelforge.sources import views
from panelforge.sources.views import table

SHORT_BARS = views.NAMED_BARS.add(n="day(trade_date)").pick(
    ticker="CASE WHEN n % 17 = 0 THEN '' WHEN n % 2 = 0 THEN 'I:' || symbol ELSE lower(symbol) END",
    t=("CASE WHEN n % 19 = 0 THEN NULL ELSE CAST(datediff(trade_date, DATE '1970-01-01') AS BIGINT) * 86400000 END", "CASE WHEN n % 19 = 0 THEN NULL ELSE CAST(date_diff('day', DATE '1970-01-01', trade_date) AS BIGINT) * 86400000 END"),
    o="open", h="high", l="CASE WHEN n % 23 = 0 THEN NULL ELSE low END", c="close", v="volume",
)
POINTS = views.SERIES_POINTS.add(n="day(observation_date)").pick(
    series_id="CASE WHEN n = 9 THEN ' ' ELSE ' ' || lower(series) END",
    observation_text="CASE WHEN n = 5 THEN 'soon' ELSE CAST(observation_date AS STRING) END",
    value_text="CASE WHEN n % 11 = 0 THEN '.' WHEN n = 7 THEN 'high' ELSE CAST(n AS STRING) || '.5' END",
)
FLOW_BARS = views.NAMED_BARS.pick("symbol", "trade_date", "close", "volume", row_vendor="CASE WHEN transactions % 3 = 0 THEN 'own' END", batch_vendor="'vendor'", row_dataset="CAST(NULL AS STRING)", batch_dataset="'day'", file_sha="'abc'")
FIXTURES = Recipe().pick(
    source="source",
    title=("split(text, '\\n')[0]", "string_split(text, chr(10))[1]"),
    published_at="CAST('2024-01-01 00:00:00' AS TIMESTAMP) + (doc_id % 40000) * INTERVAL '7' MINUTE",
    url="CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'https://news' || CAST(doc_id % 9 AS STRING) || '.example/a?b=' || CAST(doc_id AS STRING) ELSE 'http://wire.example/x/' || CAST(doc_id AS STRING) END",
    lang_text="CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END",
)
EVENT_ROWS = views.CALENDAR.pick(
    event_id="CASE WHEN CAST(event_id AS BIGINT) % 21 = 0 THEN ' ' ELSE event_id END", event_date="event_date", event_type="event_type",
    impact="CASE WHEN CAST(event_id AS BIGINT) % 25 = 0 THEN 'odd' ELSE impact END", title="'t' || event_id", source="'s'", vendor="CASE WHEN CAST(event_id AS BIGINT) % 33 = 0 THEN NULL ELSE 'v' END",
)
EVENT_OUT = ["event_id", "event_date", "event_kind", "impact_kind", "errors"]
_CHECKED = TYPED.then(quality.CHECKED).group(["symbol"], n="count(*)", failed="count(CASE WHEN NOT valid THEN 1 END)", last_day="max(trade_date)")
WRITES = Recipe().pick(writer="'w' || CAST(o_custkey % 4 AS STRING)", write_status="CASE o_orderkey % 5 WHEN 0 THEN 'CONFLICT' WHEN 1 THEN 'REJECTED' ELSE 'WRITE_ACCEPTED' END", written_on="CAST(o_orderdate AS DATE)")
_UNIVERSE = [*rotation.SECTORS, "XLZ", "SPY"]


def evidence_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = table(spark, sf_dir, "lineitem")
    return records.EVIDENCE.apply(_CHECKED.apply(bars).join(CHECKPOINTS.apply(bars), "symbol", "left"))


EVIDENCE_SQL = "SELECT * FROM " + records.EVIDENCE.sql(f"(SELECT * FROM {_CHECKED.sql('lineitem')} LEFT JOIN {CHECKPOINTS.sql('lineitem')} USING (symbol))")


def universe_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of each wanted symbol; those without any are missing."""
    have = views.NAMED_BARS.group(["symbol"], n="count(*)").apply(table(spark, sf_dir, "lineitem"))
    wanted = spark.createDataFrame([(s,) for s in _UNIVERSE], "symbol string")
    out = wanted.join(have, "symbol", "left")
    return out.select("symbol", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") > 0, "READY").otherwise("MISSING").alias("status"))


READINESS_SQL = f"""
SELECT symbol, coalesce(n, 0) AS n, CASE WHEN n > 0 THEN 'READY' ELSE 'MISSING' END AS status
FROM (SELECT unnest([{', '.join(f"'{s}'" for s in _UNIVERSE)}]) AS symbol)
LEFT JOIN {views.NAMED_BARS.group(['symbol'], n='count(*)').sql('lineitem')} USING (symbol)
"""


def rank_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of the last two months, side by side; a sector in one of them only keeps its place with a null."""
    rows = _MONTHS.apply(rotation.SECTOR_DAYS.apply(views.NAMED_BARS.apply(table(spark, sf_dir, "lineitem"))))
    now = rows.where("m % 2 = 0").select("symbol", "pair", F.col("best").alias("current_rank"))
    before = rows.where("m % 2 = 1").select("symbol", "pair", F.col("best").alias("previous_rank"))
    return now.join(before, ["symbol", "pair"], "full").withColumn("change", F.col("previous_rank") - F.col("current_rank"))


_MONTHS = Recipe().where("rank_20d IS NOT NULL").add(m="(year(trade_date) * 12 + month(trade_date))").add(pair="CAST(floor(m / CAST(2 AS DOUBLE)) AS BIGINT)").group(["symbol", "m", "pair"], best="min(rank_20d)")
_MONTH_ROWS = _MONTHS.sql(rotation.SECTOR_DAYS.sql(views.NAMED_BARS.sql("lineitem")))
RANK_SQL = f"""
WITH r AS {_MONTH_ROWS}
SELECT symbol, pair, current_rank, previous_rank, previous_rank - current_rank AS change
FROM (SELECT symbol, pair, best AS current_rank FROM r WHERE m % 2 = 0) FULL JOIN (SELECT symbol, pair, best AS previous_rank FROM r WHERE m % 2 = 1) USING (symbol, pair)
"""


def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected daily files against those that are there."""
    orders = table(spark, sf_dir, "orders")
    days = coverage.trading_days(orders, "o_orderdate").withColumn("path", F.date_format("day", "'day_aggs/'yyyy/MM/yyyy-MM-dd'.csv.gz'"))
    there = orders.select(F.date_format("o_orderdate", "'day_aggs/'yyyy/MM/yyyy-MM-dd'.csv.gz'").alias("path"), "o_orderkey")
    there = there.groupBy("path").agg(F.count("*").alias("objects"))
    return days.join(there, "path", "left").select("day", "path", F.coalesce("objects", F.lit(0)).alias("objects"), F.col("objects").isNotNull().alias("present"))


INVENTORY_SQL = f"""
WITH there AS (SELECT strftime(CAST(o_orderdate AS DATE), 'day_aggs/%Y/%m/%Y-%m-%d.csv.gz') AS path, count(*) AS objects FROM orders GROUP BY 1)
SELECT day, d.path, coalesce(objects, 0) AS objects, objects IS NOT NULL AS present
FROM (SELECT day, strftime(day, 'day_aggs/%Y/%m/%Y-%m-%d.csv.gz') AS path FROM {coverage.trading_days_sql('orders', 'o_orderdate')}) d LEFT JOIN there USING (path)
"""


def register(c: Catalog) -> None:
    c.recipe("aggregate_bars", "lineitem", SHORT_BARS, records.AGGREGATE_BARS)
    c.recipe("macro_observations", "lineitem", POINTS, records.MACRO_OBSERVATIONS)
    c.recipe("series_failures", "lineitem", POINTS, records.SERIES_FAILURES)
    c.recipe("money_flow", "lineitem", FLOW_BARS, records.MONEY_FLOW)
    c.recipe("news_fixtures", "documents", FIXTURES, records.NEWS_FIXTURES)
    c.recipe("event_records", "orders", EVENT_ROWS, records.EVENTS, columns=EVENT_OUT)
    c.recipe("event_requirements", "orders", EVENT_ROWS, records.requirement_counts("events", ["event_id", "event_date", "event_type", "impact", "title", "source", "vendor"]))
    c.recipe("writer_rollup", "orders", WRITES, records.ROLLUP)
    c.recipe("checkpoint_keys", "supplier", Recipe().pick(vendor="'v'", dataset="CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'bars' END", symbol="'S' || CAST(s_suppkey AS STRING)", timeframe="CASE WHEN s_suppkey % 2 = 0 THEN '1d' END"), records.CHECKPOINT_KEYS)
    c.recipe("universe_groups", "lineitem", views.NAMED_BARS, records.GROUPS)
    c.plan("evidence_chain", evidence_chain, EVIDENCE_SQL)
    c.plan("universe_readiness", universe_readiness, READINESS_SQL)
    c.plan("rank_changes", rank_changes, RANK_SQL)
    c.plan("object_inventory", object_inventory, INVENTORY_SQL)
