"""Ingestion, quality, coverage and load queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import coverage, normalize, quality, upsert
from panelforge.plans.catalog import Catalog
from panelforge.plans.recipe import Recipe, listed, query
from panelforge.sources import views
from panelforge.sources.files import folder
from panelforge.sources.views import table

AS_OF = "1998-06-14"

#: Raw bars with every 13th key twice.
RAW_TWICE = views.RAW_BARS.add(copy=("explode(sequence(0, CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END))", "unnest(range(0, CASE WHEN k % 13 = 0 THEN 2 ELSE 1 END))"))
#: Typed bars that may break any rule.
TYPED = RAW_TWICE.then(normalize.STOCK_DAY).pick(
    symbol="upper(coalesce(symbol, ''))",
    trade_date="trade_date",
    timeframe="CASE WHEN k % 53 = 0 THEN '' ELSE '1d' END",
    **{p: f"{p}_value" for p in normalize.PRICES},
    volume="volume_value",
    adjusted="CASE WHEN adjusted = 'maybe' THEN NULL ELSE is_adjusted END",
    seq="CAST(copy AS STRING) || ticker || date || open || close || volume || transactions",
)
STAMPS = Recipe().add(day_seconds=("CAST(datediff(CAST(o_orderdate AS DATE), DATE '1970-01-01') AS BIGINT) * 86400 + 3600", "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 + 3600")).pick(
    "o_orderkey",
    stamp="CASE o_orderkey % 7 WHEN 0 THEN CAST(day_seconds * 1000000000 AS STRING) WHEN 1 THEN CAST(day_seconds * 1000000 AS STRING) WHEN 2 THEN CAST(day_seconds * 1000 AS STRING) WHEN 3 THEN ' ' || CAST(day_seconds AS STRING) WHEN 4 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 5 THEN 'soon' ELSE '' END",
)
OPRA = Recipe().pick(
    ticker="CASE p_partkey % 9 WHEN 0 THEN 'SPY' WHEN 1 THEN 'O:QQQ991332C00400000' WHEN 2 THEN 'O:240119C00400000' WHEN 3 THEN 'O:ABC240119X00400000' ELSE (CASE WHEN p_partkey % 2 = 0 THEN 'O:' ELSE '' END) || 'S' || CAST(p_partkey % 50 AS STRING) || 'Q' || '2' || CAST(p_partkey % 8 AS STRING) || '0' || CAST(1 + p_partkey % 9 AS STRING) || '1' || CAST(p_partkey % 10 AS STRING) || (CASE WHEN p_partkey % 3 = 0 THEN 'C' ELSE 'P' END) || lpad(CAST(p_size * 12500 AS STRING), 8, '0') END",
    volume="CAST(p_size - 3 AS BIGINT)",
    transactions="CAST(p_size - 5 AS BIGINT)",
    high="p_retailprice",
    low="CASE WHEN p_partkey % 10 = 0 THEN p_retailprice + 1 ELSE p_retailprice - 1 END",
)
NAMED_FLAGGED = views.NAMED_BARS.pick("symbol", "trade_date", adjusted="transactions % 2 = 0")
#: Last day loaded so far: the older two thirds of each symbol's days.
CHECKPOINTS = views.BARS.add(number="row_number() OVER (PARTITION BY symbol ORDER BY trade_date)", of="count(*) OVER (PARTITION BY symbol)").where("number * 3 <= of * 2 AND CAST(substr(symbol, 2) AS BIGINT) % 4 <> 0").group(["symbol"], last_success="max(trade_date)")
VALID = TYPED.then(quality.CHECKED).where("valid")
_TARGET_OF_VALID = Recipe().where("day(trade_date) % 2 = 0").add(place="row_number() OVER (PARTITION BY symbol, trade_date, timeframe, adjusted ORDER BY seq DESC)").where("place = 1").pick(*upsert.KEY, "close", "volume", "seq")
_SOURCE_OF_VALID = Recipe().where("day(trade_date) % 3 = 0").pick(*upsert.KEY, "close", "volume", "seq")
TARGET, SOURCE = VALID.then(_TARGET_OF_VALID), VALID.then(_SOURCE_OF_VALID)


def _apply(recipe: Recipe, spark: SparkSession, sf_dir: str, name: str = "lineitem") -> DataFrame:
    return recipe.apply(table(spark, sf_dir, name))


def coverage_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = _apply(views.NAMED_BARS, spark, sf_dir)
    return coverage.expected_days(bars, coverage.trading_days(bars))


def trading_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the days that orders span; a few thousand rows, so that its window may be one partition."""
    return coverage.NEIGHBOURS.apply(coverage.trading_days(table(spark, sf_dir, "orders"), "o_orderdate"))


COVERAGE_PANEL_SQL = coverage.expected_days_sql(views.NAMED_BARS.sql("lineitem"), coverage.trading_days_sql(views.NAMED_BARS.sql("lineitem")))


def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid raw bars on the days that the even-day target lacks."""
    days = coverage.trading_days(_apply(views.BARS, spark, sf_dir)).select(F.col("day").alias("trade_date"))
    have = _apply(TARGET, spark, sf_dir).select("symbol", "trade_date").distinct()
    raw = _apply(VALID, spark, sf_dir).join(days, "trade_date", "left_semi").join(have, ["symbol", "trade_date"], "left_anti")
    return upsert.first_wins(raw, upsert.KEY, ["seq"]).groupBy("symbol").agg(F.count("*").alias("candidates"), F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))


GAP_FILL_SQL = f"""
WITH have AS (SELECT DISTINCT symbol, trade_date FROM {TARGET.sql('lineitem')}),
raw AS (SELECT *, row_number() OVER (PARTITION BY symbol, trade_date, timeframe, adjusted ORDER BY seq) AS place FROM {VALID.sql('lineitem')} v
        WHERE trade_date IN (SELECT day FROM {coverage.trading_days_sql(views.BARS.sql('lineitem'))})
          AND NOT EXISTS (SELECT 1 FROM have h WHERE h.symbol = v.symbol AND h.trade_date = v.trade_date))
SELECT symbol, count(*) AS candidates, min(trade_date) AS first_day, max(trade_date) AS last_day FROM raw WHERE place = 1 GROUP BY symbol
"""


def upsert_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # both sides are taken from the same valid rows, which are made once
    path = folder(spark)
    _apply(VALID, spark, sf_dir).select(*upsert.KEY, "close", "volume", "seq").where("day(trade_date) % 2 = 0 OR day(trade_date) % 3 = 0").write.parquet(path)
    valid = spark.read.parquet(path)
    return upsert.upsert(_TARGET_OF_VALID.apply(valid), _SOURCE_OF_VALID.apply(valid), upsert.KEY, ["seq"])


UPSERT_SQL = f"""
WITH target AS {TARGET.sql('lineitem')},
source AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_date, timeframe, adjusted ORDER BY seq) AS place FROM {SOURCE.sql('lineitem')}) WHERE place = 1)
SELECT symbol, trade_date, timeframe, adjusted, close, volume, seq, 'kept' AS action FROM target t
WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.symbol = t.symbol AND s.trade_date = t.trade_date AND s.timeframe = t.timeframe AND s.adjusted = t.adjusted)
UNION ALL
SELECT symbol, trade_date, timeframe, adjusted, close, volume, seq,
       CASE WHEN EXISTS (SELECT 1 FROM target t WHERE s.symbol = t.symbol AND s.trade_date = t.trade_date AND s.timeframe = t.timeframe AND s.adjusted = t.adjusted) THEN 'updated' ELSE 'inserted' END
FROM source s
"""
_UPSERT_COUNTS = ["kept", "updated", "inserted"]


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = upsert_bars(spark, sf_dir)
    return merged.groupBy("symbol").agg(*[F.count(F.when(F.col("action") == a, 1)).alias(a) for a in _UPSERT_COUNTS])


def snapshot_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by symbol and what a write, and a dry run of it, would do with them."""
    # the parts of a key meet by symbol before it is made, and all else happens where they lie; no other column of a key's first row is read
    grain, parts = ["symbol", "trade_date"], ["symbol", "trade_date", "adjusted", "vendor", "dataset_version", "file_sha", "timeframe"]
    rows = _apply(RAW_TWICE.then(normalize.CANONICAL_BARS).pick(*parts).gathered("symbol", joined=False), spark, sf_dir).distinct()
    rows = normalize.KEYS.apply(rows).select(*grain, "handoff_key")
    side = lambda key, stored: F.struct(key.alias("handoff_key"), F.lit(stored).alias("stored"))
    held = side(F.when(F.expr("day(trade_date) % 10 = 0"), F.col("handoff_key")).otherwise(F.concat(F.lit("x"), "handoff_key")), True)
    # some rows arrive without a key, also on days that the target holds
    arrived = side(F.when(F.expr("day(trade_date) % 7 <> 1"), F.col("handoff_key")), False)
    both = rows.select(*grain, F.inline(F.when(F.expr("day(trade_date) % 5 = 0"), F.array(arrived, held)).otherwise(F.array(arrived))))
    told = upsert.snapshot_status_by_grain(both, grain, "handoff_key", "stored").groupBy("symbol", "write_status").agg(F.count("*").alias("n"))
    # a dry run tells the same, but for what a write accepts
    runs = F.when(F.col("write_status") == "WRITE_ACCEPTED", F.array(F.lit("WRITE_ACCEPTED"), F.lit("DRY_RUN_READY"))).otherwise(F.array("write_status"))
    return told.select("symbol", F.explode(runs).alias("write_status"), "n")


SNAPSHOT_SQL = f"""
WITH rows AS (SELECT * FROM (SELECT symbol, trade_date, handoff_key, seq, row_number() OVER (PARTITION BY handoff_key ORDER BY seq) AS place FROM {RAW_TWICE.then(normalize.CANONICAL).sql('lineitem')}) WHERE place = 1),
target AS (SELECT symbol, trade_date, CASE WHEN day(trade_date) % 10 = 0 THEN handoff_key ELSE 'x' || handoff_key END AS handoff_key FROM rows WHERE day(trade_date) % 5 = 0)
SELECT symbol, unnest(CASE write_status WHEN 'WRITE_ACCEPTED' THEN ['WRITE_ACCEPTED', 'DRY_RUN_READY'] ELSE [write_status] END) AS write_status, n FROM (SELECT symbol, write_status, count(*) AS n FROM (
  SELECT symbol, CASE WHEN day(trade_date) % 7 = 1 THEN 'REJECTED' WHEN handoff_key IN (SELECT handoff_key FROM target) THEN 'IDEMPOTENT_NOOP'
         WHEN EXISTS (SELECT 1 FROM target t WHERE t.symbol = r.symbol AND t.trade_date = r.trade_date) THEN 'CONFLICT' ELSE 'WRITE_ACCEPTED' END AS write_status
  FROM rows r) GROUP BY symbol, write_status)
"""


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.load_summary(_apply(TYPED, spark, sf_dir), _apply(CHECKPOINTS, spark, sf_dir), quality.CHECKED, "1993-01-01")


INCREMENTAL_SQL = f"""
WITH source AS {TYPED.sql('lineitem')}, checkpoints AS {CHECKPOINTS.sql('lineitem')},
fresh AS (SELECT s.* FROM source s LEFT JOIN checkpoints c USING (symbol)
          WHERE s.trade_date IS NULL OR s.trade_date >= greatest(DATE '1993-01-01', c.last_success + 1)),
valid AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_date, timeframe, adjusted ORDER BY seq) AS place FROM {quality.CHECKED.where('valid').sql('fresh')}) WHERE place = 1),
n AS (SELECT symbol, count(*) AS received FROM source GROUP BY symbol),
f AS (SELECT symbol, count(*) AS fresh FROM fresh GROUP BY symbol),
w AS (SELECT symbol, count(*) AS written, max(trade_date) AS new_last FROM valid GROUP BY symbol)
SELECT n.symbol, received, coalesce(fresh, 0) AS fresh, coalesce(written, 0) AS written, coalesce(new_last, last_success) AS checkpoint,
       CASE WHEN coalesce(fresh, 0) = 0 THEN 'skipped_already_current' WHEN coalesce(written, 0) = 0 THEN 'failed' ELSE 'completed' END AS status
FROM n LEFT JOIN f USING (symbol) LEFT JOIN w USING (symbol) LEFT JOIN checkpoints USING (symbol)
"""


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows expected from the raw file against rows that came out valid, by symbol."""
    raw = _apply(TYPED, spark, sf_dir).groupBy("symbol").agg(F.count("*").alias("expected"))
    good = _apply(VALID, spark, sf_dir).groupBy("symbol").agg(F.count("*").alias("received"))
    both = raw.join(good, "symbol", "full").fillna(0, ["expected", "received"])
    return both.select("symbol", "expected", "received", F.greatest(F.col("expected") - F.col("received"), F.lit(0)).alias("missing"), F.greatest(F.col("received") - F.col("expected"), F.lit(0)).alias("excess"))


RECONCILE_SQL = f"""
SELECT symbol, coalesce(expected, 0) AS expected, coalesce(received, 0) AS received,
       greatest(coalesce(expected, 0) - coalesce(received, 0), 0) AS missing, greatest(coalesce(received, 0) - coalesce(expected, 0), 0) AS excess
FROM (SELECT symbol, count(*) AS expected FROM {TYPED.sql('lineitem')} GROUP BY symbol)
FULL JOIN (SELECT symbol, count(*) AS received FROM {VALID.sql('lineitem')} GROUP BY symbol) USING (symbol)
"""
#: Requested series against what is there.
_REQUESTED = [*views.SERIES, "GDP", "UNRATE"]


def series_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = _apply(views.SERIES_POINTS, spark, sf_dir).groupBy("series").agg(F.count("*").alias("n"), F.max("observation_date").alias("latest"), F.count(F.when(F.col("value").isNull(), 1)).alias("missing_values"))
    asked = spark.createDataFrame([(s,) for s in _REQUESTED], "series string")
    out = asked.join(have, "series", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("series", n.alias("n"), "latest", F.coalesce("missing_values", F.lit(0)).alias("missing_values"), F.when(n == 0, "FAIL").when(F.col("missing_values") > 0, "WARN").otherwise("PASS").alias("status"))


SERIES_SQL = f"""
SELECT series, coalesce(n, 0) AS n, latest, coalesce(missing_values, 0) AS missing_values,
       CASE WHEN coalesce(n, 0) = 0 THEN 'FAIL' WHEN missing_values > 0 THEN 'WARN' ELSE 'PASS' END AS status
FROM (SELECT unnest([{', '.join(f"'{s}'" for s in _REQUESTED)}]) AS series)
LEFT JOIN (SELECT series, count(*) AS n, max(observation_date) AS latest, count(CASE WHEN value IS NULL THEN 1 END) AS missing_values FROM {views.SERIES_POINTS.sql('lineitem')} GROUP BY series) USING (series)
"""


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON properties of events, kept apart where they do not parse, counted by type."""
    rows = table(spark, sf_dir, "events").withColumn("parsed", F.expr("try_parse_json(props)"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count(F.when(F.col("props").isNotNull() & F.col("parsed").isNull(), 1)).alias("malformed"))


EVENT_PROPS_SQL = "SELECT event_type, count(*) AS n, count(CASE WHEN props IS NOT NULL AND NOT json_valid(props) THEN 1 END) AS malformed FROM events GROUP BY event_type"
RECENT = Recipe().add(place="row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC NULLS LAST, c_custkey)").where("place <= 5").pick("c_mktsegment", "c_custkey", "c_acctbal", "place")


def register(c: Catalog) -> None:
    c.recipe("normalize_stock_day", "lineitem", RAW_TWICE, normalize.STOCK_DAY, columns=["copy", *normalize.STOCK_COLUMNS])
    c.recipe("canonical_bars_keys", "lineitem", RAW_TWICE, normalize.CANONICAL, columns=normalize.CANONICAL_COLUMNS)
    c.recipe("epoch_days", "orders", STAMPS, normalize.EPOCHS)
    c.recipe("option_symbols", "part", OPRA, normalize.OPTION_SYMBOLS, columns=normalize.OPTION_COLUMNS)
    c.recipe("symbol_master", "customer", views.REFERENCE_TICKERS, normalize.SYMBOL_MASTER, columns=normalize.SYMBOL_COLUMNS)
    c.recipe("symbol_master_coverage", "customer", views.REFERENCE_TICKERS, normalize.SYMBOL_MASTER, coverage.MASTER_COVERAGE)
    c.recipe("symbol_master_groups", "customer", views.REFERENCE_TICKERS, normalize.SYMBOL_MASTER, Recipe().group(["asset_type", "exchange_code"], n="count(*)", active="count(CASE WHEN active_flag THEN 1 END)"))
    c.recipe("bar_checks", "lineitem", TYPED, quality.CHECKED, columns=["symbol", "trade_date", "seq", "failures", "valid"])
    c.recipe("bar_check_summary", "lineitem", TYPED, quality.RULE_SUMMARY)
    c.recipe("duplicate_candles", "lineitem", TYPED, quality.DUPLICATES)
    c.recipe("first_row_acceptance", "lineitem", TYPED, quality.ACCEPT_FIRST)
    c.recipe("acceptance_policies", "lineitem", TYPED, quality.POLICIES)
    c.recipe("failure_profile", "lineitem", TYPED, quality.FAILURES)
    c.recipe("file_profile", "lineitem", RAW_TWICE, quality.FILE_PROFILE)
    c.plan("reconcile_counts", reconcile, RECONCILE_SQL)
    c.plan("coverage_by_symbol", lambda s, d: coverage.COVERAGE.apply(coverage_panel(s, d)), query(coverage.COVERAGE.sql(COVERAGE_PANEL_SQL)))
    c.plan("coverage_gaps", lambda s, d: coverage.GAPS.apply(coverage_panel(s, d)), query(coverage.GAPS.sql(COVERAGE_PANEL_SQL)))
    c.plan("gap_fill_candidates", gap_fill, GAP_FILL_SQL)
    c.recipe("bar_overlap", "lineitem", TYPED, coverage.OVERLAP)
    c.recipe("row_profile", "lineitem", NAMED_FLAGGED, coverage.ROW_PROFILE)
    c.recipe("latest_status", "lineitem", views.BARS, coverage.latest_status(AS_OF))
    ranges = views.BARS.group(["symbol"], start_day="min(trade_date)", end_day="max(trade_date)")
    c.recipe("backfill_chunks", "lineitem", ranges, coverage.chunks(90))
    c.recipe("recent_rows", "customer", RECENT)
    c.plan("series_evidence", series_evidence, SERIES_SQL)
    c.plan("upsert_bars", upsert_bars, UPSERT_SQL)
    c.plan("trading_calendar", trading_calendar, query(coverage.NEIGHBOURS.sql(coverage.trading_days_sql("orders", "o_orderdate"))))
    c.plan("upsert_counts", upsert_counts, f"SELECT symbol, {', '.join(f'''count(CASE WHEN action = '{a}' THEN 1 END) AS {a}''' for a in _UPSERT_COUNTS)} FROM ({UPSERT_SQL}) GROUP BY symbol")
    c.plan("snapshot_write", snapshot_write, SNAPSHOT_SQL)
    c.plan("incremental_load", incremental_load, INCREMENTAL_SQL)
    c.plan("event_props", event_props, EVENT_PROPS_SQL)
    c.recipe("run_totals", "lineitem", TYPED, quality.CHECKED, Recipe().group(["symbol"], n="count(*)", ok="count(CASE WHEN valid THEN 1 END)").add(status="CASE WHEN ok = n THEN 'SUCCESS' WHEN ok > 0 THEN 'PARTIAL' ELSE 'FAILED' END").group(["status"], symbols="count(*)", total_rows="sum(n)", names=listed("symbol", "symbol")))
