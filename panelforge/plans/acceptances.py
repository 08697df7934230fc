"""Queries of acceptance rules, writers and batch reports over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import acceptance as a
from panelforge.operators import normalize, rotation, upsert
from panelforge.plans.catalog import Catalog
from panelforge.plans.recipe import Recipe, sha256
from panelforge.sources import views
from panelforge.sources.views import table

FILE_ROWS = views.RAW_BARS.pick(
    "ticker", "date", "open", "high", "low", "close", "volume", "transactions", file_day="CASE WHEN k % 61 = 0 THEN '1997-01-01' ELSE date END",
    line="lpad(CAST(k AS STRING), 9, '0') || ticker || open || close || volume",
)
MANIFESTS = Recipe().add(day="CAST(o_orderdate AS DATE)").pick(
    "o_orderkey", vendor="CASE WHEN o_orderkey % 17 = 0 THEN 'other' ELSE 'polygon' END", asset_class="CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'etfs' END", data_type="CASE WHEN o_orderkey % 19 = 0 THEN 'tick' ELSE 'daily_ohlcv' END",
    schema_version="CASE WHEN o_orderkey % 11 = 0 THEN '2.0' ELSE '1.0' END", dataset_version="'v1'", validation_status="CASE WHEN o_orderkey % 7 = 0 THEN 'FAIL' ELSE 'PASS' END", certification_status="'FIXTURE_ONLY'",
    source_file_sha256="CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE 'y' END", file_sha256="'y'",
)
OPTION_RECORDS = Recipe().pick(
    "p_partkey", source_dataset="CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'odd' WHEN 2 THEN 'options_open_interest' WHEN 3 THEN 'options_greeks_iv' WHEN 4 THEN 'options_contracts_master' ELSE 'options_day_aggregates' END",
    present="'|contract_symbol|underlying_symbol|expiration_date|strike_price|' || CASE WHEN p_partkey % 2 = 0 THEN 'option_type|trade_date|' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN 'open|high|low|close|volume|transactions|' ELSE 'observation_date|open_interest|' END",
)
BUNDLES = Recipe().pick(
    "o_orderkey", observation_date="CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END", **{f: f"CASE WHEN o_orderkey % {31 + 2 * i} = 0 THEN false WHEN o_orderkey % {31 + 2 * i} = 1 THEN NULL ELSE true END" for i, f in enumerate(a.FLAGS)},
    **{s: f"CASE WHEN o_orderkey % {41 + 2 * i} = 0 THEN '' WHEN o_orderkey % {41 + 2 * i} = 1 THEN NULL ELSE 'LABEL' END" for i, s in enumerate(a.SECTIONS)},
)
HISTORY = views.NAMED_BARS.where("symbol IN (" + ", ".join(f"'{s}'" for s in (rotation.BENCHMARK, *rotation.SECTORS)) + ")").add(n="transactions + CAST(day(trade_date) AS BIGINT)").pick(
    "symbol", "trade_date", close="CASE WHEN n % 23 = 0 THEN NULL ELSE close END", quality_status="CASE n % 9 WHEN 0 THEN 'valid ' WHEN 1 THEN NULL WHEN 2 THEN 'BROKEN' ELSE 'WARNING' END",
    certification_status="CASE n % 7 WHEN 0 THEN 'REVOKED' WHEN 1 THEN NULL ELSE 'Certified' END", freshness_status="CASE n % 11 WHEN 0 THEN 'OLD' ELSE 'STALE' END",
)
ARTIFACT_ROWS = views.BARS.add(k="CAST(substr(symbol, 2) AS BIGINT)").add(n="count(*) OVER (PARTITION BY trade_date)").pick(
    "trade_date", file_day="trade_date", ok="k % 9 <> 0", stated_rows="CASE WHEN day(trade_date) = 3 THEN n + 1 ELSE n END", dataset="CASE WHEN day(trade_date) = 5 AND k % 8 = 0 THEN 'other' ELSE 'day_aggs' END", manifest_from="DATE '1993-01-01'", manifest_to="DATE '1999-12-31'",
)
STOCK_ROWS = views.BARS.add(k="CAST(day(trade_date) AS BIGINT)").add(file_sha256=sha256("'day_aggs'", "trade_date")).pick("symbol", "trade_date", "file_sha256", path="'quarantine/' || CAST(trade_date AS STRING)", adjusted_status="CASE k % 4 WHEN 0 THEN ' Adjusted' WHEN 1 THEN 'unadjusted' WHEN 2 THEN NULL ELSE 'maybe' END")
FETCHED = views.RAW_BARS.pick(symbol="upper(trim(ticker))", ok="date <> 'n/a' AND close <> 'x'")
BATCHES = Recipe().pick(
    batch="'b' || CAST(o_custkey AS STRING)", found="CASE o_orderkey % 36 WHEN 0 THEN NULL ELSE o_orderkey % 12 <> 0 END", validation_status="CASE o_orderkey % 25 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARN' WHEN 2 THEN NULL ELSE 'PASS' END",
    coverage_status="CASE o_orderkey % 24 WHEN 0 THEN 'PARTIAL' WHEN 1 THEN NULL ELSE 'COMPLETE' END", quality_status="CASE o_orderkey % 26 WHEN 0 THEN 'WARN' WHEN 1 THEN NULL ELSE 'PASS' END",
    certification_status="CASE o_orderkey % 28 WHEN 0 THEN 'NONE' WHEN 1 THEN NULL WHEN 2 THEN 'FIXTURE_CERTIFIED' ELSE 'DRY_RUN_CERTIFIED' END",
)
#: A batch passes a status only if every symbol that was found has it; one without evidence leaves the validation as it is.
BATCHES_SQL = f"""
WITH told AS (
    SELECT batch, coalesce(found, false) AND validation_status IS DISTINCT FROM 'ERROR' AS good, coalesce(found, false) AS found,
        validation_status IS NOT DISTINCT FROM 'PASS' AS v, coverage_status IS NOT DISTINCT FROM 'COMPLETE' AS c, quality_status IS NOT DISTINCT FROM 'PASS' AS q, coalesce(certification_status LIKE '%\\_CERTIFIED' ESCAPE '\\', false) AS k
    FROM {BATCHES.sql('orders')}
)
SELECT batch, count(*) FILTER (WHERE good) AS succeeded, count(*) FILTER (WHERE NOT good) AS failed,
    if(bool_and(NOT found OR (good AND v)), 'PASS', 'FAILED') AS validation_status, if(bool_and(good AND c), 'COMPLETE', 'MISSING') AS coverage_status,
    if(bool_and(good AND q), 'PASS', 'WARN') AS quality_status, if(bool_and(good AND k), 'CERTIFIED', 'UNCERTIFIED') AS certification_status
FROM told GROUP BY batch
"""
REQUIRED_SYMBOLS = [rotation.BENCHMARK, *rotation.SECTORS, "QQQ", " xaa", "ZZZ"]
HISTORY_SQL = f"""
WITH h AS (SELECT *, upper(trim(quality_status)) AS q, upper(trim(certification_status)) AS c, upper(trim(freshness_status)) AS f FROM {HISTORY.sql('lineitem')}),
told AS (
    SELECT symbol, trade_date, CASE WHEN q IS NOT NULL AND q <> 'VALID' AND q <> 'WARNING' AND q <> 'PENDING' THEN 'rejected_quality_status' WHEN c IS NOT NULL AND c <> 'CERTIFIED' AND c <> 'PENDING' AND c <> 'UNCERTIFIED' THEN 'rejected_certification_status'
        WHEN f IS NOT NULL AND NOT list_contains(['FRESH', 'DELAYED', 'PENDING', 'UNKNOWN', 'STALE'], f) THEN 'rejected_freshness_status' WHEN close IS NULL THEN 'missing_or_invalid_close' END AS why
    FROM h
),
wanted AS (SELECT DISTINCT upper(trim(s)) AS symbol FROM (SELECT unnest([{', '.join(f"'{s}'" for s in REQUIRED_SYMBOLS)}]) AS s)),
counted AS (SELECT w.symbol, count(t.symbol) FILTER (WHERE why IS NULL) AS history, count(why) AS rejected, coalesce(string_agg(DISTINCT why, ',' ORDER BY why), '') AS rejections, min(trade_date) FILTER (WHERE why IS NULL) AS first_day, max(trade_date) FILTER (WHERE why IS NULL) AS last_day FROM wanted w LEFT JOIN told t ON t.symbol = w.symbol GROUP BY w.symbol)
SELECT *, CASE WHEN history = 0 THEN 'missing_required_symbol,insufficient_history' WHEN history < 61 THEN 'insufficient_history' ELSE '' END AS warnings FROM counted
"""
_POINTS = views.SERIES_POINTS.add(n="CAST(day(observation_date) AS BIGINT)")
STORED = _POINTS.where("n % 2 = 0").pick("series", "observation_date", value="value", released="'old'", source="'s'")
ARRIVED = _POINTS.add(copy=("explode(sequence(0, CASE WHEN n % 9 = 0 THEN 1 ELSE 0 END))", "unnest(range(0, CASE WHEN n % 9 = 0 THEN 2 ELSE 1 END))")).where("n % 3 = 0").pick("series", "observation_date", "copy", value="value + 1 + copy", released="'new'", source="'s'")
_KEY = ["series", "observation_date", "source"]


def macro_writes_of(spark: SparkSession, sf_dir: str, keep: tuple[str, ...]) -> DataFrame:
    """Series points after a write: of a key's rows the first counts; columns in ``keep`` stay as stored."""
    points = table(spark, sf_dir, "lineitem")
    stored = STORED.apply(points).withColumn("copy", F.lit(0))
    return upsert.upsert(stored, ARRIVED.apply(points), _KEY, ["copy"], keep=keep).drop("copy")


def macro_sql(released: str) -> str:
    return f"""
WITH stored AS {STORED.sql('lineitem')}, arrived AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series, observation_date, source ORDER BY copy) AS place FROM {ARRIVED.sql('lineitem')}) WHERE place = 1)
SELECT series, observation_date, source, CASE WHEN a.copy IS NOT NULL THEN a.value ELSE s.value END AS value, {released} AS released,
       CASE WHEN a.copy IS NULL THEN 'kept' WHEN s.released IS NULL THEN 'inserted' ELSE 'updated' END AS action
FROM stored s FULL JOIN arrived a USING (series, observation_date, source)
"""


def write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per series: rows of the write that were inserted, updated, skipped as repeats."""
    points = table(spark, sf_dir, "lineitem")
    repeats = ARRIVED.apply(points).groupBy("series").agg(F.count("*").alias("received"))
    done = macro_writes_of(spark, sf_dir, ()).groupBy("series").agg(*[F.count(F.when(F.col("action") == w, 1)).alias(w) for w in ("inserted", "updated")])
    return repeats.join(done, "series").select("series", "inserted", "updated", (F.col("received") - F.col("inserted") - F.col("updated")).alias("skipped"))


WRITE_COUNTS_SQL = f"""
WITH w AS ({macro_sql("coalesce(a.released, s.released)")}), r AS (SELECT series, count(*) AS received FROM {ARRIVED.sql('lineitem')} GROUP BY series)
SELECT series, inserted, updated, received - inserted - updated AS skipped
FROM r JOIN (SELECT series, count(CASE WHEN action = 'inserted' THEN 1 END) AS inserted, count(CASE WHEN action = 'updated' THEN 1 END) AS updated FROM w GROUP BY series) USING (series)
"""
_MASTER = views.REFERENCE_TICKERS.then(normalize.SYMBOL_MASTER).where("errors = ''").pick("symbol", "full_name", "exchange_code", "currency_code", "identity_key")
_OLD = _MASTER.where("CAST(substr(symbol, 2) AS BIGINT) % 3 <> 0").pick("symbol", "identity_key", full_name="'old name'", exchange_code="exchange_code", currency_code="'USD'")
_NEW = _MASTER.where("CAST(substr(symbol, 2) AS BIGINT) % 2 = 0")


def symbol_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol master after a write: all attributes of a known symbol are replaced."""
    rows = table(spark, sf_dir, "customer")
    return upsert.upsert(_OLD.apply(rows), _NEW.apply(rows), ["symbol"], ["identity_key"])


SYMBOL_WRITES_SQL = f"""
WITH o AS {_OLD.sql('customer')}, n AS {_NEW.sql('customer')}
SELECT *, 'kept' AS action FROM o WHERE symbol NOT IN (SELECT symbol FROM n)
UNION ALL BY NAME SELECT *, CASE WHEN symbol IN (SELECT symbol FROM o) THEN 'updated' ELSE 'inserted' END AS action FROM n
"""
_STATES = Recipe().pick(checkpoint_id="'c' || CAST(o_custkey AS STRING)", last_day="CAST(o_orderdate AS DATE)", status="CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'completed' END", run="o_orderkey")


def state_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended run states to one checkpoint a key: the latest run's, with the number of attempts."""
    states = _STATES.apply(table(spark, sf_dir, "orders"))
    last = states.groupBy("checkpoint_id").agg(F.max_by(F.struct("last_day", "status"), "run").alias("s"), F.count("*").alias("attempts"), F.max("run").alias("run"))
    return last.select("checkpoint_id", "attempts", "run", "s.last_day", "s.status")


STATES_SQL = f"SELECT checkpoint_id, count(*) AS attempts, max(run) AS run, arg_max(last_day, run) AS last_day, arg_max(status, run) AS status FROM {_STATES.sql('orders')} GROUP BY checkpoint_id"


def register(c: Catalog) -> None:
    c.recipe("flat_file_acceptance", "lineitem", FILE_ROWS, a.FLAT_FILE_SUMMARY)
    c.recipe("manifest_checks", "orders", MANIFESTS, a.MANIFEST, columns=["o_orderkey", "errors", "accepted"])
    c.recipe("option_handoff_checks", "part", OPTION_RECORDS, a.OPTION_HANDOFF, columns=["p_partkey", "source_dataset", "errors"])
    c.recipe("bundle_checks", "orders", BUNDLES, a.BUNDLE, columns=["o_orderkey", "errors", "is_valid"])
    c.plan("certified_history", lambda spark, sf_dir: a.certified_history(HISTORY.apply(table(spark, sf_dir, "lineitem")), REQUIRED_SYMBOLS), HISTORY_SQL)
    c.recipe("artifact_checks", "lineitem", ARTIFACT_ROWS, a.ARTIFACT_FILES)
    c.recipe("intake_descriptor", "lineitem", ARTIFACT_ROWS, a.DESCRIPTOR)
    c.recipe("stock_artifact_keys", "lineitem", STOCK_ROWS, a.STOCK_KEYS, columns=["symbol", "trade_date", "lineage_id", "row_key", "record_digest"])
    c.recipe("fanout_report", "lineitem", FETCHED, a.FANOUT)
    c.plan("multi_symbol_status", lambda spark, sf_dir: a.MULTI_SYMBOL.apply(BATCHES.apply(table(spark, sf_dir, "orders"))), BATCHES_SQL)
    c.recipe("fanout_totals", "lineitem", FETCHED, a.FANOUT_TOTALS)
    c.recipe("symbol_master_batch", "customer", views.REFERENCE_TICKERS, normalize.SYMBOL_MASTER, a.symbol_batch(tuple(f"x{i}" for i in range(20)), ("stock", "etf", "index", "common_stock", "adr")))
    c.plan("macro_writes", lambda spark, sf_dir: macro_writes_of(spark, sf_dir, ()), macro_sql("coalesce(a.released, s.released)"))
    c.plan("macro_value_writes", lambda spark, sf_dir: macro_writes_of(spark, sf_dir, ("released",)), macro_sql("coalesce(s.released, a.released)"))
    c.plan("macro_write_counts", write_counts, WRITE_COUNTS_SQL)
    c.plan("symbol_master_writes", symbol_writes, SYMBOL_WRITES_SQL)
    c.plan("state_checkpoints", state_appends, STATES_SQL)
    c.recipe("rotation_report", "lineitem", views.NAMED_BARS, rotation.REPORT)
