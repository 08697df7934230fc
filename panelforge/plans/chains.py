"""Queries of evidence chains, the exchange calendar and batch gates, with DuckDB text of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import batch_gate, coverage, evidence_chain, sessions
from panelforge.plans.catalog import Catalog
from panelforge.plans.ingestion import OPRA
from panelforge.plans.recipe import Recipe
from panelforge.sources import artifacts, views
from panelforge.sources.files import folder
from panelforge.sources.views import table

#: Bars but those of some symbols' months, chunks of 90 days, and states of orders.
HELD = views.BARS.where("(CAST(substr(symbol, 2) AS BIGINT) + month(trade_date)) % 11 <> 0")
_RANGES = views.BARS.group(["symbol"], start_day="min(trade_date)", end_day="max(trade_date)")
CHUNKS = _RANGES.then(coverage.chunks(90))
STATES = Recipe().pick(
    kind="CASE o_orderkey % 5 WHEN 0 THEN 'run' WHEN 1 THEN 'quality' WHEN 2 THEN 'lineage' WHEN 3 THEN 'run' ELSE 'other' END", symbol="concat('S', CAST(o_custkey % 131 AS STRING))",
    day="CASE WHEN o_orderkey % 77 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END", id="o_orderkey", status="CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'SUCCESS' ELSE 'PARTIAL' END",
)
#: Which components a symbol's chains need, by the bits of its number.
_NEEDS = {"bars": 2, "run": 3, "quality": 5, "lineage": 7, "checkpoint": 4}


def _number(c: str) -> str:
    return f"CAST(substr({c}, 2) AS BIGINT)"


def evidence_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    bars, chunks = HELD.apply(lines), CHUNKS.apply(lines)
    needs = F.struct(*[F.expr(f"({_number('symbol')} + chunk_number) % {k} <> 0").alias(n) for n, k in _NEEDS.items()])
    checkpoints = chunks.where(f"({_number('symbol')} + chunk_number) % 6 < 4").select("symbol", "chunk_start", F.expr(f"CASE WHEN ({_number('symbol')} + chunk_number) % 9 = 0 THEN chunk_start WHEN chunk_number % 9 = 1 THEN NULL ELSE chunk_end END").alias("last_success"))
    days = sessions.sessions(lines, "l_shipdate").where("is_open").select("day")
    return evidence_chain.evidence_chain(chunks.select("symbol", "chunk_start", "chunk_end", needs.alias("needs")), bars, days, STATES.apply(table(spark, sf_dir, "orders")).where("kind <> 'other'"), checkpoints)


#: Holidays by recursion-free arithmetic on each day: n-th weekdays by the day of the month, Easter from golden number and epact.
_SESSIONS_SQL = """
ends AS (SELECT CAST(min({column}) AS DATE) AS low, CAST(max({column}) AS DATE) AS high FROM {table}),
days AS (SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day FROM ends),
parts AS (SELECT day, year(day) AS y, month(day) AS m, day(day) AS d, isodow(day) AS w, day(last_day(day)) AS n FROM days),
moons AS (SELECT DISTINCT y, y % 19 + 1 AS golden, y // 100 + 1 AS century FROM parts),
epacts AS (SELECT *, 3 * century // 4 - 12 AS leap, (8 * century + 5) // 25 - 5 AS moon FROM moons),
ages AS (SELECT *, 5 * y // 4 - leap - 10 AS sundays, (11 * golden + 20 + moon - leap) % 30 AS age0 FROM epacts),
fulls AS (SELECT y, sundays, CASE WHEN age0 = 25 AND golden > 11 OR age0 = 24 THEN age0 + 1 ELSE age0 END AS age FROM ages),
nights AS (SELECT y, sundays, CASE WHEN 44 - age < 21 THEN 44 - age + 30 ELSE 44 - age END AS full_moon FROM fulls),
fridays AS (SELECT y, CAST(make_date(y, 3, 1) + CAST(full_moon + 7 - (sundays + full_moon) % 7 - 3 AS INTEGER) AS DATE) AS day FROM nights),
told AS (
    SELECT p.*, CASE
        WHEN w > 5 THEN 'weekend'
        WHEN m = 12 AND (d = 25 OR d = 24 AND w = 5 OR d = 26 AND w = 1) THEN 'christmas'
        WHEN p.day = f.day THEN 'good_friday'
        WHEN m = 7 AND (d = 4 OR d = 3 AND w = 5 OR d = 5 AND w = 1) THEN 'independence_day'
        WHEN y >= 2022 AND m = 6 AND (d = 19 OR d = 18 AND w = 5 OR d = 20 AND w = 1) THEN 'juneteenth'
        WHEN m = 9 AND w = 1 AND d <= 7 THEN 'labor_day'
        WHEN m = 5 AND w = 1 AND d > n - 7 THEN 'memorial_day'
        WHEN y >= 1998 AND m = 1 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'mlk_day'
        WHEN m = 1 AND (d = 1 OR d = 2 AND w = 1) THEN 'new_year'
        WHEN m = 2 AND w = 1 AND d BETWEEN 15 AND 21 THEN 'presidents_day'
        WHEN m = 11 AND w = 4 AND d BETWEEN 22 AND 28 THEN 'thanksgiving'
        WHEN CAST(p.day AS VARCHAR) IN ({special}) THEN 'special' END AS closure
    FROM parts p JOIN fridays f USING (y)
),
calendar AS (
    SELECT day, closure IS NULL AS is_open, closure, CASE WHEN closure IS NULL THEN '09:30' END AS open_time,
        CASE WHEN closure IS NOT NULL THEN NULL WHEN m = 7 AND d = 3 OR m = 12 AND d = 24 OR m = 11 AND w = 5 AND d BETWEEN 23 AND 29 THEN '13:00' ELSE '16:00' END AS close_time
    FROM told
)
"""
_SPECIAL = ", ".join(f"'{d}'" for d in sessions.SPECIAL)
SESSIONS_SQL = f"WITH {_SESSIONS_SQL.format(column='o_orderdate', table='orders', special=_SPECIAL)} SELECT * FROM calendar"
_CHAIN_NEEDS = ", ".join(f"({_number('symbol')} + chunk_number) % {k} <> 0 AS needs_{n}" for n, k in _NEEDS.items())
_STATE_SQL = ", ".join(
    f"coalesce({k}_here, {k}_ever) AS {k}_status, CASE WHEN {k}_n > 0 THEN 'exact' WHEN {k}_all > 0 THEN 'fallback' ELSE 'none' END AS {k}_match, CASE WHEN {k}_n > 0 THEN {k}_n ELSE {k}_all END AS {k}_rows" for k in evidence_chain.KINDS
)
_HERE_SQL = ", ".join(
    f"(SELECT count(*) FROM states s WHERE s.kind = '{k}' AND s.symbol = c.symbol AND s.day BETWEEN chunk_start AND chunk_end) AS {k}_n, (SELECT count(*) FROM states s WHERE s.kind = '{k}' AND s.symbol = c.symbol) AS {k}_all, "
    f"(SELECT arg_max(status, (day, id)) FROM states s WHERE s.kind = '{k}' AND s.symbol = c.symbol AND s.day BETWEEN chunk_start AND chunk_end) AS {k}_here, (SELECT last(status ORDER BY day NULLS FIRST, id) FROM states s WHERE s.kind = '{k}' AND s.symbol = c.symbol) AS {k}_ever"
    for k in evidence_chain.KINDS
)
_NEED_SQL = "CASE WHEN {need} THEN CASE WHEN {there} THEN 'PASS' ELSE 'FAIL' END WHEN {there} THEN 'WARN' ELSE 'PASS' END".format
_PARTS = [f"{k}_component" for k in ("bars", *evidence_chain.KINDS, "checkpoint")]
CHAINS_SQL = f"""
WITH {_SESSIONS_SQL.format(column='l_shipdate', table='lineitem', special=_SPECIAL)},
bars AS (SELECT symbol, trade_date FROM {HELD.sql('lineitem')}),
states AS (SELECT * FROM {STATES.sql('orders')} WHERE kind <> 'other'),
chunks AS (
    SELECT *, {_CHAIN_NEEDS}, ({_number('symbol')} + chunk_number) % 6 < 4 AS saved,
        CASE WHEN ({_number('symbol')} + chunk_number) % 9 = 0 THEN chunk_start WHEN chunk_number % 9 = 1 THEN NULL ELSE chunk_end END AS last_success
    FROM {CHUNKS.sql('lineitem')}
),
met AS (
    SELECT c.*, (SELECT count(*) FROM bars b WHERE b.symbol = c.symbol AND b.trade_date BETWEEN chunk_start AND chunk_end) AS bars, (SELECT count(*) FROM calendar k WHERE k.is_open AND k.day BETWEEN chunk_start AND chunk_end) AS expected,
        (SELECT count(DISTINCT b.trade_date) FROM bars b JOIN calendar k ON k.day = b.trade_date AND k.is_open WHERE b.symbol = c.symbol AND b.trade_date BETWEEN chunk_start AND chunk_end) AS seen, {_HERE_SQL}
    FROM chunks c
),
counted AS (SELECT *, expected - seen AS missing, {_STATE_SQL} FROM met),
judged AS (
    SELECT *, CASE WHEN needs_bars AND (bars = 0 OR missing > 0) THEN 'FAIL' WHEN needs_bars THEN 'PASS' WHEN bars > 0 THEN 'WARN' ELSE 'PASS' END AS bars_component,
        {', '.join(f"{_NEED_SQL(need=f'needs_{k}', there=f'{k}_rows > 0')} AS {k}_component" for k in evidence_chain.KINDS)},
        CASE WHEN needs_checkpoint THEN CASE WHEN saved AND coalesce(last_success >= chunk_end, false) THEN 'PASS' ELSE 'FAIL' END WHEN saved THEN 'WARN' ELSE 'PASS' END AS checkpoint_component
    FROM counted
)
SELECT symbol, chunk_start, chunk_end, bars, expected, missing, {', '.join(f'{k}_status, {k}_match, {k}_rows' for k in evidence_chain.KINDS)}, {', '.join(_PARTS)},
    CASE WHEN 'FAIL' IN ({', '.join(_PARTS)}) THEN 'FAIL' WHEN 'WARN' IN ({', '.join(_PARTS)}) THEN 'WARN' ELSE 'PASS' END AS evidence_status,
    CASE WHEN missing > 0 THEN 'partial' WHEN bars = 0 AND run_rows = 0 AND quality_rows = 0 AND lineage_rows = 0 THEN 'missing' WHEN bars > 0 AND run_rows > 0 AND quality_rows > 0 AND lineage_rows > 0 THEN 'complete' ELSE 'partial' END AS shape
FROM judged
"""


def exchange_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessions(table(spark, sf_dir, "orders"), "o_orderdate")


def missing_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open days that a symbol lacks between its first and last bar, as a list in text."""
    lines = table(spark, sf_dir, "lineitem")
    out = sessions.missing_days(HELD.apply(lines), sessions.sessions(lines, "l_shipdate"))
    return out.withColumn("missing_days", F.array_join(F.transform("missing_days", lambda d: d.cast("string")), ","))


MISSING_SQL = f"""
WITH {_SESSIONS_SQL.format(column='l_shipdate', table='lineitem', special=_SPECIAL)},
have AS (SELECT DISTINCT symbol, trade_date AS day FROM {HELD.sql('lineitem')} SEMI JOIN calendar k ON k.day = trade_date AND k.is_open),
spans AS (SELECT symbol, min(day) AS low, max(day) AS high, count(*) AS observed FROM have GROUP BY symbol),
expected AS (SELECT s.symbol, k.day FROM spans s JOIN calendar k ON k.is_open AND k.day BETWEEN low AND high),
lists AS (SELECT symbol, count(*) AS expected, coalesce(string_agg(CASE WHEN (symbol, day) NOT IN (SELECT (symbol, day) FROM have) THEN CAST(day AS VARCHAR) END, ',' ORDER BY day), '') AS missing_days FROM expected GROUP BY symbol)
SELECT symbol, expected, observed, observed / expected AS ratio, missing_days FROM lists JOIN spans USING (symbol)
"""
#: Symbols of option rows, many of them broken.
_TICKER = dict(OPRA.steps[0][1])["ticker"]


def option_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and errors of option files; a file's status stands at each of its records."""
    keyed = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice").selectExpr("*", "concat('f', p_partkey % 97) AS file", "p_partkey AS row_number")
    rows = keyed.selectExpr("file", "row_number", f"{_TICKER} AS ticker", "p_retailprice AS high", "CASE WHEN p_partkey % 10 = 0 THEN p_retailprice + 1 ELSE p_retailprice - 1 END AS low", "CASE WHEN p_partkey % 83 = 0 THEN -1 WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS volume", "CASE WHEN p_partkey % 103 = 0 THEN -2 ELSE p_size END AS transactions")
    files = keyed.select("file").distinct().selectExpr("file", "concat('quarantine/', file) AS path", "CASE WHEN file <> 'f3' THEN sha2(file, 256) END AS sha256")
    records, errors = batch_gate.normalize_option_aggregates(rows, files)
    good = records.select("file", "row_number", "normalization_status", F.lit(None).cast("string").alias("code"), "contract.underlying_symbol", "contract.expiration_date", "contract.option_type", F.col("contract.strike_price").cast("double").alias("strike"), F.array_join("warnings", "; ").alias("warnings"), "lineage.source_file_path", "lineage.source_file_sha256", F.col("volume").cast("long").alias("volume"))
    none = lambda kind: F.lit(None).cast(kind)
    bad = errors.select("file", "row_number", F.lit("FAIL").alias("normalization_status"), "code", none("string").alias("underlying_symbol"), none("date").alias("expiration_date"), none("string").alias("option_type"), none("double").alias("strike"), F.lit("").alias("warnings"), none("string").alias("source_file_path"), none("string").alias("source_file_sha256"), none("long").alias("volume"))
    return good.unionByName(bad)


OPTION_GATE_SQL = f"""
WITH base AS (SELECT p_partkey AS row_number, 'f' || (p_partkey % 97) AS file, {_TICKER} AS ticker, p_partkey % 10 = 0 AS upside_down, p_size, p_partkey % 83 = 0 AS a, p_partkey % 103 = 0 AND p_partkey % 83 <> 0 AS b, p_partkey FROM part),
cut AS (SELECT *, CASE WHEN ticker LIKE 'O:%' THEN ticker[3:] ELSE ticker END AS plain FROM base),
ends AS (SELECT *, plain[-15:] AS tail, plain[:-16] AS root FROM cut),
typed AS (SELECT *, length(plain) < 15 AS short, regexp_full_match(tail, '[0-9]{{6}}[CP][0-9]{{8}}') AND root <> '' AS shaped FROM ends),
dated AS (SELECT *, CASE WHEN NOT short AND shaped THEN try_cast('20' || tail[1:2] || '-' || tail[3:4] || '-' || tail[5:6] AS DATE) END AS day FROM typed),
told AS (SELECT *, CASE WHEN short THEN 'symbol too short' WHEN NOT shaped THEN 'symbol format not recognized' WHEN day IS NULL THEN 'symbol parse failed' END AS why, bool_or(a OR b) OVER (PARTITION BY file) AS failed FROM dated)
SELECT file, row_number, CASE WHEN failed THEN 'FAIL' ELSE 'PASS' END AS normalization_status, CASE WHEN a THEN 'NEGATIVE_VOLUME' WHEN b THEN 'NEGATIVE_TRANSACTIONS' END AS code,
    CASE WHEN why IS NULL AND NOT a AND NOT b THEN root END AS underlying_symbol, CASE WHEN why IS NULL AND NOT a AND NOT b THEN day END AS expiration_date, CASE WHEN why IS NULL AND NOT a AND NOT b THEN tail[7:7] END AS option_type,
    CASE WHEN why IS NULL AND NOT a AND NOT b THEN CAST(tail[8:] AS DOUBLE) / 1000 END AS strike,
    CASE WHEN a OR b THEN '' ELSE concat_ws('; ', CASE WHEN why IS NOT NULL THEN 'row ' || row_number || ': ' || why END, CASE WHEN upside_down THEN 'row ' || row_number || ': high lower than low' END) END AS warnings,
    CASE WHEN NOT a AND NOT b THEN 'quarantine/' || file END AS source_file_path, CASE WHEN NOT a AND NOT b AND file <> 'f3' THEN sha256(file) END AS source_file_sha256,
    CASE WHEN a OR b THEN NULL WHEN p_partkey % 7 = 0 THEN 0 ELSE p_size END AS volume
FROM told
"""
_MONTHS = Recipe().add(k="CAST(substr(symbol, 2) AS BIGINT)", m=("date_format(trade_date, 'yyyy-MM')", "strftime(trade_date, '%Y-%m')"))
_ROWS_OF_MONTHS = Recipe().pick(
    "symbol", "trade_date", batch="m", file_day="CASE WHEN k = 7 AND day(trade_date) = 3 AND month(trade_date) = 4 THEN trade_date + INTERVAL '1' DAY ELSE trade_date END",
    code="CASE WHEN k = 5 AND day(trade_date) = 4 AND month(trade_date) = 5 THEN 'INVALID_OHLC' WHEN k = 6 AND day(trade_date) = 6 AND month(trade_date) = 6 THEN 'ODD_VALUE' WHEN k = 8 AND day(trade_date) = 7 AND month(trade_date) = 8 THEN 'REQUIRED_VALUE_MISSING' END",
    adjusted="CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END",
)
_BATCHES_OF_MONTHS = Recipe().group(["m"], n="count(*)").add(month="CAST(substr(m, 6) AS BIGINT)").pick(
    batch="m", vendor="'polygon'", asset_class="'equity'", dataset_version="'v1'", source_file_sha256="CASE WHEN month = 1 THEN ' ' ELSE m END", validation_status="CASE month WHEN 2 THEN NULL WHEN 3 THEN 'FAIL' ELSE 'PASS' END", certification_status="CASE month WHEN 9 THEN NULL WHEN 10 THEN 'FIXTURE_ONLY' ELSE 'CERTIFIED' END",
)
HANDOFF_ROWS, HANDOFF_BATCHES = (views.BARS.then(_MONTHS).then(x) for x in (_ROWS_OF_MONTHS, _BATCHES_OF_MONTHS))


def handoff_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # rows, their counts and their batches are taken from the same bars, which are made once
    path = folder(spark)
    views.BARS.then(_MONTHS).apply(table(spark, sf_dir, "lineitem")).select("symbol", "trade_date", "k", "m").write.parquet(path)
    bars = spark.read.parquet(path)
    rows = _ROWS_OF_MONTHS.apply(bars).withColumn("file_day", F.col("file_day").cast("date"))
    out = batch_gate.handoff(rows, _BATCHES_OF_MONTHS.apply(bars))
    return out.groupBy("batch", "handoff_status", F.array_join("batch_errors", ",").alias("batch_errors"), "row_errors", "n_rows").agg(F.count("*").alias("records"), F.min("idempotency_key").alias("first_key"))


HANDOFF_SQL = f"""
WITH rows AS (SELECT *, coalesce(code, CASE WHEN trade_date IS DISTINCT FROM CAST(file_day AS DATE) THEN 'TRADE_DATE_MISMATCH' END) AS why FROM {HANDOFF_ROWS.sql('lineitem')}),
batches AS (SELECT * FROM {HANDOFF_BATCHES.sql('lineitem')}),
counts AS (SELECT batch, count(why) AS row_errors, count(*) AS n_rows, coalesce(bool_or(why = 'INVALID_OHLC' OR why LIKE 'REQUIRED\\_%' ESCAPE '\\'), false) AS blocking FROM rows GROUP BY batch),
gate AS (
    SELECT b.*, row_errors, n_rows, concat_ws(',', CASE WHEN trim(source_file_sha256) = '' THEN 'HANDOFF_BLOCKED_CHECKSUM_MISSING' END, CASE WHEN certification_status IS NULL THEN 'HANDOFF_BLOCKED_CERTIFICATION_MISSING' END,
        CASE WHEN certification_status = 'FIXTURE_ONLY' THEN 'HANDOFF_BLOCKED_FIXTURE_ONLY' END, CASE WHEN validation_status IS DISTINCT FROM 'PASS' OR blocking THEN 'HANDOFF_BLOCKED_VALIDATION_FAILED' END) AS batch_errors
    FROM batches b JOIN counts USING (batch)
)
SELECT r.batch, CASE WHEN batch_errors <> '' THEN 'BLOCKED' WHEN row_errors > 0 THEN 'FAIL' ELSE 'PASS' END AS handoff_status, batch_errors, row_errors, n_rows, count(*) AS records,
    min(sha256(concat_ws('|', 'polygon', 'equity', upper(symbol), CAST(trade_date AS VARCHAR), 'v1', source_file_sha256, CASE WHEN adjusted THEN 'adjusted' WHEN NOT adjusted THEN 'unadjusted' ELSE 'unknown_or_vendor_default' END))) AS first_key
FROM rows r JOIN gate g ON g.batch = r.batch WHERE why IS NULL GROUP BY ALL
"""


def weekly_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts of the weeks against those with a session, by month; some weeks are written twice, some never."""
    lines, path = table(spark, sf_dir, "lineitem"), folder(spark)
    bars = ARTIFACTS.apply(lines)
    artifacts.write_days(bars, path)
    artifacts.write_days(bars.where("day(trade_date) < 8").withColumn("volume", F.col("volume") * 2), path)
    due = sessions.sessions(lines, "l_shipdate").where("is_open").select(F.date_trunc("week", "day").cast("date").alias("day"))
    out = artifacts.batch_manifest(artifacts.summaries(spark, path), due)
    return out.withColumn("missing_days", F.array_join(F.transform("missing_days", lambda d: d.cast("string")), ","))


ARTIFACTS = views.NAMED_BARS.add(week="CAST(date_trunc('week', trade_date) AS DATE)").where("day(week) % 13 <> 0").pick("symbol", "close", "volume", trade_date="week")
ARTIFACTS_SQL = f"""
WITH {_SESSIONS_SQL.format(column='l_shipdate', table='lineitem', special=_SPECIAL)},
found AS (SELECT trade_date AS day, count(*) AS n_rows FROM {ARTIFACTS.sql('lineitem')} GROUP BY 1),
due AS (SELECT DISTINCT CAST(date_trunc('week', day) AS DATE) AS day FROM calendar WHERE is_open),
both_sides AS (SELECT coalesce(d.day, f.day) AS day, d.day IS NOT NULL AS is_due, f.n_rows FROM due d FULL JOIN found f ON f.day = d.day),
monthly AS (
    SELECT strftime(day, '%Y-%m') AS batch, count(*) FILTER (WHERE is_due) AS due, count(*) FILTER (WHERE is_due AND n_rows > 0) AS found, count(*) FILTER (WHERE NOT is_due) AS extra,
        coalesce(string_agg(CASE WHEN is_due AND n_rows IS NULL THEN CAST(day AS VARCHAR) END, ',' ORDER BY day), '') AS missing_days, CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_rows
    FROM both_sides GROUP BY 1
)
SELECT *, CASE WHEN missing_days = '' THEN 'COMPLETE' WHEN found > 0 THEN 'PARTIAL' ELSE 'MISSING' END AS status FROM monthly
"""


def register(c: Catalog) -> None:
    c.plan("weekly_artifacts", weekly_artifacts, ARTIFACTS_SQL)
    c.plan("evidence_chains", evidence_chains, CHAINS_SQL)
    c.plan("exchange_sessions", exchange_sessions, SESSIONS_SQL)
    c.plan("missing_sessions", missing_sessions, MISSING_SQL)
    c.plan("option_gate", option_gate, OPTION_GATE_SQL)
    c.plan("handoff_gate", handoff_gate, HANDOFF_SQL)
