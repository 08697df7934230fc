"""Queries of committed loads and of the stateful stream over the raw bars of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import loads, normalize, quality
from panelforge.plans.catalog import Catalog
from panelforge.plans.ingestion import TYPED
from panelforge.sources import views
from panelforge.sources.files import folder
from panelforge.sources.views import table
from panelforge.streaming import dedupe

FIRST, SECOND = "trade_date IS NULL OR trade_date < DATE '1996-01-01'", "trade_date IS NULL OR trade_date < DATE '1997-07-01'"
CORRECTED = "day(trade_date) = 10 AND (trade_date < DATE '1996-01-01' OR trade_date >= DATE '1998-01-01')"
START = "1993-01-01"
#: Files of a year at most, so that one batch takes them all; each is written by a task of its own.
PARTS = 64


def _loaded(spark: SparkSession, sf_dir: str) -> str:
    """A folder of tables after four loads, the second of which died twice and was run again."""
    root = folder(spark)
    # every load takes its part of the same typed rows, which are made once
    typed = f"{folder(spark)}/typed"
    TYPED.apply(table(spark, sf_dir, "lineitem")).write.parquet(typed)
    rows = spark.read.parquet(typed)
    loads.load(rows.where(FIRST), root, "l1", "2024-01-01", START)
    for end in ("bars", "checkpoints", None):
        try:
            loads.load(rows.where(SECOND), root, "l2", "2024-01-02", START, end_after=end)
        except loads.Killed:
            continue
    loads.load(rows.where(CORRECTED).withColumn("volume", F.col("volume") + 1), root, "l3", "2024-01-03", START, resume=False)
    loads.load(rows.where(SECOND), root, "l4", "2024-01-04", START)
    return root


def committed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and volume by symbol, month and the loads that made them."""
    bars = loads.read_bars(spark, _loaded(spark, sf_dir))
    return bars.groupBy("symbol", "month", "created_load", "created_at", "load", "updated_at").agg(F.count("*").alias("n"), F.expr("CAST(sum(volume) AS BIGINT)").alias("volume"))


def load_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs, failed rules, lineage and checkpoints of all loads."""
    root = _loaded(spark, sf_dir)
    numbers = lambda *names: F.concat_ws(",", *names)
    row = lambda name, key, status, day, counts: loads.read_state(spark, root, name).select(F.lit(name).alias("kind"), "load", key.alias("name"), status.alias("status"), day.cast("string").alias("day"), counts.alias("counts"))
    none = F.lit(None).cast("string")
    out = row("runs", F.col("dataset"), F.col("status"), F.col("at"), numbers("received", "fresh", "written", "inserted", "updated", "completed", "skipped", "failed"))
    out = out.unionByName(row("quality", F.col("rule"), none, none, numbers("failed")))
    out = out.unionByName(row("lineage", F.col("symbol"), none, F.col("last_day"), numbers("rows")))
    return out.unionByName(row("checkpoints", F.col("symbol"), F.col("status"), F.col("last_success"), F.lit("")))


_FAILED = ", ".join(f"count(CASE WHEN {e} THEN 1 END) AS {rule}" for rule, e in quality.BAR_RULES.items())
_FIRST_VALID = "SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_date, timeframe, adjusted ORDER BY seq) AS place FROM {rows} WHERE valid) WHERE place = 1"
_LOADS_SQL = f"""
src AS MATERIALIZED (SELECT * FROM {TYPED.then(quality.CHECKED).sql('lineitem')}),
r1 AS (SELECT *, trade_date IS NULL OR trade_date >= DATE '{START}' AS fresh FROM src WHERE {FIRST}),
w1 AS ({_FIRST_VALID.format(rows='(SELECT * FROM r1 WHERE fresh)')}),
c1 AS (SELECT symbol, max(trade_date) AS d FROM w1 GROUP BY symbol),
r2 AS (SELECT s.*, trade_date IS NULL OR (trade_date >= DATE '{START}' AND (d IS NULL OR trade_date > d)) AS fresh FROM src s LEFT JOIN c1 USING (symbol) WHERE {SECOND}),
w2 AS ({_FIRST_VALID.format(rows='(SELECT * FROM r2 WHERE fresh)')}),
r3 AS (SELECT * REPLACE (volume + 1 AS volume), trade_date >= DATE '{START}' AS fresh FROM src WHERE {CORRECTED}),
w3 AS ({_FIRST_VALID.format(rows='(SELECT * FROM r3 WHERE fresh)')}),
c3 AS (SELECT symbol, max(trade_date) AS d FROM (SELECT symbol, trade_date FROM w1 UNION ALL SELECT symbol, trade_date FROM w2 UNION ALL SELECT symbol, trade_date FROM w3) GROUP BY symbol),
r4 AS (SELECT s.*, trade_date IS NULL OR (trade_date >= DATE '{START}' AND (d IS NULL OR trade_date > d)) AS fresh FROM src s LEFT JOIN c3 USING (symbol) WHERE {SECOND}),
w4 AS ({_FIRST_VALID.format(rows='(SELECT * FROM r4 WHERE fresh)')}),
written AS (
    SELECT 'l1' AS load, '2024-01-01' AS stamp, * FROM w1 UNION ALL BY NAME SELECT 'l2' AS load, '2024-01-02' AS stamp, * FROM w2
    UNION ALL BY NAME SELECT 'l3' AS load, '2024-01-03' AS stamp, * FROM w3 UNION ALL BY NAME SELECT 'l4' AS load, '2024-01-04' AS stamp, * FROM w4
),
received AS (SELECT 'l1' AS load, * FROM r1 UNION ALL BY NAME SELECT 'l2' AS load, * FROM r2 UNION ALL BY NAME SELECT 'l3' AS load, * FROM r3 UNION ALL BY NAME SELECT 'l4' AS load, * FROM r4),
told AS (SELECT *, row_number() OVER k = 1 AS born FROM written WINDOW k AS (PARTITION BY symbol, trade_date, timeframe, adjusted ORDER BY load))
"""
BARS_SQL = f"""
WITH {_LOADS_SQL},
final AS (SELECT symbol, trade_date, arg_max(volume, load) AS volume, min(load) AS created_load, min(stamp) AS created_at, max(load) AS load, max(stamp) AS updated_at FROM told GROUP BY symbol, trade_date, timeframe, adjusted)
SELECT symbol, strftime(trade_date, '%Y-%m') AS month, created_load, created_at, load, updated_at, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM final GROUP BY ALL
"""
STATES_SQL = f"""
WITH {_LOADS_SQL},
symbols AS (SELECT load, symbol, count(*) AS received, count(*) FILTER (WHERE fresh) AS fresh FROM received GROUP BY load, symbol),
per AS (SELECT load, symbol, count(*) AS n, max(trade_date) AS last_day, count(*) FILTER (WHERE born) AS inserted FROM told GROUP BY load, symbol),
ended AS (SELECT s.*, n, last_day, inserted, CASE WHEN fresh = 0 THEN 'skipped_already_current' WHEN n IS NULL THEN 'failed' ELSE 'completed' END AS status FROM symbols s LEFT JOIN per p ON p.load = s.load AND p.symbol IS NOT DISTINCT FROM s.symbol),
runs AS (
    SELECT load, sum(received) AS a, sum(fresh) AS b, coalesce(sum(n), 0) AS c, coalesce(sum(inserted), 0) AS d, count(*) FILTER (WHERE status = 'completed') AS e, count(*) FILTER (WHERE status = 'skipped_already_current') AS f, count(*) FILTER (WHERE status = 'failed') AS g
    FROM ended GROUP BY load
),
failures AS (UNPIVOT (SELECT load, {_FAILED} FROM received WHERE fresh GROUP BY load) ON {', '.join(quality.BAR_RULES)} INTO NAME rule VALUE failed)
SELECT 'runs' AS kind, load, 'bars' AS name, CASE WHEN g = 0 THEN 'SUCCESS' WHEN e + f = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status, '2024-01-0' || substr(load, 2) AS day, concat_ws(',', a, b, c, d, c - d, e, f, g) AS counts FROM runs
UNION ALL SELECT 'quality', load, rule, NULL, NULL, CAST(failed AS VARCHAR) FROM failures
UNION ALL SELECT 'lineage', load, symbol, NULL, CAST(last_day AS VARCHAR), CAST(n AS VARCHAR) FROM ended WHERE n > 0
UNION ALL SELECT 'checkpoints', load, symbol, status, CAST(last_day AS VARCHAR), '' FROM ended
"""


#: Raw bars with the file of each row: its year's, but a day's every ninth row comes again in the next file if the day is late in
#: December, and some rows of January come two years late.
_FILES = (
    views.RAW_BARS.add(d="try_cast(date AS DATE)")
    .add(year="coalesce(CAST(year(d) AS INT), 1995)", late="coalesce(month(d) = 1 AND k % 5 = 0, false)", again="coalesce(month(d) = 12 AND day(d) > 10 AND k % 9 = 0, false)")
    .add(file="CASE WHEN late THEN year + 2 ELSE year END")
)
_RAW = ["ticker", "date", "open", "high", "low", "close", "volume", "transactions", "adjusted"]


def streamed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars by symbol and year of a stream that is stopped after each file; its late rows by a row of their own."""
    root = folder(spark)
    rows = _FILES.apply(table(spark, sf_dir, "lineitem"))
    rows = rows.select("file", *_RAW).unionByName(rows.where("again").select((F.col("file") + 1).alias("file"), *_RAW))
    rows.write.partitionBy("file").option("header", True).csv(f"{root}/files")
    years = sorted(r[0] for r in rows.select("file").distinct().collect())  # one row for each year
    late = 0
    for year in years:
        spark.read.option("header", True).schema(dedupe.RAW).csv(f"{root}/files/file={year}").coalesce(PARTS).write.mode("append").option("header", True).csv(f"{root}/inbox")
        late += dedupe.drain(spark, f"{root}/inbox", f"{root}/bars", f"{root}/rejected", f"{root}/checkpoint")
    bars = dedupe.accepted(spark, f"{root}/bars")
    out = bars.groupBy("symbol", F.year("trade_date").alias("year")).agg(F.count("*").alias("n"))
    bad = dedupe.rejected(spark, f"{root}/rejected").groupBy("reasons").agg(F.count("*").alias("n")).select(F.concat(F.lit("rejected: "), "reasons").alias("symbol"), F.lit(None).cast("int").alias("year"), "n")
    return out.unionByName(bad).unionByName(spark.range(1).select(F.lit("late").alias("symbol"), F.lit(None).cast("int").alias("year"), F.lit(late).cast("long").alias("n")))


#: A row is late if it comes two files after its year, and the file before holds days beyond its date and the lateness.
STREAM_SQL = f"""
WITH raw AS (SELECT * FROM {_FILES.sql('lineitem')}),
files AS (SELECT * FROM raw UNION ALL SELECT * REPLACE (file + 1 AS file) FROM raw WHERE again),
good AS (SELECT upper(symbol) AS symbol, trade_date, is_adjusted, file FROM {normalize.STOCK_DAY.sql('files')} WHERE accepted),
ends AS (SELECT file, max(trade_date) AS last FROM good GROUP BY file),
told AS (SELECT g.*, coalesce(g.trade_date < (SELECT max(last) FROM ends e WHERE e.file <= g.file - 2) - 30, false) AS late FROM good g)
SELECT symbol, CAST(year(trade_date) AS INT) AS year, count(DISTINCT (trade_date, is_adjusted)) AS n FROM told WHERE NOT late GROUP BY 1, 2
UNION ALL SELECT 'late', NULL, count(*) FROM told WHERE late
UNION ALL SELECT 'rejected: ' || reasons, NULL, count(*) FROM {normalize.STOCK_DAY.sql('files')} WHERE NOT accepted GROUP BY reasons
"""


def register(c: Catalog) -> None:
    c.plan("committed_bars", committed_bars, BARS_SQL)
    c.plan("load_states", load_states, STATES_SQL)
    c.plan("streamed_bars", streamed_bars, STREAM_SQL)
