"""Queries of delivered files: digests against manifests, listings with sizes, numbered lines, rows of certified files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.plans.catalog import Catalog
from panelforge.plans.recipe import Recipe
from panelforge.sources import evidence, views
from panelforge.sources.files import folder
from panelforge.sources.views import table

#: Lines of daily files by month, in the order of their files.
LINES = views.NAMED_BARS.add(month=("date_format(trade_date, 'yyyy-MM')", "strftime(trade_date, '%Y-%m')")).pick(
    "month", "symbol", "trade_date", line="concat(CAST(trade_date AS STRING), ',', symbol, ',', CAST(CAST(volume AS BIGINT) AS STRING), ',', CAST(CAST(transactions AS BIGINT) AS STRING))"
)


def _write(lines: DataFrame, path: str, order: str = "line") -> None:
    """A text file in a folder for each month, lines in order."""
    lines.repartition("month").sortWithinPartitions("month", order).select("month", F.col("line").alias("value")).write.partitionBy("month").text(path)


def _delivery(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A folder of delivered files and the manifest of what was sent: some files changed, some lost, some unannounced."""
    sent, delivered = folder(spark), folder(spark)
    lines = LINES.apply(table(spark, sf_dir, "lineitem"))
    _write(lines, sent)
    changed = F.when(F.col("month").like("%-03") & (F.dayofmonth("trade_date") == 9), F.concat("line", F.lit("0"))).otherwise(F.col("line"))
    _write(lines.where("month NOT LIKE '%-05'").withColumn("line", changed), delivered)
    name = F.element_at(F.split("file", "/"), 1).alias("file")
    manifest = evidence.digests(spark, sent, "part-*").select(name, "size", "sha256").where("file NOT LIKE '%-07'")
    return delivered, manifest


def file_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered, manifest = _delivery(spark, sf_dir)
    found = evidence.digests(spark, delivered, "part-*").withColumn("file", F.element_at(F.split("file", "/"), 1))
    return evidence.against_manifest(found, manifest)


_FILES_SQL = f"""
lines AS (SELECT * FROM {LINES.sql('lineitem')}),
sent AS (SELECT 'month=' || month AS file, string_agg(line, chr(10) ORDER BY line) || chr(10) AS body FROM lines WHERE month NOT LIKE '%-07' GROUP BY month),
got_lines AS (SELECT month, trade_date, symbol, CASE WHEN month LIKE '%-03' AND day(trade_date) = 9 THEN line || '0' ELSE line END AS line FROM lines WHERE month NOT LIKE '%-05'),
got AS (SELECT 'month=' || month AS file, string_agg(line, chr(10) ORDER BY line) || chr(10) AS body FROM got_lines GROUP BY month),
told AS (
    SELECT coalesce(g.file, s.file) AS file, strlen(g.body) AS size, sha256(g.body) AS sha256, strlen(s.body) AS stated_size, sha256(s.body) AS stated_sha256,
        CASE WHEN g.file IS NULL THEN 'missing_file' WHEN s.file IS NULL THEN 'unlisted_file' WHEN g.body <> s.body THEN 'checksum_mismatch' ELSE 'PASS' END AS status
    FROM got g FULL JOIN sent s ON g.file = s.file
)
"""


def certified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files whose digest is the manifest's, with the file's lineage; the others' rows are counted as rejected."""
    delivered, manifest = _delivery(spark, sf_dir)
    found = evidence.digests(spark, delivered, "part-*").withColumn("file", F.element_at(F.split("file", "/"), 1))
    status = evidence.against_manifest(found, manifest).select("file", "sha256", "status")
    lines = evidence.numbered_lines(spark, delivered).withColumn("file", F.element_at(F.split("source_file", "/"), -2))
    cells = F.split("value", ",")
    rows = lines.select("file", "line_number", cells[0].alias("trade_date"), cells[1].alias("symbol"), cells[2].cast("long").alias("volume")).join(status, "file")
    lineage = F.sha2(F.concat_ws("|", "file", "sha256"), 256).alias("lineage_id")
    ok = F.col("status") == evidence.PASS
    return rows.groupBy("file", lineage, "status").agg(F.count(F.when(ok, 1)).alias("accepted"), F.count(F.when(~ok, 1)).alias("rejected"), F.max("line_number").alias("lines"), F.sum(F.when(ok, F.col("volume") * F.col("line_number"))).alias("weighted"))


CERTIFIED_SQL = f"""
WITH {_FILES_SQL},
numbered AS (SELECT 'month=' || month AS file, line, row_number() OVER (PARTITION BY month ORDER BY line) AS n FROM got_lines)
SELECT n.file, sha256(n.file || '|' || t.sha256) AS lineage_id, status, count(*) FILTER (WHERE status = 'PASS') AS accepted, count(*) FILTER (WHERE status <> 'PASS') AS rejected, max(n) AS lines,
    CAST(sum(CAST(split_part(line, ',', 3) AS BIGINT) * n) FILTER (WHERE status = 'PASS') AS BIGINT) AS weighted
FROM numbered n JOIN told t ON t.file = n.file GROUP BY ALL
"""


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that orders span, and whether and how large their file is."""
    delivered, _ = _delivery(spark, sf_dir)
    months = table(spark, sf_dir, "orders").select(F.concat(F.lit("month="), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM")).alias("file"))
    found = evidence.listing(spark, delivered, "part-*").withColumn("file", F.element_at(F.split("file", "/"), 1))
    return evidence.expected_files(months, found)


LISTING_SQL = f"""
WITH {_FILES_SQL}
SELECT m.file, g.file IS NOT NULL AS present, coalesce(strlen(g.body), 0) AS size
FROM (SELECT DISTINCT 'month=' || strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS file FROM orders) m LEFT JOIN got g ON g.file = m.file
"""
#: JSON lines by month, some of them broken, blank or no objects.
JSON_LINES = Recipe().add(day="CAST(o_orderdate AS DATE)").pick(
    "o_orderkey", month=("date_format(day, 'yyyy-MM')", "strftime(day, '%Y-%m')"),
    line="CASE o_orderkey % 19 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN '{\"k\":' WHEN 3 THEN '[1,2]' WHEN 4 THEN '\"text\"' WHEN 5 THEN 'k=1' ELSE concat('{\"k\":', CAST(o_orderkey AS STRING), ',\"status\":\"', o_orderstatus, '\"}') END",
)


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines and, with line number and error, the bad ones; good rows carry their number, vendor and a key of both."""
    path = folder(spark)
    _write(JSON_LINES.apply(table(spark, sf_dir, "orders")), path, "o_orderkey")
    good, bad = evidence.split_json_objects(evidence.numbered_lines(spark, path))
    month = F.regexp_extract("source_file", "month=([0-9-]+)", 1).alias("month")
    key = lambda text: F.sha2(F.concat_ws("|", F.lit("vendor"), month, "line_number", text), 256).alias("idempotency_key")
    kept = good.select(month, "line_number", F.lit(None).cast("string").alias("error"), F.expr("variant_get(record, '$.k', 'bigint')").alias("k"), key(F.expr("variant_get(record, '$.status', 'string')")))
    return kept.unionByName(bad.select(month, "line_number", "error", F.lit(None).cast("long").alias("k"), key(F.col("value"))))


QUARANTINED_SQL = f"""
WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY o_orderkey) AS n FROM {JSON_LINES.sql('orders')})
SELECT month, n AS line_number, CASE WHEN o_orderkey % 19 IN (2, 5) THEN 'malformed JSON' WHEN o_orderkey % 19 IN (3, 4) THEN 'not a JSON object' END AS error, CASE WHEN o_orderkey % 19 > 5 THEN o_orderkey END AS k,
    sha256('vendor|' || month || '|' || n || '|' || CASE WHEN o_orderkey % 19 > 5 THEN json_extract_string(line, '$.status') ELSE line END) AS idempotency_key
FROM numbered WHERE o_orderkey % 19 > 1
"""


def register(c: Catalog) -> None:
    c.plan("file_evidence", file_evidence, f"WITH {_FILES_SQL} SELECT * FROM told")
    c.plan("certified_rows", certified_rows, CERTIFIED_SQL)
    c.plan("file_listing", file_listing, LISTING_SQL)
    c.plan("quarantined_lines", quarantined_lines, QUARANTINED_SQL)
