"""Handoff, JSON-lines and event-window queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators import breadth, handoff
from panelforge.plans.catalog import Catalog
from panelforge.plans.recipe import Recipe, rounded
from panelforge.sources import files, views
from panelforge.sources.views import table
from panelforge.streaming.ingest import event_windows

NEWS_ROWS = views.ARTICLES.pick(
    article_id="CASE WHEN CAST(article_id AS BIGINT) % 23 = 0 THEN ' ' ELSE article_id END",
    source="source",
    published_at="published_at",
    category="CASE WHEN CAST(article_id AS BIGINT) % 29 = 0 THEN NULL ELSE category END",
    relevance_score="relevance_score * 1.05",
    sentiment_score="sentiment_score * 1.1",
    sentiment_label="CASE WHEN CAST(article_id AS BIGINT) % 3 = 0 THEN 'neutral' END",
    url="CASE CAST(article_id AS BIGINT) % 6 WHEN 0 THEN 'ftp://a/' || article_id WHEN 1 THEN 'https://a/?api_key=' || article_id WHEN 2 THEN NULL ELSE 'https://a/' || article_id END",
    collected_at="published_at + (CAST(article_id AS BIGINT) % 9 - 2) * INTERVAL '1' HOUR",
)
_LINE = Recipe().pick(
    source_file="source",
    value="CASE doc_id % 9 WHEN 0 THEN '  ' WHEN 1 THEN '{\"id\": ' || CAST(doc_id AS STRING) || ', \"lang\": \"' || lang WHEN 2 THEN '[1, 2]' ELSE '{\"id\": ' || CAST(doc_id AS STRING) || ', \"lang\": \"' || lang || '\"}' END",
)
_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("lang", T.StringType())])


def jsonl_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by file: objects, their least and greatest id, malformed ones."""
    good, bad = files.split_json_lines(_LINE.apply(table(spark, sf_dir, "documents")), _SCHEMA)
    good = good.groupBy("source_file").agg(F.count("*").alias("objects"), F.min("id").alias("least_id"), F.max("id").alias("greatest_id"), F.countDistinct("lang").alias("langs"))
    bad = bad.groupBy("source_file").agg(F.count("*").alias("malformed"))
    return good.join(bad, "source_file", "full").select("source_file", F.coalesce("objects", F.lit(0)).alias("objects"), "least_id", "greatest_id", F.coalesce("langs", F.lit(0)).alias("langs"), F.coalesce("malformed", F.lit(0)).alias("malformed"))


JSONL_SQL = f"""
WITH l AS (SELECT source_file, value, coalesce(try(json_valid(value)), false) AND starts_with(trim(value), '{{') AS ok FROM {_LINE.sql('documents')} WHERE length(trim(value)) > 0)
SELECT source_file, count(CASE WHEN ok THEN 1 END) AS objects, min(CASE WHEN ok THEN CAST(json_extract(value, '$.id') AS BIGINT) END) AS least_id,
       max(CASE WHEN ok THEN CAST(json_extract(value, '$.id') AS BIGINT) END) AS greatest_id,
       count(DISTINCT CASE WHEN ok THEN json_extract_string(value, '$.lang') END) AS langs, count(CASE WHEN NOT ok THEN 1 END) AS malformed
FROM l GROUP BY source_file
"""


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_windows(table(spark, sf_dir, "events")).withColumn("total", F.expr(rounded("total", 4)))


WINDOWS_SQL = f"SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n, {rounded('sum(value)', 4)} AS total FROM events GROUP BY ALL"


def register(c: Catalog) -> None:
    c.recipe("news_handoff_checks", "documents", NEWS_ROWS, handoff.NEWS, columns=handoff.NEWS_COLUMNS)
    c.recipe("breadth_handoff", "lineitem", views.NAMED_BARS, breadth.BREADTH, handoff.BREADTH)
    c.plan("jsonl_split", jsonl_split, JSONL_SQL)
    c.plan("event_windows", windows, WINDOWS_SQL)
