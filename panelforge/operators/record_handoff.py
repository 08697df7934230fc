"""Handoff records of news, breadth and options, as they arrive: JSON of any shape to reasons, warnings and keys.

Rules of single fields are rows of a table (``observation_rules``); what ties fields together stands here. An options
record is judged by the dataset that it names itself. Reasons are told once, in the order of the rules.

Defined cases: a record that is no object, or of no known kind, is rejected; only accepted records have a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators import observation_rules as r
from panelforge.operators.acceptance import OPTION_FIELDS

NEWS_TEXTS = "headline summary content_snippet language author image_url updated_at source_name source_domain raw_sentiment_label sentiment_source source_sha256 source_file_name"
#: What each field of a record must be, in the order in which reasons are told.
LISTED = [
    ("news", "absent", "buy_signal sell_signal bullish bearish regime_impact risk_posture portfolio_action", "=strategy fields are not allowed in ingestion handoff"),
    ("news", "time", "published_at collected_at", "is missing or invalid"),
    ("news", "text", "headline vendor source_dataset source_name source_domain producer_run_id source_sha256 source_file_name source_file_path", "is required"),
    ("news", "no_secret", f"url canonical_url source_file_path {NEWS_TEXTS}", "may hold a secret"),
    ("news", "web_link", "url canonical_url", "is unsafe"),
    ("news", "local_path", "source_file_path", "is unsafe"),
    ("news", "numeric_if_set", "relevance_score raw_sentiment_score", "must be numeric when provided"),
    ("news", "numeric_between", "relevance_score", "must be between 0 and 1 when provided", 0, 1),
    ("news", "numeric_between", "raw_sentiment_score", "must be between -1 and 1 when provided", -1, 1),
    ("breadth", "present", "observation_date universe_key source_vendor source_dataset source_sha256 observed_symbol_count advancing_count declining_count unchanged_count advancing_volume declining_volume new_high_count new_low_count generated_at schema_version metadata", "is required"),
    ("breadth", "text", "universe_key source_vendor source_dataset source_sha256 generated_at schema_version", r.TEXT),
    ("breadth", "object", "metadata", "must be an object"),
    ("breadth", "count", "observed_symbol_count advancing_count declining_count unchanged_count new_high_count new_low_count", "must be a non-negative integer", 0),
    ("breadth", "positive_or_zero_if_set", "advancing_volume declining_volume unchanged_volume", "must be a non-negative number when present"),
    ("breadth", "number_if_set", "percent_above_20d_ma percent_above_50d_ma percent_above_100d_ma percent_above_150d_ma percent_above_200d_ma", "must be numeric when present"),
    *[(name, "present", " ".join(fields), "is required") for name, fields in OPTION_FIELDS.items()],
]
IDS = ("vendor_article_id", "url", "canonical_url", "news_id")
PARTS = ("advancing_count", "declining_count", "unchanged_count")


def _kind(field: str) -> str:
    return f"schema_of_variant(_fields['{field}'])"


def _text(field: str) -> Column:
    """A field's trimmed text, null where it is blank or no text."""
    return F.expr(f"CASE WHEN {_kind(field)} = 'STRING' THEN nullif(trim(CAST(_fields['{field}'] AS STRING)), '') END")


def _number(field: str) -> Column:
    return F.expr(f"CASE WHEN {_kind(field)} = 'BIGINT' THEN CAST(_fields['{field}'] AS BIGINT) END")


def _iso(moment: Column) -> Column:
    micros = F.date_format(moment, "SSSSSS")
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""), F.lit("+00:00"))


def _ended(*parts: Column) -> Column:
    """Digest of the parts, each ended by NUL."""
    return F.sha2(F.concat(*[x for p in parts for x in (F.coalesce(p, F.lit("")), F.expr("char(0)"))]), 256)


def judge_records(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows (kind: news, breadth or options, record) with reasons, warnings, accepted and idempotency_key."""
    columns = rows.columns
    named = F.expr("variant_get(CASE WHEN schema_of_variant(try_parse_json(record)) LIKE 'OBJECT%' THEN try_parse_json(record) END, '$.source_dataset')")
    dataset = F.expr("CASE WHEN schema_of_variant(_dataset) = 'STRING' THEN nullif(CAST(_dataset AS STRING), '') END")
    domain = F.when(F.col("kind") == "options", dataset).otherwise(F.col("kind"))
    told = r.judge(rows.withColumn("_dataset", named).withColumn("_domain_of", domain), table, domain="_domain_of")
    news, breadth, options = (F.col("kind") == k for k in ("news", "breadth", "options"))
    known = F.col("_domain_of").isin(*{x[0] for x in LISTED})
    moments = [F.expr(f"try_cast(trim(CASE WHEN {_kind(f)} = 'STRING' THEN CAST(_fields['{f}'] AS STRING) END) AS TIMESTAMP)") for f in ("published_at", "collected_at")]
    counts = [_number(f) for f in ("observed_symbol_count", *PARTS)]
    sound = F.coalesce(counts[0] >= 0, F.lit(False))
    for c in counts[1:]:
        sound = sound & F.coalesce(c >= 0, F.lit(False))
    more = [
        F.when(news & F.col("_fields").isNotNull() & F.coalesce(*[_text(f) for f in IDS]).isNull(), "one of vendor_article_id, url, canonical_url, or news_id is required"),
        F.when(breadth & sound & (counts[0] != counts[1] + counts[2] + counts[3]), "observed_symbol_count must equal advancing_count + declining_count + unchanged_count"),
        F.when(options & F.col("_fields").isNotNull() & F.col("_domain_of").isNull(), "missing domain"),
        F.when(~F.coalesce(known, F.lit(True)), F.concat(F.lit("unsupported domain: "), F.col("_domain_of"))),
        F.when(F.col("_fields").isNull(), "row must be an object"),
    ]
    reasons = F.array_distinct(F.concat(F.transform("errors", lambda e: e["message"]), F.array_compact(F.array(*more))))
    derived = F.lit(False)
    for f in ("advance_decline_line", "breadth_score", "participation_score"):
        derived = derived | F.coalesce(F.expr(f"{_kind(f)} <> 'VOID'"), F.lit(False))
    warnings = F.array_compact(F.array(F.when(news & (moments[1] < moments[0]), "collected_at is earlier than published_at"), F.when(breadth & derived, "derived breadth metrics retained only in metadata when present")))
    key = F.when(news, _ended(_text("vendor"), _text("source_dataset"), _text("vendor_article_id"), F.coalesce(_text("canonical_url"), _text("url")), _iso(moments[0])))
    key = key.when(breadth, _ended(*[F.expr(f"CASE WHEN {_kind(f)} = 'STRING' THEN CAST(_fields['{f}'] AS STRING) END") for f in ("source_vendor", "source_dataset", "source_sha256", "observation_date", "universe_key", "schema_version")]))
    told = told.withColumn("reasons", reasons).withColumn("warnings", warnings).withColumn("accepted", F.size("reasons") == 0)
    return told.withColumn("idempotency_key", F.when(F.col("accepted"), key)).select(*columns, "reasons", "warnings", "accepted", "idempotency_key")
