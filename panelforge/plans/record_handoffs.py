"""Queries of handoff records: orders become JSON records of news, breadth and options, some fields of which are broken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import observation_rules as r
from panelforge.operators import record_handoff as h
from panelforge.plans.catalog import Catalog
from panelforge.plans.observations import _text, _values
from panelforge.sources.views import table

#: A sound value of each kind, as JSON, and of fields that need their own.
_SOUND = {"absent": "", "time": '"2024-01-02T03:04:05Z"', "count": "4", "numeric_between": '"0.5"', "object": "{}", "number_if_set": "0.5", "positive_or_zero_if_set": "10.5"}
_OWN = {"observed_symbol_count": "12", "url": '"https://x.org/a"', "canonical_url": "null", "source_file_path": '"in/a.csv"', "collected_at": '"2024-01-02 03:05:00"', "vendor_article_id": "@id", "news_id": "null", "breadth_score": "", "advance_decline_line": "null"}
#: What a broken field holds; the first stands for a field that is not there.
_BROKEN = ["", "null", '" "', "-3", "true", "[]", "2.5", '"ftp://x/y"', '"http://x/?api_key=1"', '"2023-12-31"', '"2024-13-01T00:00:00"', '"0.25"', '"9"', '"file:/a"', "7"]
_EXTRA = {"news": ("vendor_article_id", "news_id"), "breadth": ("breadth_score", "advance_decline_line")}


def _fields() -> list[tuple[str, int, str, str]]:
    sound: dict[tuple[str, str], str] = {}
    for domain, _, kind, field, *_ in r.rules(h.LISTED):
        if (domain, field) not in sound or kind not in ("present", "text", "no_secret"):
            sound[domain, field] = _OWN.get(field, _SOUND.get(kind, '"text"'))
    for domain, fields in _EXTRA.items():
        sound |= {(domain, f): _OWN[f] for f in fields}
    sound |= {(d, "source_dataset"): f'"{d}"' for d in h.OPTION_FIELDS}
    return [(d, k, f, v) for k, ((d, f), v) in enumerate(sound.items())]


_DOMAINS = ["news", "breadth", *h.OPTION_FIELDS]
_M = f"(o_orderkey * 11 + number * 17) % {len(_BROKEN) * 16}"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, kind, record of each order."""
    domains = spark.createDataFrame(list(enumerate(_DOMAINS)), "place int, domain string")
    fields = spark.createDataFrame(_fields(), "domain string, number int, field string, sound string").groupBy("domain").agg(F.sort_array(F.collect_list(F.struct("number", "field", "sound"))).alias("fields"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(f"CAST(pmod(o_orderkey DIV 2 + o_custkey, {len(_DOMAINS)}) AS INT)").alias("place"))
    rows = orders.join(F.broadcast(domains.join(fields, "domain")), "place")
    broken = "array(" + ", ".join(_text(b) for b in _BROKEN) + ")"
    m = _M.replace("number", "x.number")
    value = f"CASE WHEN {m} < {len(_BROKEN)} THEN {broken}[CAST({m} AS INT)] WHEN x.sound = '@id' THEN concat('\"a', o_orderkey, '\"') ELSE x.sound END"
    body = f"concat('{{', array_join(transform(filter(transform(fields, x -> named_struct('f', x.field, 'v', {value})), y -> y.v <> ''), y -> concat('\"', y.f, '\":', y.v)), ','), '}}')"
    record = f"CASE WHEN o_orderkey % 89 = 0 THEN '\"text\"' WHEN o_orderkey % 97 = 0 THEN '{{' ELSE {body} END"
    return rows.select(F.col("o_orderkey").alias("seq"), F.when(F.col("domain").startswith("options"), "options").otherwise(F.col("domain")).alias("kind"), F.expr(record).alias("record"))


def record_handoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = h.judge_records(records(spark, sf_dir), r.rules_table(spark, h.LISTED))
    return told.select("seq", "kind", F.array_join("reasons", "; ").alias("reasons"), F.array_join("warnings", "; ").alias("warnings"), "accepted", "idempotency_key")


def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines received, parsed, accepted and rejected, and rows of each reason, by kind."""
    told = h.judge_records(records(spark, sf_dir), r.rules_table(spark, h.LISTED))
    # a row for the record itself stands before those of its reasons, so that records are judged in one pass
    rows = told.select("kind", "accepted", F.explode(F.concat(F.array(F.lit("")), "reasons")).alias("reason"))
    return rows.groupBy("kind", "reason").agg(F.count("*").alias("n"), F.count(F.when((F.col("reason") == "") & F.col("accepted"), 1)).alias("accepted"))


_SECRET = "(apikey|api_key|token|secret|password|passwd|bearer |x-api-key)"
_NUL = lambda parts: " || ".join(f"coalesce({p}, '') || chr(0)" for p in parts)
_SAFE = lambda f: f"CASE WHEN json_type(record, '$.{f}') = 'VARCHAR' THEN nullif(trim(json_extract_string(record, '$.{f}')), '') END"
_RAW = lambda f: f"CASE WHEN json_type(record, '$.{f}') = 'VARCHAR' THEN json_extract_string(record, '$.{f}') END"
_COUNT = lambda f: f"CASE WHEN json_type(record, '$.{f}') IN ('BIGINT', 'UBIGINT') THEN try_cast(json_extract_string(record, '$.{f}') AS BIGINT) END"
_TOLD_SQL = f"""
fields AS (SELECT * FROM (VALUES {_values(_fields())}) f(domain, number, field, sound)),
domains AS (SELECT unnest(range(0, {len(_DOMAINS)})) AS place, unnest([{', '.join(map(_text, _DOMAINS))}]) AS domain),
filled AS (
    SELECT o_orderkey, domain, number, field, CASE WHEN {_M} < {len(_BROKEN)} THEN [{', '.join(map(_text, _BROKEN))}][{_M} + 1] WHEN sound = '@id' THEN '"a' || o_orderkey || '"' ELSE sound END AS v
    FROM orders JOIN domains ON place = (o_orderkey // 2 + o_custkey) % {len(_DOMAINS)} JOIN fields USING (domain)
),
bodies AS (SELECT o_orderkey AS seq, domain, '{{' || coalesce(string_agg(CASE WHEN v <> '' THEN '"' || field || '":' || v END, ',' ORDER BY number), '') || '}}' AS body FROM filled GROUP BY ALL),
records AS (SELECT seq, CASE WHEN domain LIKE 'options%' THEN 'options' ELSE domain END AS kind, CASE WHEN seq % 89 = 0 OR seq % 97 = 0 THEN NULL ELSE body END AS record FROM bodies),
owned AS (SELECT *, CASE kind WHEN 'options' THEN nullif({_RAW('source_dataset')}, '') ELSE kind END AS domain FROM records),
rules AS (SELECT * FROM (VALUES {_values(r.rules(h.LISTED))}) r(domain, number, kind, field, message, severity, low, high, allowed)),
met AS (
    SELECT o.seq, r.*, json_type(o.record, '$.' || r.field) AS t, json_extract_string(o.record, '$.' || r.field) AS s FROM owned o JOIN rules r ON r.domain = o.domain WHERE o.record IS NOT NULL
),
broken AS (
    SELECT seq, number, message FROM met WHERE CASE kind
        WHEN 'absent' THEN t IS NOT NULL
        WHEN 'present' THEN t IS NULL
        WHEN 'text' THEN t IS DISTINCT FROM 'VARCHAR' OR trim(s) = ''
        WHEN 'time' THEN t IS DISTINCT FROM 'VARCHAR' OR NOT regexp_matches(s, '^20[0-9][0-9]-(0[1-9]|1[0-2])-')
        WHEN 'no_secret' THEN t = 'VARCHAR' AND regexp_matches(s, '{_SECRET}')
        WHEN 'web_link' THEN t = 'VARCHAR' AND regexp_matches(s, '^(ftp|file):')
        WHEN 'local_path' THEN t = 'VARCHAR' AND (regexp_matches(s, '{_SECRET}') OR regexp_matches(s, '^(ftp|https?):'))
        WHEN 'numeric_if_set' THEN t IN ('ARRAY', 'OBJECT') OR t = 'VARCHAR' AND try_cast(s AS DOUBLE) IS NULL
        WHEN 'numeric_between' THEN t IN ('VARCHAR', 'DOUBLE', 'BIGINT', 'UBIGINT') AND try_cast(s AS DOUBLE) NOT BETWEEN low AND high
        WHEN 'count' THEN NOT coalesce(t = 'UBIGINT' OR t = 'BIGINT' AND try_cast(s AS BIGINT) >= 0, false)
        WHEN 'object' THEN t IS DISTINCT FROM 'OBJECT'
        WHEN 'number_if_set' THEN t NOT IN ('NULL', 'DOUBLE', 'BIGINT', 'UBIGINT')
        WHEN 'positive_or_zero_if_set' THEN t <> 'NULL' AND NOT (t IN ('DOUBLE', 'BIGINT', 'UBIGINT') AND try_cast(s AS DOUBLE) >= 0)
        ELSE error('unknown kind') END
    UNION ALL SELECT seq, 900, 'one of vendor_article_id, url, canonical_url, or news_id is required' FROM owned WHERE kind = 'news' AND record IS NOT NULL AND coalesce({', '.join(map(_SAFE, h.IDS))}) IS NULL
    UNION ALL SELECT seq, 901, 'observed_symbol_count must equal advancing_count + declining_count + unchanged_count' FROM owned
        WHERE kind = 'breadth' AND least({_COUNT('observed_symbol_count')}, {', '.join(map(_COUNT, h.PARTS))}) >= 0 AND {_COUNT('observed_symbol_count')} <> {' + '.join(map(_COUNT, h.PARTS))}
    UNION ALL SELECT seq, 902, 'missing domain' FROM owned WHERE kind = 'options' AND record IS NOT NULL AND domain IS NULL
    UNION ALL SELECT seq, 903, 'unsupported domain: ' || domain FROM owned WHERE domain NOT IN (SELECT domain FROM rules)
    UNION ALL SELECT seq, 904, 'row must be an object' FROM owned WHERE record IS NULL
),
once AS (SELECT seq, message, min(number) AS number FROM broken GROUP BY seq, message),
told AS (
    SELECT o.seq, o.kind, o.record, (SELECT string_agg(message, '; ' ORDER BY number) FROM once w WHERE w.seq = o.seq) AS reasons,
        CASE WHEN kind = 'news' AND try_cast(replace({_SAFE('collected_at')}, 'Z', '') AS TIMESTAMP) < try_cast(replace({_SAFE('published_at')}, 'Z', '') AS TIMESTAMP) THEN 'collected_at is earlier than published_at'
            WHEN kind = 'breadth' AND (json_type(record, '$.breadth_score') <> 'NULL' OR json_type(record, '$.advance_decline_line') <> 'NULL') THEN 'derived breadth metrics retained only in metadata when present' ELSE '' END AS warnings
    FROM owned o
)
"""
HANDOFFS_SQL = f"""
WITH {_TOLD_SQL}
SELECT seq, kind, coalesce(reasons, '') AS reasons, warnings, reasons IS NULL AS accepted,
    CASE WHEN reasons IS NOT NULL THEN NULL
        WHEN kind = 'news' THEN sha256({_NUL([_SAFE('vendor'), _SAFE('source_dataset'), _SAFE('vendor_article_id'), f"coalesce({_SAFE('canonical_url')}, {_SAFE('url')})", f"strftime(CAST(replace({_SAFE('published_at')}, 'Z', '') AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S+00:00')"])})
        WHEN kind = 'breadth' THEN sha256({_NUL([_RAW(f) for f in ('source_vendor', 'source_dataset', 'source_sha256', 'observation_date', 'universe_key', 'schema_version')])}) END AS idempotency_key
FROM told
"""
COUNTS_SQL = f"""
WITH {_TOLD_SQL}
SELECT kind, '' AS reason, count(*) AS n, count(*) FILTER (WHERE reasons IS NULL) AS accepted FROM told GROUP BY kind
UNION ALL SELECT kind, message, count(*), 0 FROM once JOIN told USING (seq) GROUP BY kind, message
"""


def register(c: Catalog) -> None:
    c.plan("record_handoffs", record_handoffs, HANDOFFS_SQL)
    c.plan("record_counts", record_counts, COUNTS_SQL)
