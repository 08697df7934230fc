"""Queries of the observation rules: orders become JSON observations of all domains, some fields of which are broken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import observation_rules as r
from panelforge.plans.catalog import Catalog
from panelforge.sources.views import table

#: A sound value of each kind, as JSON.
_SOUND = {
    "positive": "12.5", "positive_if_set": "12.5", "between_if_number": "0.5", "number_if_set": "0.25", "count": "3", "count_or_flag": "3", "count_if_set": "3", "count_if_there": "3", "integer_if_set": "-2",
    "integer_or_flag_if_set": "4", "flag": "true", "flag_if_set": "false", "list": "[]", "list_if_there": '["SPY"]', "filled_list": '["SPY"]', "list_if_set": '["XLK","xlf "]', "object": '{"SPY":"UPTREND"}', "unset": "null",
}
#: What a broken field holds; the first stands for a field that is not there.
_BROKEN = ["", "null", '"x"', '" "', "-1.5", "0", "true", "[]", "{}", "7", '["XLK",3]', "2.0"]


def _fields() -> list[tuple[str, int, str, str]]:
    """(domain, number, field, sound JSON) of all fields that rules name; a field's last kind decides."""
    sound: dict[tuple[str, str], str] = {}
    for domain, _, kind, field, _, _, _, _, allowed in r.rules():
        value = f'"{allowed[0]}"' if allowed and kind != "list_if_set" else _SOUND.get(kind, '"text"')
        if (domain, field) not in sound or kind not in ("present", "filled", "text_if_there", "text"):
            sound[domain, field] = value
    sound = {k: {"symbol": "@symbol", "observation_date": "@date", "source": "@source"}.get(k[1], v) for k, v in sound.items()}
    return [(d, k, f, v) for k, ((d, f), v) in enumerate(sound.items())]


_DOMAINS = list(r.KEYS)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch, domain, seq, record of each order."""
    domains = spark.createDataFrame(list(enumerate(_DOMAINS)), "place int, domain string")
    fields = spark.createDataFrame(_fields(), "domain string, number int, field string, sound string").groupBy("domain").agg(F.sort_array(F.collect_list(F.struct("number", "field", "sound"))).alias("fields"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), F.expr(f"CAST(pmod(o_orderkey DIV 3 + o_custkey, {len(_DOMAINS)}) AS INT)").alias("place"))
    rows = orders.join(F.broadcast(domains.join(fields, "domain")), "place")
    broken = "array(" + ", ".join(f"'{b}'" for b in _BROKEN) + ")"
    sound = "CASE x.sound WHEN '@symbol' THEN concat('\"s', o_custkey % 9, '\"') WHEN '@date' THEN concat('\"', day, '\"') WHEN '@source' THEN concat('\"src', o_orderkey % 2, '\"') ELSE x.sound END"
    pair = f"transform(fields, x -> named_struct('f', x.field, 'v', CASE WHEN (o_orderkey * 7 + x.number * 13) % 311 < {len(_BROKEN)} THEN {broken}[CAST((o_orderkey * 7 + x.number * 13) % 311 AS INT)] ELSE {sound} END))"
    body = f"concat('{{', array_join(transform(filter({pair}, x -> x.v <> ''), x -> concat('\"', x.f, '\":', x.v)), ','), '}}')"
    record = f"CASE WHEN o_orderkey % 97 = 0 THEN '[1]' WHEN o_orderkey % 101 = 0 THEN '{{\"symbol\":' ELSE {body} END"
    return rows.select(F.expr("concat('b', o_custkey % 211)").alias("batch"), "domain", F.col("o_orderkey").alias("seq"), F.expr(record).alias("record"))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.accepted(r.with_duplicates(r.judge(observations(spark, sf_dir), r.rules_table(spark)).drop("record")))


def observation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each error; a later row of a key has the error of its duplicate last."""
    told = judged(spark, sf_dir)
    twice = F.array(F.struct(F.lit("duplicate").alias("code"), F.lit("batch_key").alias("field"), F.lit("duplicate batch key").alias("message"), F.lit("error").alias("severity")))
    all_errors = F.concat("errors", F.when(F.col("duplicate"), twice).otherwise(F.slice(twice, 1, 0)))
    return told.select("batch", "domain", "seq", F.posexplode(all_errors).alias("place", "e")).select("batch", "domain", "seq", F.col("place").cast("long").alias("place"), "e.*")


def observation_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, errors and what each domain's policy accepts, by batch and domain."""
    told = judged(spark, sf_dir).groupBy("batch", "domain", "policy")
    return told.agg(F.count("*").alias("n"), F.count(F.when(F.size("errors") > 0, 1)).alias("with_errors"), F.sum(F.size("errors").cast("long")).alias("errors"), F.count(F.when(F.col("duplicate"), 1)).alias("duplicates"), F.count(F.when(F.col("accepted"), 1)).alias("accepted"))


def _text(x: object) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"[{', '.join(map(_text, v))}]" if isinstance(v, list) else str(v) if isinstance(v, (int, float)) else _text(v) for v in row) + ")" for row in rows)


#: The same by joins of rows, fields and rules and DuckDB's JSON types; conditions written by hand.
_RECORDS_SQL = f"""
fields AS (SELECT * FROM (VALUES {_values(_fields())}) f(domain, number, field, sound)),
domains AS (SELECT unnest(range(0, {len(_DOMAINS)})) AS place, unnest([{', '.join(map(_text, _DOMAINS))}]) AS domain),
placed AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, domain FROM orders JOIN domains ON place = (o_orderkey // 3 + o_custkey) % {len(_DOMAINS)}),
filled AS (
    SELECT p.*, f.number, f.field, (o_orderkey * 7 + f.number * 13) % 311 AS m,
        CASE sound WHEN '@symbol' THEN '"s' || (o_custkey % 9) || '"' WHEN '@date' THEN '"' || day || '"' WHEN '@source' THEN '"src' || (o_orderkey % 2) || '"' ELSE sound END AS sound
    FROM placed p JOIN fields f USING (domain)
),
valued AS (SELECT *, CASE WHEN m < {len(_BROKEN)} THEN [{', '.join(map(_text, _BROKEN))}][m + 1] ELSE sound END AS v FROM filled),
bodies AS (SELECT o_orderkey, o_custkey, domain, '{{' || coalesce(string_agg(CASE WHEN v <> '' THEN '"' || field || '":' || v END, ',' ORDER BY number), '') || '}}' AS body FROM valued GROUP BY ALL),
records AS (
    SELECT 'b' || (o_custkey % 211) AS batch, domain, o_orderkey AS seq, CASE WHEN o_orderkey % 97 = 0 THEN '[1]' WHEN o_orderkey % 101 = 0 THEN '{{"symbol":' ELSE body END AS record FROM bodies
),
rules AS (SELECT * FROM (VALUES {_values(r.rules())}) r(domain, number, kind, field, message, severity, low, high, allowed)),
objects AS (SELECT *, coalesce(json_valid(record) AND json_type(CASE WHEN json_valid(record) THEN record ELSE 'null' END) = 'OBJECT', false) AS sound FROM records),
met AS (
    SELECT o.batch, o.domain, o.seq, r.*, json_type(o.record, '$.' || r.field) AS t, json_extract_string(o.record, '$.' || r.field) AS s, try_cast(json_extract_string(o.record, '$.' || r.field) AS DOUBLE) AS n, json_extract(o.record, '$.' || r.field) AS j
    FROM objects o JOIN rules r ON r.domain = o.domain WHERE o.sound
),
errors AS (
    SELECT batch, domain, seq, number, kind AS code, field, message, severity FROM met WHERE CASE
        WHEN kind = 'present' THEN t IS NULL
        WHEN kind = 'filled' THEN t IS NULL OR t = 'NULL' OR (t = 'VARCHAR' AND trim(s) = '')
        WHEN kind = 'unset' THEN t <> 'NULL'
        WHEN kind = 'text' THEN t IS DISTINCT FROM 'VARCHAR' OR trim(s) = ''
        WHEN kind = 'text_if_set' THEN t <> 'NULL' AND (t <> 'VARCHAR' OR trim(s) = '')
        WHEN kind = 'text_if_there' THEN t <> 'VARCHAR' OR trim(s) = ''
        WHEN kind = 'number_if_set' THEN t NOT IN ('NULL', 'DOUBLE', 'BIGINT', 'UBIGINT')
        WHEN kind = 'positive' THEN NOT coalesce(t IN ('DOUBLE', 'BIGINT', 'UBIGINT') AND n > 0, false)
        WHEN kind = 'positive_if_set' THEN t <> 'NULL' AND NOT (t IN ('DOUBLE', 'BIGINT', 'UBIGINT') AND n > 0)
        WHEN kind = 'between_if_number' THEN t IN ('DOUBLE', 'BIGINT', 'UBIGINT') AND n NOT BETWEEN low AND high
        WHEN kind = 'count' THEN NOT coalesce(t IN ('BIGINT', 'UBIGINT') AND n >= low, false)
        WHEN kind = 'count_if_set' THEN t <> 'NULL' AND NOT (t IN ('BIGINT', 'UBIGINT') AND n >= low)
        WHEN kind = 'count_if_there' THEN NOT (t IN ('BIGINT', 'UBIGINT') AND n >= low)
        WHEN kind = 'count_or_flag' THEN NOT coalesce((t IN ('BIGINT', 'UBIGINT') AND n >= low) OR (t = 'BOOLEAN' AND (s = 'true' OR low = 0)), false)
        WHEN kind = 'integer_if_set' THEN t NOT IN ('NULL', 'BIGINT', 'UBIGINT')
        WHEN kind = 'integer_or_flag_if_set' THEN t NOT IN ('NULL', 'BIGINT', 'UBIGINT', 'BOOLEAN')
        WHEN kind = 'flag' THEN t IS DISTINCT FROM 'BOOLEAN'
        WHEN kind = 'flag_if_set' THEN t NOT IN ('NULL', 'BOOLEAN')
        WHEN kind = 'list' THEN t IS DISTINCT FROM 'ARRAY'
        WHEN kind = 'list_if_there' THEN t <> 'ARRAY'
        WHEN kind = 'filled_list' THEN t IS DISTINCT FROM 'ARRAY' OR json_array_length(j) = 0
        WHEN kind = 'list_if_set' THEN t <> 'NULL' AND (t <> 'ARRAY' OR len(list_filter(CAST(CASE WHEN t = 'ARRAY' THEN j END AS JSON[]), lambda i: json_type(i) <> 'VARCHAR' OR NOT list_contains(allowed, upper(trim(i ->> '$'))))) > 0)
        WHEN kind = 'object' THEN t IS DISTINCT FROM 'OBJECT'
        WHEN kind = 'label' THEN NOT coalesce(t = 'VARCHAR' AND list_contains(allowed, s), false)
        WHEN kind = 'label_if_set' THEN t <> 'NULL' AND NOT (t = 'VARCHAR' AND list_contains(allowed, s))
        WHEN kind = 'symbol_if_set' THEN t = 'VARCHAR' AND trim(s) <> '' AND NOT list_contains(allowed, upper(trim(s)))
        ELSE error('unknown kind') END
    UNION ALL SELECT batch, domain, seq, 0, 'row', 'row', 'row must be an object', 'error' FROM objects WHERE NOT sound
),
keyed AS (
    SELECT o.batch, o.domain, o.seq, list(upper(trim(coalesce(CASE WHEN json_type(o.record, '$.' || k.field) IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST(CAST(json_extract_string(o.record, '$.' || k.field) AS DOUBLE) AS VARCHAR) ELSE json_extract_string(o.record, '$.' || k.field) END, ''))) ORDER BY k.place) AS key
    FROM objects o JOIN (SELECT domain, unnest(string_split(fields, ' ')) AS field, generate_subscripts(string_split(fields, ' '), 1) AS place FROM (VALUES {_values([(d, f) for d, (f, _) in r.KEYS.items()])}) k(domain, fields)) k USING (domain)
    WHERE o.sound GROUP BY o.batch, o.domain, o.seq
),
twice AS (SELECT batch, domain, seq FROM (SELECT *, row_number() OVER (PARTITION BY batch, domain, key ORDER BY seq) AS place FROM keyed) WHERE place > 1),
told AS (SELECT * FROM errors UNION ALL SELECT batch, domain, seq, 1000, 'duplicate', 'batch_key', 'duplicate batch key', 'error' FROM twice)
"""
ERRORS_SQL = f"WITH {_RECORDS_SQL} SELECT batch, domain, seq, row_number() OVER (PARTITION BY batch, domain, seq ORDER BY number) - 1 AS place, code, field, message, severity FROM told"
ACCEPTANCE_SQL = f"""
WITH {_RECORDS_SQL},
policies AS (SELECT * FROM (VALUES {_values([(d, p) for d, (_, p) in r.KEYS.items()])}) p(domain, policy)),
counted AS (
    SELECT o.batch, o.domain, policy, o.seq, (SELECT count(*) FROM errors e WHERE e.seq = o.seq) AS n, o.seq IN (SELECT seq FROM twice) AS again
    FROM objects o JOIN policies USING (domain)
)
SELECT batch, domain, policy, count(*) AS n, count(*) FILTER (WHERE c.n > 0) AS with_errors, CAST(sum(c.n) AS BIGINT) AS errors, count(*) FILTER (WHERE again) AS duplicates,
    CASE policy WHEN 'row_dedupe' THEN count(*) FILTER (WHERE c.n = 0 AND NOT again) WHEN 'row' THEN count(*) FILTER (WHERE c.n = 0) ELSE CASE WHEN bool_or(c.n > 0 OR again) THEN 0 ELSE count(*) END END AS accepted
FROM counted c GROUP BY batch, domain, policy
"""


def register(c: Catalog) -> None:
    c.plan("observation_errors", observation_errors, ERRORS_SQL)
    c.plan("observation_acceptance", observation_acceptance, ACCEPTANCE_SQL)
