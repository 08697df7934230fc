"""Handoff records of news, breadth and options on hand-made rows."""

import hashlib
import json

from panelforge.operators import observation_rules as r
from panelforge.operators import payload, record_handoff as h

NEWS = {
    "vendor": "v", "source_dataset": "d", "source_name": "n", "source_domain": "x.org", "headline": "h", "published_at": "2024-01-02T03:04:05Z", "collected_at": "2024-01-02T04:00:00+00:00", "producer_run_id": "p",
    "source_sha256": "s", "source_file_name": "f", "source_file_path": "a/f", "vendor_article_id": "a1", "relevance_score": 0.5,
}
BREADTH = {
    "observation_date": "2024-01-02", "universe_key": "U", "source_vendor": "v", "source_dataset": "d", "source_sha256": "s", "observed_symbol_count": 6, "advancing_count": 3, "declining_count": 2, "unchanged_count": 1,
    "advancing_volume": 1.5, "declining_volume": 0, "new_high_count": 0, "new_low_count": 0, "generated_at": "t", "schema_version": "1", "metadata": {},
}


def judged(spark, *records):
    rows = spark.createDataFrame([(i, k, x if x is None or isinstance(x, str) else json.dumps(x)) for i, (k, x) in enumerate(records)], "seq int, kind string, record string")
    out = h.judge_records(rows, r.rules_table(spark, h.LISTED)).collect()
    return [(list(x["reasons"]), list(x["warnings"]), x["idempotency_key"]) for x in sorted(out)]


def digest(*parts):
    return hashlib.sha256("".join(p + "\0" for p in parts).encode()).hexdigest()


def test_news(spark):
    told = judged(
        spark, ("news", NEWS), ("news", NEWS | {"bullish": None, "buy_signal": 1}), ("news", NEWS | {"url": "https://x/?api_key=1"}), ("news", NEWS | {"url": "ftp://x"}), ("news", {k: v for k, v in NEWS.items() if k != "vendor_article_id"}),
        ("news", NEWS | {"relevance_score": "1.5", "raw_sentiment_score": "x"}), ("news", NEWS | {"collected_at": "2023-01-01"}), ("news", NEWS | {"published_at": "yesterday", "headline": " "}), ("news", NEWS | {"canonical_url": "https://c", "url": "https://u"}),
    )
    assert told[0] == ([], [], digest("v", "d", "a1", "", "2024-01-02T03:04:05+00:00"))
    assert told[1][0] == ["strategy fields are not allowed in ingestion handoff"]
    assert told[2][0] == ["url may hold a secret"] and told[3][0] == ["url is unsafe"]
    assert told[4][0] == ["one of vendor_article_id, url, canonical_url, or news_id is required"]
    assert told[5][0] == ["raw_sentiment_score must be numeric when provided", "relevance_score must be between 0 and 1 when provided"]
    assert told[6][:2] == ([], ["collected_at is earlier than published_at"])
    assert told[7][0] == ["published_at is missing or invalid", "headline is required"] and told[7][2] is None
    assert told[8][2] == digest("v", "d", "a1", "https://c", "2024-01-02T03:04:05+00:00")


def test_breadth(spark):
    told = judged(spark, ("breadth", BREADTH), ("breadth", BREADTH | {"observed_symbol_count": 7}), ("breadth", BREADTH | {"advancing_count": 3.0}), ("breadth", BREADTH | {"breadth_score": 1, "advancing_volume": -1}))
    assert told[0] == ([], [], digest("v", "d", "s", "2024-01-02", "U", "1"))
    assert told[1][0] == ["observed_symbol_count must equal advancing_count + declining_count + unchanged_count"]
    assert told[2][0] == ["advancing_count must be a non-negative integer"]
    assert told[3][:2] == (["advancing_volume must be a non-negative number when present"], ["derived breadth metrics retained only in metadata when present"])


def test_options_and_records_that_are_none(spark):
    full = {f: 1 for f in h.OPTION_FIELDS["options_open_interest"]} | {"source_dataset": "options_open_interest"}
    told = judged(spark, ("options", full), ("options", {"source_dataset": "options_contracts_master"}), ("options", {}), ("options", {"source_dataset": "odd"}), ("news", None), ("breadth", "[1]"), ("options", "{"))
    assert told[0][0] == [] and len(told[1][0]) == 5
    assert told[2][0] == ["missing domain"] and told[3][0] == ["unsupported domain: odd"]
    assert [t[0] for t in told[4:]] == [["row must be an object"]] * 3


def test_reports_in_parts(spark):
    rows = spark.createDataFrame([("d1", i, f"e{i}") for i in range(7)] + [("d2", 1, "x")], "day string, at int, name string")
    out = {(r["day"], r["part"]): r for r in payload.reports_in_parts(rows, "day", ["at"], ["name"], "items", 3).collect()}
    assert [[x["name"] for x in out["d1", p]["items"]] for p in range(3)] == [["e0", "e1", "e2"], ["e3", "e4", "e5"], ["e6"]]
    assert (out["d1", 0]["parts"], out["d1", 2]["n"], out["d2", 0]["parts"]) == (3, 7, 1)
    assert payload.reports_in_parts(rows.limit(0), "day", ["at"], ["name"], "items").count() == 0


def test_counts_judge_records_once(spark):
    from panelforge.plans import record_handoffs

    plan = record_handoffs.record_counts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
