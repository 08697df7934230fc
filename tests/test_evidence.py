"""Delivered files, line numbers, exchange calendar, gates and evidence chains on hand-made rows."""

import datetime as dt
import gzip
import hashlib

from pyspark.sql import functions as F

from panelforge.functions.expr import safe_datetime
from panelforge.operators import batch_gate, evidence_chain, sessions
from panelforge.sources import artifacts, evidence


def test_a_changed_byte_is_told(spark, tmp_path):
    for name, body in (("a/x.csv", b"1,2\n"), ("b/x.csv", b"3,4\n"), ("c/x.csv", b""), ("e/x.csv", b"5"), ("d/other.txt", b"no")):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(body)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    manifest = spark.createDataFrame([("a/x.csv", 4, sha(b"1,2\n")), ("b/x.csv", 4, sha(b"3,5\n")), ("z/x.csv", 1, sha(b"z"))], "file string, size long, sha256 string")
    out = evidence.against_manifest(evidence.digests(spark, str(tmp_path), "*.csv"), manifest)
    assert {r["file"]: (r["size"], r["status"]) for r in out.collect()} == {"a/x.csv": (4, "PASS"), "b/x.csv": (4, "checksum_mismatch"), "e/x.csv": (1, "unlisted_file"), "z/x.csv": (None, "missing_file")}
    names = spark.createDataFrame([("a/x.csv",), ("q/x.csv",)], "file string")
    assert sorted(map(tuple, evidence.expected_files(names, evidence.listing(spark, str(tmp_path))).collect())) == [("a/x.csv", True, 4), ("q/x.csv", False, 0)]
    assert "content" not in evidence.listing(spark, str(tmp_path)).select("size")._jdf.queryExecution().executedPlan().toString()


def test_line_numbers_of_a_file_in_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i * 7 % 90) if i % 11 else "" for i in range(1, 3000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "small.txt").write_text("line 1\nline 2")
    (tmp_path / "packed.txt.gz").write_bytes(gzip.compress(("\n".join(lines[:500]) + "\n").encode()))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for size in ("10k", "64m"):
            spark.conf.set(keys[0], size)
            spark.conf.set(keys[1], "1k")
            frame = evidence.numbered_lines(spark, str(tmp_path))
            if size == "10k":
                assert spark.read.text(str(tmp_path / "big.txt")).rdd.getNumPartitions() >= 10
            got = {(r["source_file"].rsplit("/", 1)[1], r["line_number"]): r["value"] for r in frame.collect()}
            assert got == {("big.txt", i): t for i, t in enumerate(lines, 1)} | {("packed.txt.gz", i): t for i, t in enumerate(lines[:500], 1)} | {("small.txt", 1): "line 1", ("small.txt", 2): "line 2"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_json_lines_with_errors(spark):
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(['{"a":1}', "", " ", "{", "[1]", "null", "x", '{"b":{}}'])], "source_file string, line_number long, value string")
    good, bad = evidence.split_json_objects(lines)
    assert sorted(r["line_number"] for r in good.collect()) == [0, 7]
    assert {r["line_number"]: r["error"] for r in bad.collect()} == {3: "malformed JSON", 4: "not a JSON object", 5: "not a JSON object", 6: "malformed JSON"}


def test_known_sessions(spark):
    dates = spark.createDataFrame([("1997-01-01",), ("2026-12-31",)], "d string")
    days = {r["day"]: r for r in sessions.sessions(dates, "d").collect()}
    closed = {str(d): r["closure"] for d, r in days.items() if r["closure"] not in (None, "weekend")}
    for day, name in {"2024-03-29": "good_friday", "2025-04-18": "good_friday", "2000-04-21": "good_friday", "2021-07-05": "independence_day", "2020-07-03": "independence_day", "2022-06-20": "juneteenth", "2023-01-02": "new_year", "2024-11-28": "thanksgiving", "2021-05-31": "memorial_day", "2025-01-09": "special", "2021-12-24": "christmas"}.items():
        assert closed[day] == name
    assert not {"1997-01-20", "2021-06-18", "2021-12-31", "2022-01-03"} & closed.keys()
    assert sum(d.startswith("2024") for d in closed) == 10 and sum(d.year == 2024 and r["is_open"] for d, r in days.items()) == 252
    early = {str(d) for d, r in days.items() if r["close_time"] == "13:00" and d.year == 2024}
    assert early == {"2024-07-03", "2024-11-29", "2024-12-24"}
    assert sessions.sessions(dates.limit(0), "d").count() == 0


def test_missing_days(spark):
    calendar = sessions.sessions(spark.createDataFrame([("2024-03-25",), ("2024-04-05",)], "d string"), "d")
    day = lambda t: dt.date.fromisoformat(t)
    bars = spark.createDataFrame([("A", day("2024-03-26")), ("A", day("2024-04-02")), ("A", day("2024-04-02")), ("A", day("2024-03-30")), ("B", day("2024-03-28")), ("B", day("2024-04-01"))], "symbol string, trade_date date")
    out = {r["symbol"]: r for r in sessions.missing_days(bars, calendar).collect()}
    assert [str(d) for d in out["A"]["missing_days"]] == ["2024-03-27", "2024-03-28", "2024-04-01"] and (out["A"]["expected"], out["A"]["observed"]) == (5, 2)
    assert out["B"]["missing_days"] == [] and out["B"]["ratio"] == 1.0


def test_option_contracts(spark):
    rows = spark.createDataFrame([(t,) for t in ("O:SPY240119C00400000", "SPY240119P00400500", "O:240119C00400000", "O:ABC240119X00400000", "O:QQQ991332C00400000", "SPY", None)], "ticker string")
    out = [tuple(r["contract"]) for r in batch_gate.parse_contract(rows).collect()]
    assert (out[0][0], str(out[0][1]), out[0][2], float(out[0][3])) == ("SPY", "2024-01-19", "C", 400.0) and float(out[1][3]) == 400.5
    assert [r[4] for r in out] == [None, None, "symbol format not recognized", "symbol format not recognized", "symbol parse failed", "symbol too short", "symbol too short"]


def test_gates_of_nothing(spark):
    rows = spark.createDataFrame([], "batch string, symbol string, trade_date date, file_day date, code string, adjusted boolean")
    manifests = spark.createDataFrame([("b", "v", "a", "1", "s", "PASS", "CERTIFIED")], "batch string, vendor string, asset_class string, dataset_version string, source_file_sha256 string, validation_status string, certification_status string")
    assert batch_gate.handoff(rows, manifests).count() == 0
    day = dt.date(2024, 1, 2)
    one = spark.createDataFrame([("b", "spy", day, day, None, None), ("b", "qqq", day, None, None, True)], rows.schema)
    (got,) = batch_gate.handoff(one, manifests).collect()
    assert (got["handoff_status"], got["row_errors"], got["adjustment_status"]) == ("FAIL", 1, "unknown_or_vendor_default")


def test_chain_of_one_chunk(spark):
    day = dt.date
    chunk = spark.createDataFrame([("A", day(2024, 1, 1), day(2024, 1, 10))], "symbol string, chunk_start date, chunk_end date")
    bars = spark.createDataFrame([("A", day(2024, 1, d)) for d in (2, 3, 4)], "symbol string, trade_date date")
    days = bars.select(F.col("trade_date").alias("day"))
    states = spark.createDataFrame([("run", "A", day(2024, 1, 5), 1, "OLD"), ("run", "A", day(2024, 1, 5), 2, "NEW"), ("run", "A", day(2025, 1, 5), 3, "LATER"), ("quality", "A", day(2023, 1, 1), 4, "Q"), ("quality", "A", None, 5, "UNDATED"), ("lineage", "B", day(2024, 1, 5), 6, "L")], "kind string, symbol string, day date, id long, status string")
    saved = spark.createDataFrame([("A", day(2024, 1, 1), day(2024, 1, 9))], "symbol string, chunk_start date, last_success date")

    def chain(*needs):
        flags = F.struct(*[F.lit(n in needs).alias(n) for n in ("bars", "run", "quality", "lineage", "checkpoint")])
        return evidence_chain.evidence_chain(chunk.withColumn("needs", flags), bars, days, states, saved).first()

    r = chain("bars", "run", "quality")
    assert (r["run_status"], r["run_match"], r["run_rows"]) == ("NEW", "exact", 2)
    assert (r["quality_status"], r["quality_match"], r["lineage_match"]) == ("Q", "fallback", "none")
    assert (r["bars_component"], r["lineage_component"], r["checkpoint_component"], r["evidence_status"], r["shape"]) == ("PASS", "PASS", "WARN", "WARN", "partial")
    r = chain("lineage", "checkpoint")
    assert (r["bars_component"], r["lineage_component"], r["checkpoint_component"], r["evidence_status"]) == ("WARN", "FAIL", "FAIL", "FAIL")


def test_times_without_an_offset_are_utc_in_any_zone(spark):
    rows = spark.createDataFrame([("2024-01-02",), ("2024-01-02T03:04",), ("2024-01-02 03:04:05",), ("2024-01-02T03:04:05.25Z",), ("2024-01-02T03:04:05-05:00",), ("soon",)], "c string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in rows.coalesce(1).selectExpr(f"unix_millis({safe_datetime('c')[0]})").collect()]
            assert got == [1704153600000, 1704164640000, 1704164645000, 1704164645250, 1704182645000, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_daily_artifacts_replace_their_days_only(spark, tmp_path):
    path = str(tmp_path / "days")
    day = lambda d: dt.date(2024, 1, d)
    rows = spark.createDataFrame([("A", day(2), 1.0), ("B", day(2), 2.0), ("A", day(3), 3.0), ("A", day(6), 4.0)], "symbol string, trade_date date, close double")
    artifacts.write_days(rows, path)
    artifacts.write_days(rows.where("trade_date = '2024-01-03'").withColumn("close", F.lit(9.0)), path)
    assert sorted(r[0] for r in spark.read.parquet(path).select("close").collect()) == [1.0, 2.0, 4.0, 9.0]
    due = spark.createDataFrame([(day(d),) for d in (2, 3, 4, 5)], "day date")
    (got,) = artifacts.batch_manifest(artifacts.summaries(spark, path), due).collect()
    assert (got["due"], got["found"], got["extra"], got["missing_days"], got["n_rows"], got["status"]) == (4, 2, 1, [day(4), day(5)], 4, "PARTIAL")
    assert artifacts.batch_manifest(artifacts.summaries(spark, path).limit(0), due).first()["status"] == "MISSING"


def test_states_of_a_chain_are_not_broadcast(spark):
    from panelforge.plans import chains

    plan = chains.evidence_chains(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [symbol" not in plan


def test_overlapping_chunks_each_count_their_rows(spark):
    day = dt.date
    chunks = spark.createDataFrame([("A", day(2024, 1, 1), day(2024, 3, 31)), ("A", day(2024, 2, 1), day(2024, 2, 5))], "symbol string, chunk_start date, chunk_end date").selectExpr("*", "named_struct('bars', true, 'run', true, 'quality', false, 'lineage', false, 'checkpoint', false) AS needs")
    bars = spark.createDataFrame([("A", day(2024, 2, 1)), ("A", day(2024, 2, 3)), ("A", day(2024, 3, 31)), ("B", day(2024, 2, 2))], "symbol string, trade_date date")
    days = spark.createDataFrame([(day(2024, 2, 1),), (day(2024, 2, 2),), (day(2024, 3, 31),), (day(2024, 4, 1),)], "day date")
    states = spark.createDataFrame([("run", "A", day(2024, 2, 5), 1, "OLD"), ("run", "A", day(2024, 2, 5), 2, "NEW"), ("run", "A", day(2024, 3, 1), 3, "LAST")], "kind string, symbol string, day date, id long, status string")
    saved = spark.createDataFrame([], "symbol string, chunk_start date, last_success date")
    got = evidence_chain.evidence_chain(chunks, bars, days, states, saved).orderBy("chunk_start").collect()
    assert [(r.bars, r.expected, r.missing, r.run_status, r.run_rows) for r in got] == [(3, 3, 1, "LAST", 3), (2, 2, 1, "NEW", 2)]
