"""File sources and sinks, upserts and the stream, on small files."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators import upsert
from panelforge.sources import files
from panelforge.streaming import ingest

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("tags", T.ArrayType(T.StringType()))])


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1, "tags": ["x"]}\n\n{"id": 2\n[3]\n{"id": 4}\n')
    good, bad = files.read_jsonl(spark, str(p), SCHEMA)
    assert sorted(r["id"] for r in good.collect()) == [1, 4]
    assert sorted(r["line"] for r in bad.collect()) == ["[3]", '{"id": 2']
    with pytest.raises(Exception):
        files.read_jsonl_strict(spark, str(p), SCHEMA).collect()


def test_json_array_and_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    assert files.read_json_array(spark, str(tmp_path / "a.json"), SCHEMA).count() == 2
    df = spark.createDataFrame([("S", None, [(1,), (2,)])], "symbol string, rows array<struct<v:int>>, data array<struct<v:int>>")
    assert [tuple(r) for r in files.explode_envelope(df).collect()] == [("S", 1), ("S", 2)]


def test_daily_csv_with_manifest(spark, tmp_path):
    (tmp_path / "bars.csv").write_text("Ticker,date,open\nspy,2024-01-02,1\nqqq,bad,2\n")
    (tmp_path / "manifest.json").write_text(json.dumps({"vendor": "v", "lineage_id": "l", "source_file_sha256": "s"}, indent=1))
    df = files.read_daily_ohlcv_csv(spark, str(tmp_path / "bars.csv"), str(tmp_path / "manifest.json"))
    assert [(r["ticker"], r["vendor"]) for r in df.orderBy("ticker").collect()] == [("qqq", "v"), ("spy", "v")]
    assert [r["seq"] for r in files.numbered(df).orderBy("seq").collect()] == [1, 2]


def test_header_aliases_and_strict_header(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("SYMBOL,window_start,open,high,low,close,volume\nA,1704153600000000000,1,2,0,1,5\n")
    r = files.read_stock_day_aggs(spark, str(tmp_path / "a.csv.gz")).first()
    assert (r["ticker"], r["date"], r["transactions"]) == ("A", "1704153600000000000", "")
    (tmp_path / "o.csv").write_text(",".join(files.OPTION_HEADER) + "\nO:A240119C00400000,1,1,1,1,1,1,1\n")
    assert files.read_options_day_aggs(spark, str(tmp_path / "o.csv")).count() == 1
    (tmp_path / "w.csv").write_text("ticker,open\na,1\n")
    with pytest.raises(ValueError):
        files.read_options_day_aggs(spark, str(tmp_path / "w.csv"))


def test_split_write_and_daily(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id long, name string")
    files.write_split(df, F.when(F.col("name").isNull(), "missing_name").otherwise(""), str(tmp_path / "good"), str(tmp_path / "bad"), run="r1")
    assert spark.read.json(str(tmp_path / "good")).first()["run"] == "r1"
    assert spark.read.json(str(tmp_path / "bad")).first()["reasons"] == "missing_name"
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 2)), ("B", dt.date(2024, 1, 2)), ("A", dt.date(2024, 1, 3))], "symbol string, trade_date date")
    assert sorted(r["n"] for r in files.write_daily(bars, str(tmp_path / "days")).collect()) == [1, 2]
    assert files.sample(bars, ["symbol"], 0).count() == 1
    assert files.scan_canonical(bars, ["A"], "2024-01-02", "2024-01-03").count() == 1


def test_upsert_twice_changes_nothing(spark):
    schema = "symbol string, trade_date date, timeframe string, adjusted boolean, close double, seq int"
    day = dt.date(2024, 1, 2)
    target = spark.createDataFrame([("A", day, "1d", True, 1.0, 0)], schema)
    source = spark.createDataFrame([("A", day, "1d", True, 2.0, 1), ("A", day, "1d", True, 3.0, 2), ("B", day, "1d", True, 4.0, 3)], schema)
    once = upsert.upsert(target, source, upsert.KEY, ["seq"])
    assert sorted((r["symbol"], r["close"], r["action"]) for r in once.collect()) == [("A", 2.0, "updated"), ("B", 4.0, "inserted")]
    again = upsert.upsert(once.drop("action"), source, upsert.KEY, ["seq"])
    assert sorted((r["symbol"], r["close"]) for r in again.collect()) == [("A", 2.0), ("B", 4.0)]


def test_stream_ingest_resumes(spark, tmp_path):
    header = "ticker,date,open,high,low,close,volume,transactions,adjusted\n"
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.csv").write_text(header + "a,2024-01-02,1,2,0,1,5,1,1\na,2024-01-02,9,9,9,9,5,1,1\nb,bad,1,2,0,1,5,1,1\n")
    where = [str(tmp_path / x) for x in ("ok", "bad", "cp")]
    ingest.ingest(spark, str(inbox), *where).awaitTermination()
    (inbox / "2.csv").write_text(header + "c,2024-01-03,1,2,0,1,5,1,1\n")
    ingest.ingest(spark, str(inbox), *where).awaitTermination()
    got = sorted((r["symbol"], r["close"]) for r in ingest.bars_so_far(spark, where[0]).collect())
    assert got == [("a", 1.0), ("c", 1.0)]
    assert spark.read.json(where[1]).first()["reasons"] == "invalid_trade_date"
