"""Committed loads and the stateful stream: recovery, repeats, late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge.operators import loads
from panelforge.streaming import dedupe

SCHEMA = "symbol string, trade_date date, timeframe string, adjusted boolean, open double, high double, low double, close double, volume double, seq string, extra int"


def source(spark, rows):
    """(symbol, day of 2024 or None, close, seq)."""
    day = lambda n: None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)
    return spark.createDataFrame([(s, day(n), "1d", True, c, None if c is None else c + 1, None if c is None else c - 1, c, 5.0, q, 1) for s, n, c, q in rows], SCHEMA)


FIRST = [("A", 0, 10.0, "1"), ("A", 0, 11.0, "2"), ("A", 40, 12.0, "3"), ("B", 3, None, "4"), ("B", None, 1.0, "5")]
SECOND = FIRST + [("A", 41, 13.0, "6"), ("A", 80, 14.0, "7"), ("B", 5, 3.0, "8"), ("C", 1, 9.0, "9")]


def tables(spark, root):
    bars = sorted(map(str, loads.read_bars(spark, root).collect()))
    return [bars] + [sorted(map(str, loads.read_state(spark, root, n).collect())) for n in loads.STATES]


def run(spark, root, *ends):
    loads.load(source(spark, FIRST), root, "l1", "t1", "2023-01-01")
    for end in ends:
        try:
            loads.load(source(spark, SECOND), root, "l2", "t2", "2023-01-01", end_after=end)
            assert end is None
        except loads.Killed:
            assert end
    return tables(spark, root)


def test_load_that_died_and_ran_again_leaves_the_same_tables(spark, tmp_path):
    clean = run(spark, str(tmp_path / "clean"), None)
    assert run(spark, str(tmp_path / "died"), "stage", "bars", "lineage", "checkpoints", None) == clean
    assert run(spark, str(tmp_path / "again"), None, None) == clean
    bars = {(r["symbol"], str(r["trade_date"])): r for r in loads.read_bars(spark, str(tmp_path / "clean")).collect()}
    assert {k: r["close"] for k, r in bars.items()} == {("A", "2024-01-01"): 10.0, ("A", "2024-02-10"): 12.0, ("A", "2024-02-11"): 13.0, ("A", "2024-03-21"): 14.0, ("B", "2024-01-06"): 3.0, ("C", "2024-01-02"): 9.0}
    (first, second) = sorted(loads.read_state(spark, str(tmp_path / "clean"), "runs").collect(), key=lambda r: r["load"])
    assert (first["status"], first["written"], first["failed"]) == ("PARTIAL", 2, 1)
    assert (second["status"], second["inserted"], second["updated"]) == ("SUCCESS", 4, 0)


def test_corrections_keep_their_birth(spark, tmp_path):
    root = str(tmp_path)
    loads.load(source(spark, FIRST), root, "l1", "t1", "2023-01-01")
    loads.load(source(spark, [("A", 0, 99.0, "1")]), root, "l2", "t2", "2023-01-01", resume=False)
    r = loads.read_bars(spark, root).where("close = 99").first()
    assert (r["created_load"], r["created_at"], r["load"], r["updated_at"]) == ("l1", "t1", "l2", "t2")
    assert loads.read_bars(spark, root).count() == 2
    assert loads.last_checkpoints(spark, root).where("symbol = 'A'").first()["last_success"] == dt.date(2024, 2, 10)


def test_checkpoints_of_loads_that_died_do_not_count(spark, tmp_path):
    with pytest.raises(loads.Killed):
        loads.load(source(spark, FIRST), str(tmp_path), "l1", "t1", "2023-01-01", end_after="checkpoints")
    assert loads.last_checkpoints(spark, str(tmp_path)).count() == 0


def test_load_of_nothing(spark, tmp_path):
    loads.load(source(spark, []), str(tmp_path), "l1", "t1", "2023-01-01")
    assert loads.read_bars(spark, str(tmp_path)).count() == 0
    assert loads.read_state(spark, str(tmp_path), "runs").first()["received"] == 0


def feed(spark, inbox, rows):
    raw = [(s, d, c, c, c, c, "5", "1", "1") for s, d, c in rows]
    spark.createDataFrame(raw, dedupe.RAW).coalesce(1).write.mode("append").option("header", True).csv(inbox)


def test_stream_keeps_a_key_once_over_restarts(spark, tmp_path):
    where = [str(tmp_path / n) for n in ("inbox", "bars", "bad", "checkpoint")]
    feed(spark, where[0], [("a", "2024-01-02", "10"), ("A", "2024-01-02", "11"), ("b", "2024-03-01", "1"), ("c", "soon", "1"), ("", "2024-01-02", "1")])
    assert dedupe.drain(spark, *where) == 0
    assert dedupe.drain(spark, *where) == 0
    feed(spark, where[0], [("b", "2024-03-01", "2"), ("d", "2024-03-02", "7")])
    dedupe.drain(spark, *where)
    feed(spark, where[0], [("e", "2024-01-01", "3"), ("f", "2024-03-03", "4"), ("d", "2024-03-02", "8")])
    assert dedupe.drain(spark, *where) == 1
    got = sorted((r["symbol"], str(r["trade_date"])) for r in dedupe.accepted(spark, where[1]).collect())
    assert got == [("A", "2024-01-02"), ("B", "2024-03-01"), ("D", "2024-03-02"), ("F", "2024-03-03")]
    assert dedupe.rejected(spark, where[2]).count() == 2
    # a replay of all files at once gives the same keys and the row that came late
    again = [where[0], *[str(tmp_path / f"again-{n}") for n in ("bars", "bad", "checkpoint")]]
    dedupe.drain(spark, *again)
    keys = lambda path: {(r["symbol"], r["trade_date"]) for r in dedupe.accepted(spark, path).collect()}
    assert keys(where[1]) <= keys(again[1]) and len(keys(again[1])) == 5
    assert dedupe.accepted(spark, again[1]).groupBy("symbol").agg(F.count("*").alias("n")).where("n > 1").count() == 0
