"""Plans whose cost must grow with the rows alone: no long sliding frames, nothing computed twice, no year in one task."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from panelforge.operators import observation_rules
from panelforge.plans import loads

SF = "/root/testdata/sf0.001"


class Ended(Exception):
    pass


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["price_panel", "price_windows_with_gaps", "breadth_daily"])
def test_windows_of_prices_are_joined_from_blocks(spark, name):
    frames = re.findall(r"specifiedwindowframe\((?:Row|Range)Frame, -(\d+), currentrow", _plan(entry.queries()[name](spark, SF)), re.I)
    assert not frames


def test_parsed_days_and_symbols_are_not_parsed_again_on_every_line(spark):
    assert "trim(" not in _plan(entry.queries()["eod_bars"](spark, SF)).rsplit("Aggregate", 1)[1]


@pytest.mark.parametrize("name", ["upsert_bars", "handoff_gate"])
def test_sides_are_taken_from_rows_that_were_made_once(spark, name):
    assert not [f for f in entry.queries()[name](spark, SF).inputFiles() if "lineitem" in f]


def test_loads_take_their_rows_from_those_that_were_made_once(spark, monkeypatch):
    def load(source, *args, **kwargs):
        assert not [f for f in source.inputFiles() if "lineitem" in f]
        raise Ended

    monkeypatch.setattr(loads.loads, "load", load)
    with pytest.raises(Ended):
        loads.load_states(spark, SF)


def test_a_year_of_the_stream_is_written_by_more_than_one_task(spark, monkeypatch):
    def drain(session, inbox, *args):
        assert 1 < len(list(Path(inbox.removeprefix("file://").removeprefix("file:")).glob("*.csv"))) <= loads.PARTS
        raise Ended

    monkeypatch.setattr(loads.dedupe, "drain", drain)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with pytest.raises(Ended):
            loads.streamed_bars(spark, SF)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rules_that_ask_for_a_field_alone_read_no_value(spark, monkeypatch):
    monkeypatch.setattr(observation_rules, "_VALUE", "named_struct('type', CAST(raise_error(concat('read ', x.kind)) AS STRING), 'text', '', 'number', 0D, 'items', array(''))")
    table = observation_rules.rules_table(spark, [("d", "present", "a b c", "is required"), ("d", "absent", "e", "=e is unknown")])
    rows = spark.createDataFrame([(1, "d", '{"a": null, "b": 1}'), (2, "d", '{"a": 1, "b": 2, "c": 3, "e": null}')], "seq int, domain string, record string")
    told = {row["seq"]: [e["message"] for e in row["errors"]] for row in observation_rules.judge(rows, table).collect()}
    assert told == {1: ["c is required"], 2: ["e is unknown"]}
