"""What goes to disk between stages: bars and snapshot writes deal narrow rows, and each of them once."""

from __future__ import annotations

import re

import __spark_entry__ as entry
from panelforge.operators import upsert
from panelforge.sources import views

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_before_they_are_grouped(spark):
    plan = _plan(entry.queries()["canonical_bars_keys"](spark, SF))
    assert plan.count("Exchange") == 1 and "ENSURE_REQUIREMENTS" not in plan
    dealt = plan[plan.index("Exchange") :]
    assert "decimal" not in dealt and "Aggregate" not in dealt


def test_panels_of_a_symbol_need_no_other_exchange(spark):
    assert _plan(entry.queries()["price_panel"](spark, SF)).count("Exchange") == 1


def test_the_last_report_of_a_symbol_is_told_where_its_panel_lies(spark):
    plan = _plan(entry.queries()["price_reports"](spark, SF))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_lines_without_supplier_or_day_are_bars_too(spark):
    line = "struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp>"
    rows = spark.sql(f"SELECT inline(from_json('[{{\"l_orderkey\":2,\"l_linenumber\":1,\"l_quantity\":2,\"l_extendedprice\":6}},{{\"l_orderkey\":1,\"l_linenumber\":1,\"l_quantity\":1,\"l_extendedprice\":5}}]', 'array<{line}>'))")
    assert [tuple(r) for r in views.BARS.apply(rows).select("symbol", "trade_date", "open", "close", "volume", "transactions").collect()] == [(None, None, 5.0, 3.0, 3.0, 2)]


def test_snapshot_write_deals_its_rows_once(spark):
    plan = _plan(entry.queries()["snapshot_write"](spark, SF))
    assert plan.count("Exchange") == 2 and "Join" not in plan
    assert len(re.findall("FileScan", plan)) == 1
    assert re.search(r"Exchange hashpartitioning\(symbol#\d+, 4\), REPARTITION_BY_NUM", plan)  # narrow rows are not joined to few tasks


def test_snapshot_status_by_grain_is_that_of_the_joins(spark):
    target = spark.createDataFrame([("A", 1, "a1"), ("A", 2, "a2x"), ("B", 1, None), ("C", 1, "c1"), ("C", 1, "c1x")], "symbol string, day int, key string")
    source = spark.createDataFrame([("A", 1, "a1"), ("A", 2, "a2"), ("A", 3, "a3"), ("A", 1, None), ("B", 1, "b1"), ("C", 1, "c1"), ("C", 1, "c1x"), ("C", 1, "c1y"), ("C", 1, "c1")], "symbol string, day int, key string")
    both = target.selectExpr("*", "true AS stored").unionByName(source.selectExpr("*", "false AS stored"))
    told = lambda df: sorted(map(tuple, df.select("symbol", "day", "key", "write_status").collect()), key=str)
    got = told(upsert.snapshot_status_by_grain(both, ["symbol", "day"], "key", "stored"))
    assert got == told(upsert.snapshot_status(target, source, ["symbol", "day"], "key")) and len(got) == 9
    assert {s for *_, s in got} == {"REJECTED", "IDEMPOTENT_NOOP", "CONFLICT", "WRITE_ACCEPTED"}
