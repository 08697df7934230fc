"""Hand-computed values of the feature operators, and plan checks."""

import datetime as dt
import math

import pytest

from panelforge.operators import breadth, macro, prices, rotation, scores
from panelforge.plans.recipe import Recipe, case, clamp, row_mean
from panelforge.sources import views


def bars(spark, closes, symbol="A", volume=10.0):
    day = dt.date(2024, 1, 1)
    rows = [(symbol, day + dt.timedelta(days=i), c, None if c is None else c + 1, None if c is None else c - 1, c, volume) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, open double, high double, low double, close double, volume double")


def last(df):
    return df.orderBy("trade_date").collect()[-1]


def test_returns_and_averages(spark):
    r = last(prices.PANEL.apply(bars(spark, [float(i) for i in range(1, 101)])))
    assert r["ma_100"] == 50.5
    assert r["ma_200"] is None
    assert r["return_1d"] == pytest.approx(1 / 99)
    assert r["range_20d"] == pytest.approx(19 / 81)
    assert r["drawdown_20d"] == 0
    assert r["true_range"] == 2.0
    assert r["trend_state"] == "STRONG_UPTREND"


def test_nulls_are_compacted_before_windows(spark):
    r = last(prices.PANEL.apply(bars(spark, [100.0, None, 110.0])))
    assert r["return_1d"] == pytest.approx(0.1)


def test_windows_take_the_last_values_that_exist(spark):
    """One missing volume and one missing high among 80 bars: 14 ranges and 20 volumes from before and after them."""
    df = bars(spark, [100.0 + i for i in range(80)])
    holes = df.selectExpr("symbol", "trade_date", "open", "CASE WHEN day(trade_date) = 15 AND month(trade_date) = 3 THEN NULL ELSE high END AS high", "low", "close", "CASE WHEN day(trade_date) = 16 AND month(trade_date) = 3 THEN NULL ELSE close - 90 END AS volume")
    r = last(prices.PANEL.apply(holes))
    # the last day is the 80th, 20 March: close 179, volume 89; the 16th (close 175) has no volume
    volumes = [v for v in range(69 - 1, 90) if v != 85][-20:]
    assert r["true_range"] == 2.0 and r["atr_14"] == 2.0
    assert r["relative_volume_20"] == pytest.approx(89 / (sum(volumes) / 20))
    assert r["adv_20"] == pytest.approx(sum(v * (v + 90) for v in volumes) / 20)
    zero = bars(spark, [100.0, 0.0] + [float(100 + i % 2) for i in range(25)])
    assert last(prices.PANEL.apply(zero))["volatility_20d"] is not None


def test_flat_prices_have_no_trend(spark):
    r = last(prices.PANEL.apply(bars(spark, [5.0] * 80)))
    assert r["return_20d"] == 0 and r["trend_state"] == "INSUFFICIENT_DATA"
    assert r["volatility_20d"] == 0


def test_volatility(spark):
    closes = [100.0]
    for i in range(20):
        closes.append(closes[-1] * (1.01 if i % 2 else 0.99))
    r = last(prices.PANEL.apply(bars(spark, closes)))
    assert r["volatility_20d"] == pytest.approx(0.01 * math.sqrt(252), rel=1e-9)


def test_breadth_counts(spark):
    df = bars(spark, [1.0, 2.0], "A").union(bars(spark, [2.0, 1.0], "B")).union(bars(spark, [3.0, 3.0], "C")).union(bars(spark, [1.0, 5.0], "D"))
    r = last(breadth.BREADTH.apply(df))
    assert (r["advancers"], r["decliners"], r["unchanged"], r["ad_line"]) == (2, 1, 1, 1)
    assert r["ad_ratio"] == 2 and r["observed"] == 4
    assert r["pct_above_20"] is None and r["breadth_score"] == 0.25


def test_rotation_ranks_break_ties_by_symbol(spark):
    df = None
    for s, up in (("SPY", 1.0), ("XLK", 1.02), ("XLF", 1.02), ("XLU", 0.99)):
        one = bars(spark, [100 * up**i for i in range(70)], s)
        df = one if df is None else df.union(one)
    day = rotation.SECTOR_DAYS.apply(df).where("trade_date = '2024-03-10'").collect()
    ranks = {r["symbol"]: r["rank_20d"] for r in day}
    assert ranks == {"XLF": 1, "XLK": 2, "XLU": 3}
    daily = last(rotation.DAILY.apply(df))
    assert daily["top_symbols"] == "XLF,XLK,XLU" and daily["sectors"] == 3


def test_volatility_regimes(spark):
    for level, label in ((12.0, "LOW_VOLATILITY"), (18.0, "NORMAL_VOLATILITY"), (25.0, "ELEVATED_VOLATILITY"), (35.0, "HIGH_VOLATILITY"), (50.0, "EXTREME_VOLATILITY")):
        assert last(macro.VOLATILITY.apply(bars(spark, [level] * 3, "VIX")))["volatility_regime"] == label


def test_score_nulls(spark):
    df = spark.createDataFrame([("A", None, None, None)], "symbol string, a double, b double, c double")
    r = Recipe().add(m=row_mean("a", "b"), k=clamp("a"), l=case(("a > 1", "X"), default="Y")).apply(df).first()
    assert (r["m"], r["k"], r["l"]) == (None, None, "Y")
    assert scores.GUIDANCE["raise"] == 1.0


def test_one_exchange_for_the_panel(spark):
    df = bars(spark, [1.0, 2.0]).repartition(3)
    plan = prices.PANEL.apply(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


def test_filter_and_columns_reach_the_scan(spark):
    df = views.CALENDAR.where("event_date > DATE '1998-01-01'").pick("event_id").apply(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "PushedFilters: [IsNotNull(o_orderdate)" in plan


def test_bars_come_from_hash_aggregation(spark):
    """First and last price of a day need no sort of the lines."""
    plan = views.BARS.apply(views.table(spark, "/root/testdata/sf0.001", "lineitem"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan


def test_filters_do_not_parse_again(spark):
    """What a filter tests was computed below it, so texts of bars are matched and cast once."""
    from panelforge.operators import normalize
    from panelforge.plans import ingestion

    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for recipe in (ingestion.VALID, ingestion.RAW_TWICE.then(normalize.CANONICAL)):
        plan = recipe.apply(lines)._jdf.queryExecution().optimizedPlan().toString()
        filters = [x for x in plan.splitlines() if "Filter" in x]
        assert filters and not any("RLIKE" in x.upper() for x in filters)
