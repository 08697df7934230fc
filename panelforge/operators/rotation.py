"""Sector rotation: relative strength against the benchmark, ranks, momentum, leadership, state of each day.

Prices are not compacted here: a return needs both of its prices, above zero. The benchmark's returns reach the sectors
by a window over the day, so there is no join.
"""

from __future__ import annotations

from panelforge.plans.recipe import Recipe, case, clamp, listed, row_mean

BENCHMARK = "SPY"
#: Sectors by the groups they belong to.
DEFENSIVE = ("XLP", "XLV", "XLRE", "XLU")
CYCLICAL = ("XLY", "XLE", "XLF", "XLI", "XLB")
GROWTH = ("XLC", "XLY", "XLK")
RATE_SENSITIVE = ("XLE", "XLF", "XLRE", "XLU")
SECTORS = ("XLC", "XLY", "XLP", "XLE", "XLF", "XLV", "XLI", "XLB", "XLRE", "XLK", "XLU")
WINDOWS = (1, 5, 20, 60)


def _in(names: tuple[str, ...]) -> str:
    return "symbol IN (" + ", ".join(f"'{n}'" for n in names) + ")"


def _return(n: int) -> str:
    past = f"lag(close, {n}) OVER (PARTITION BY symbol ORDER BY trade_date)"
    return f"CASE WHEN close > 0 AND {past} > 0 THEN close / {past} - 1 END"


def _rank(value: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN row_number() OVER (PARTITION BY trade_date ORDER BY {value} DESC NULLS LAST, symbol) END"


#: (symbol, trade_date, close) to a row for each sector and day on which the benchmark trades.
SECTOR_DAYS = (
    Recipe()
    .where(_in((BENCHMARK, *SECTORS)))
    .add(**{f"return_{n}d": _return(n) for n in WINDOWS})
    .add(
        **{f"bench_{n}d": f"max(CASE WHEN symbol = '{BENCHMARK}' THEN return_{n}d END) OVER (PARTITION BY trade_date)" for n in WINDOWS},
        has_bench=f"max(CASE WHEN symbol = '{BENCHMARK}' THEN 1 ELSE 0 END) OVER (PARTITION BY trade_date)",
    )
    .where(f"has_bench = 1 AND symbol <> '{BENCHMARK}'")
    .add(**{f"rs_{n}d": f"return_{n}d - bench_{n}d" for n in WINDOWS})
    .add(**{f"rank_{n}d": _rank(f"rs_{n}d") for n in (5, 20, 60)})
    .add(rank_change_5d="rank_20d - rank_5d", rank_change_20d="rank_60d - rank_20d")
    .add(
        momentum_score=row_mean(clamp("rs_5d / 0.10"), clamp("rs_20d / 0.15"), clamp("rs_60d / 0.20"), clamp("rank_change_5d / CAST(5 AS DOUBLE)"), clamp("rank_change_20d / CAST(10 AS DOUBLE)")),
        leader="coalesce(rank_5d <= 3, false)",
        deteriorating="coalesce(rank_change_5d < 0, false) OR coalesce(rank_change_20d < 0, false) OR coalesce(rs_5d < rs_20d, false)",
    )
    .add(
        score_rank="row_number() OVER (PARTITION BY trade_date ORDER BY rs_20d DESC NULLS LAST, symbol)",
        low_rank="row_number() OVER (PARTITION BY trade_date ORDER BY rs_20d NULLS LAST, symbol)",
        list_rank="row_number() OVER (PARTITION BY trade_date ORDER BY coalesce(momentum_score, -CAST(rank_20d AS DOUBLE), 0) DESC, symbol)",
    )
)
SECTOR_COLUMNS = [
    "symbol", "trade_date", *(f"return_{n}d" for n in WINDOWS), *(f"rs_{n}d" for n in WINDOWS), "rank_5d", "rank_20d", "rank_60d",
    "rank_change_5d", "rank_change_20d", "momentum_score", "leader", "deteriorating",
]
def _listed(condition: str) -> tuple[str, str]:
    return listed(f"CASE WHEN {condition} THEN symbol END", "list_rank")


#: Sectors of each day in the order of their momentum, or of their 20-day rank where there is none.
REPORT = SECTOR_DAYS.add(of_day="count(*) OVER (PARTITION BY trade_date)").group(
    ["trade_date"],
    observation_count="count(*)",
    strongest=_listed("list_rank <= 3"),
    weakest=listed("CASE WHEN of_day - list_rank < 3 THEN symbol END", "-list_rank"),
    leadership=_listed("leader"),
    deteriorating_sectors=_listed("deteriorating"),
    defensive=_listed(_in(DEFENSIVE)),
    cyclical=_listed(_in(CYCLICAL)),
    growth=_listed(_in(GROWTH)),
    rate_sensitive=_listed(_in(RATE_SENSITIVE)),
)
#: One row for each day; the score is the 20-day relative strength.
DAILY = (
    SECTOR_DAYS.group(
        ["trade_date"],
        sectors="count(*)",
        scored="count(rs_20d)",
        defensive=f"avg(CASE WHEN {_in(DEFENSIVE)} THEN rs_20d END)",
        cyclical=f"avg(CASE WHEN {_in(CYCLICAL)} THEN rs_20d END)",
        growth=f"avg(CASE WHEN {_in(GROWTH)} THEN rs_20d END)",
        rate_sensitive=f"avg(CASE WHEN {_in(RATE_SENSITIVE)} THEN rs_20d END)",
        dispersion="stddev_pop(rs_20d)",
        concentration="CASE WHEN count(rs_20d) > 0 THEN coalesce(sum(CASE WHEN score_rank <= 3 THEN abs(rs_20d) END) / nullif(sum(abs(rs_20d)), 0), 0) END",
        positive_breadth="avg(CASE WHEN rs_20d IS NULL THEN NULL WHEN rs_20d > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)",
        improving="bool_or((coalesce(rank_change_5d > 0, false) OR coalesce(rank_change_20d > 0, false)) AND NOT deteriorating)",
        any_deteriorating="bool_or(deteriorating)",
        top_symbols=listed("CASE WHEN rs_20d IS NOT NULL AND score_rank <= 3 THEN symbol END", "score_rank"),
        bottom_symbols=listed("CASE WHEN rs_20d IS NOT NULL AND low_rank <= 3 THEN symbol END", "low_rank"),
        leaders=listed("CASE WHEN leader THEN symbol END", "list_rank"),
    )
    .add(
        risk_on=clamp(row_mean("cyclical", "growth")),
        broad="coalesce(positive_breadth >= 0.6, false)",
        narrow="coalesce(concentration >= 0.5, false)",
    )
    .add(
        rotation_state=case(
            ("scored = 0", "INSUFFICIENT_DATA"),
            ("any_deteriorating AND narrow", "BROAD_DETERIORATION"),
            ("any_deteriorating", "MIXED_ROTATION"),
            ("risk_on > defensive AND broad", "RISK_ON_LEADERSHIP"),
            ("defensive > risk_on AND narrow", "DEFENSIVE_LEADERSHIP"),
            ("broad", "BROAD_IMPROVEMENT"),
            ("narrow", "NARROW_LEADERSHIP"),
            default="NO_CLEAR_ROTATION",
        )
    )
)
DAILY_COLUMNS = [
    "trade_date", "sectors", "scored", "defensive", "cyclical", "growth", "rate_sensitive", "risk_on", "dispersion", "concentration", "positive_breadth",
    "broad", "narrow", "improving", "any_deteriorating", "top_symbols", "bottom_symbols", "leaders", "rotation_state",
]
