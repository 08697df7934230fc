"""Price features of every (symbol, day): returns, averages, ranges, volatility, true range, liquidity, trend.

Rows without a close take no part, so that windows count closes; windows that are not full give null. Volatility, true
range and volumes take the last so many values that exist. All windows share one partitioning and order, hence one exchange
and one sort.

Spark goes through every row of a sliding frame anew for each row, so there windows are joined from blocks: five values that
follow one another, twenty of four such blocks, and so on, each reached by an offset. A row costs as many steps as there are
blocks, not rows. Sums are of blocks, never differences of running sums, so that nothing cancels. Amounts of money are so large
that their sixth place hangs on the order of a sum; theirs are added in the order of days.
"""

from __future__ import annotations

from panelforge.plans.recipe import Recipe, case, clamp, row_mean

RETURNS = (1, 5, 20, 60, 252)
AVERAGES = (20, 50, 100, 200)


def rows(n: int, order: str = "PARTITION BY symbol ORDER BY trade_date") -> str:
    return f"OVER ({order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(aggregate: str, n: int, counted: str = "close") -> str:
    """Aggregate over the last ``n`` rows; null unless that many values are there."""
    return f"CASE WHEN count({counted}) {rows(n)} = {n} THEN {aggregate} {rows(n)} END"


def running(value: str) -> str:
    """How many values there are up to the row."""
    return f"count({value}) OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def existing(aggregate: str, n: int, seen: str) -> str:
    """Aggregate over the last ``n`` values that exist, ``seen`` being their running count; null while there are fewer."""
    return f"CASE WHEN {seen} >= {n} THEN {aggregate} OVER (PARTITION BY symbol ORDER BY {seen} RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END"


_EACH = "OVER (PARTITION BY symbol ORDER BY trade_date)"


def back(c: str, n: int, skip: bool = False) -> str:
    """The value ``n`` rows back; ``skip``: ``n`` values that exist."""
    return f"lag({c}, {n}) {'IGNORE NULLS ' if skip else ''}{_EACH}"


def block(c: str, size: int, times: int, skip: bool = False) -> str:
    """Sum of so many blocks that end a block apart, null unless all are there; ``c`` is a sum over ``size`` rows."""
    return " + ".join([c, *(back(c, size * i, skip) for i in range(1, times))])


def in_order(c: str, n: int) -> str:
    """Sum of the last ``n`` values that exist, the oldest first, null unless all are there."""
    return " + ".join([*(back(c, i, True) for i in range(n - 1, 0, -1)), c])


def extreme(f: str, c: str, size: int, times: int) -> str:
    """Greatest or least of so many blocks, null unless all are there."""
    others = [back(c, size * i) for i in range(1, times)]
    return f"CASE WHEN {others[-1]} IS NOT NULL THEN {f}({', '.join([c, *others])}) END"


#: Sums over the last rows of ``close``, which is never null here, level by level; each level is one window.
SUMS = (
    {"sum_5": block("close", 1, 5)},
    {"sum_20": block("sum_5", 5, 4), "sum_50": block("sum_5", 5, 10)},
    {"sum_100": block("sum_50", 50, 2), "sum_200": block("sum_50", 50, 4)},
)
_ENDS = {"max": "greatest", "min": "least"}
ENDS = tuple({f"{f}_{n}": extreme(g, of.format(f), size, times) for f, g in _ENDS.items()} for n, of, size, times in ((5, "close", 1, 5), (20, "{}_5", 5, 4), (60, "{}_20", 20, 3)))


def means(*lengths: int) -> dict[str, str]:
    return {f"ma_{n}": f"sum_{n} / {n}" for n in lengths}


def _spread(name: str, size: int, times: int, of: str) -> tuple[dict[str, str], dict[str, str]]:
    """sum_``name`` and square_``name``, squares around the mean, of so many blocks of ``size`` values that exist, of sum_``of`` and square_``of``.

    First the columns of the blocks before, which are windows, then what is computed from them."""
    before = {f"{c}_{name}_{i}": back(f"{c}_{of}", size * i, True) for c in ("sum", "square") for i in range(1, times)}
    sums, squares = ([f"{c}_{of}", *(f"{c}_{name}_{i}" for i in range(1, times))] for c in ("sum", "square"))
    total = "(" + " + ".join(sums) + ")"
    around = [f"{size} * ({x} / {size} - {total} / {size * times}) * ({x} / {size} - {total} / {size * times})" for x in sums]
    return before, {f"sum_{name}": total, f"square_{name}": " + ".join([*squares, *around])}


def _signs(op: str) -> str:
    return " + ".join(f"(CASE WHEN {r} {op} 0 THEN 1 ELSE 0 END)" for r in ("r1", "r5", "r20", "r60"))


def _far(op: str) -> str:
    """Both distances from the averages have the sign, or are missing."""
    return " AND ".join(f"(distance_ma_{n} IS NULL OR distance_ma_{n} {op} 0)" for n in (20, 50))


TREND = case(
    ("r20 IS NULL OR r60 IS NULL", "INSUFFICIENT_DATA"),
    (f"{_signs('>')} >= 3 AND {_far('>')}", "STRONG_UPTREND"),
    (f"{_signs('<')} >= 3 AND {_far('<')}", "STRONG_DOWNTREND"),
    (f"r20 > 0 AND r60 > 0 AND {_far('>=')}", "UPTREND"),
    (f"r20 < 0 AND r60 < 0 AND {_far('<=')}", "DOWNTREND"),
    default="MIXED",
)
_RETURNS = {f"return_{n}d": f"(close - close_{n}) / nullif(close_{n}, 0)" for n in RETURNS}
_DISTANCES = {f"distance_ma_{n}": f"(close - ma_{n}) / nullif(ma_{n}, 0)" for n in (20, 50)}
_ABOVE = {f"above_ma_{n}": f"close > ma_{n}" for n in AVERAGES}
_RANGES = {n: {f"range_{n}d": f"(max_{n} - min_{n}) / nullif(min_{n}, 0)"} for n in (20, 60)}
_DRAWDOWNS = {n: {f"drawdown_{n}d": f"(close - max_{n}) / nullif(max_{n}, 0)"} for n in (20, 60)}
_TRUE_RANGE = "CASE WHEN high IS NULL OR low IS NULL THEN NULL WHEN prev_close IS NULL THEN high - low ELSE greatest(high - low, abs(high - prev_close), abs(low - prev_close)) END"
# a return of exactly zero counts as missing in the trend, and only there
_MOVES = {f"r{n}": f"nullif(return_{n}d, 0)" for n in (1, 5, 20, 60)}
_RELATIVE = "volume / nullif(mean_volume_20, 0)"
_LAST = "OVER (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _last(c: str) -> str:
    """A row without the value has no block of its own: it shows the window of the last row that has one."""
    return f"last_value({c}) IGNORE NULLS {_LAST}"


_WEEK, _MONTH, _QUARTER = _spread("r5", 1, 5, "r1"), _spread("r20", 5, 4, "r5"), _spread("r60", 20, 3, "r20")
_SPARK = (
    Recipe()
    .add(**{f"close_{n}": back("close", n) for n in RETURNS}, prev_close=back("close", 1), dollar_volume="close * volume", **SUMS[0], **ENDS[0])
    .add(**_RETURNS, true_range=_TRUE_RANGE, known_volume="CAST(volume AS DOUBLE)", known_dollars="CAST(dollar_volume AS DOUBLE)")
    .add(sum_r1="return_1d", square_r1="return_1d * CAST(0 AS DOUBLE)")
    .add(**SUMS[1], **ENDS[1], volume_5=block("known_volume", 1, 5, True), ranges_7=block("true_range", 1, 7, True), **_WEEK[0])
    .add(**means(20, 50), **_WEEK[1], **_MOVES)
    # the trend is told here: with all other columns behind the last window, the generated code is too long to be compiled
    .add(**_DISTANCES, **_RANGES[20], **_DRAWDOWNS[20])
    .add(trend_state=TREND)
    .add(**SUMS[2], **ENDS[2], volume_20=block("volume_5", 5, 4, True), ranges_14=block("ranges_7", 7, 2, True), **_MONTH[0])
    .add(**means(100, 200), **_MONTH[1])
    .add(**_ABOVE, **_RANGES[60], **_DRAWDOWNS[60])
    .add(dollars_20=in_order("known_dollars", 20), **_QUARTER[0])
    .add(**_QUARTER[1])
    .add(
        adv_20=f"{_last('dollars_20')} / 20",
        mean_volume_20=f"{_last('volume_20')} / 20",
        **{f"volatility_{n}d": f"sqrt({_last(f'square_r{n}')} / {n}) * sqrt(CAST(252 AS DOUBLE))" for n in (20, 60)},
        atr_14=f"{_last('ranges_14')} / 14",
    )
    .add(relative_volume_20=_RELATIVE)
)
_SQL = (
    Recipe()
    .add(
        **{f"close_{n}": f"lag(close, {n}) {_EACH}" for n in RETURNS},
        **{f"ma_{n}": full("avg(close)", n) for n in AVERAGES},
        **{f"{f}_{n}": full(f"{f}(close)", n) for n in (20, 60) for f in ("max", "min")},
        number=f"row_number() {_EACH}",
        prev_close=f"lag(close, 1) {_EACH}",
        dollar_volume="close * volume",
    )
    .add(**_RETURNS, **_DISTANCES, **_ABOVE, **_RANGES[20], **_RANGES[60], **_DRAWDOWNS[20], **_DRAWDOWNS[60], true_range=_TRUE_RANGE)
    .add(volumes_seen=running("volume"), returns_seen=running("return_1d"), ranges_seen=running("true_range"))
    .add(
        adv_20=existing("avg(dollar_volume)", 20, "volumes_seen"),
        mean_volume_20=existing("avg(volume)", 20, "volumes_seen"),
        **{f"volatility_{n}d": existing("stddev_pop(return_1d)", n, "returns_seen").replace(" END", " * sqrt(CAST(252 AS DOUBLE)) END") for n in (20, 60)},
        atr_14=existing("avg(true_range)", 14, "ranges_seen"),
    )
    .add(relative_volume_20=_RELATIVE, **_MOVES)
)
_SCORE = {"liquidity_score": row_mean(clamp("adv_20 / 10000000", 0), clamp("relative_volume_20 / 2", 0))}
_SHARE = {"volume_share": "dollar_volume / nullif(adv_20, 0)"}
#: (symbol, trade_date, open, high, low, close, volume) to the full panel.
PANEL = Recipe().where("close IS NOT NULL").either(_SPARK.add(**_SCORE, **_SHARE), _SQL.add(**_SCORE, trend_state=TREND, **_SHARE))
COLUMNS = [
    "symbol", "trade_date", "close", *(f"return_{n}d" for n in RETURNS), *(f"ma_{n}" for n in AVERAGES), "distance_ma_20", "distance_ma_50",
    *(f"above_ma_{n}" for n in AVERAGES), "range_20d", "range_60d", "drawdown_20d", "drawdown_60d", "volatility_20d", "volatility_60d",
    "true_range", "atr_14", "dollar_volume", "adv_20", "relative_volume_20", "liquidity_score", "trend_state",
]
#: Days by trend state.
TREND_HISTOGRAM = PANEL.group(["trade_date", "trend_state"], symbols="count(*)")
