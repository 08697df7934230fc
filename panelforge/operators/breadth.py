"""Market breadth of each day: advances and declines, shares above averages, new highs and lows, participation."""

from __future__ import annotations

from panelforge.operators.prices import AVERAGES, SUMS, back, extreme, full, means
from panelforge.plans.recipe import Recipe, case, row_mean

_EACH = "OVER (PARTITION BY symbol ORDER BY trade_date)"
#: 252 rows are five blocks of fifty and two rows.
_OLDEST = f"{back('close', 250)}, {back('close', 251)}"
_YEAR = (
    {f"{f}_5": extreme(f, "close", 1, 5) for f in ("greatest", "least")},
    {f"{f}_50": extreme(f, f"{f}_5", 5, 10) for f in ("greatest", "least")},
    {f"{n}_252": f"CASE WHEN {back('close', 251)} IS NOT NULL THEN {f}({extreme(f, f'{f}_50', 50, 5)}, {_OLDEST}) END" for n, f in (("high", "greatest"), ("low", "least"))},
)
#: Per symbol and day; the cross-section is taken afterwards, so only narrow rows meet by date.
SYMBOLS = (
    Recipe()
    .where("close IS NOT NULL")
    .either(
        Recipe().add(prev_close=back("close", 1), **SUMS[0], **_YEAR[0]).add(**SUMS[1], **_YEAR[1]).add(**SUMS[2], **_YEAR[2]).add(**means(*AVERAGES)),
        Recipe().add(
            prev_close=f"lag(close, 1) {_EACH}",
            **{f"ma_{n}": full("avg(close)", n) for n in AVERAGES},
            high_252=full("max(close)", 252),
            low_252=full("min(close)", 252),
        ),
    )
    .pick("symbol", "trade_date", "close", "volume", "prev_close", "high_252", "low_252", *(f"ma_{n}" for n in AVERAGES))
)
#: (symbol, trade_date, close, volume) to one row for each day.
BREADTH = (
    SYMBOLS.group(
        ["trade_date"],
        advancers="count(CASE WHEN close > prev_close THEN 1 END)",
        decliners="count(CASE WHEN close < prev_close THEN 1 END)",
        unchanged="count(CASE WHEN close = prev_close THEN 1 END)",
        advancing_volume="coalesce(sum(CASE WHEN close > prev_close THEN volume END), 0)",
        declining_volume="coalesce(sum(CASE WHEN close < prev_close THEN volume END), 0)",
        new_highs="count(CASE WHEN close >= high_252 THEN 1 END)",
        new_lows="count(CASE WHEN close <= low_252 THEN 1 END)",
        **{f"pct_above_{n}": f"avg(CASE WHEN ma_{n} IS NULL THEN NULL WHEN close > ma_{n} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)" for n in AVERAGES},
    )
    .add(
        ad_ratio="CASE WHEN decliners = 0 THEN CAST(advancers AS DOUBLE) ELSE advancers / CAST(decliners AS DOUBLE) END",
        ad_line="advancers - decliners",
        observed="advancers + decliners + unchanged",
        participation_score=row_mean("pct_above_20", "pct_above_50", "pct_above_200"),
        advancing_share="advancing_volume / nullif(advancing_volume + declining_volume, 0)",
    )
    .add(
        breadth_score="(advancers - decliners) / nullif(CAST(observed AS DOUBLE), 0)",
        advancer_share="advancers / nullif(CAST(observed AS DOUBLE), 0)",
        decliner_share="decliners / nullif(CAST(observed AS DOUBLE), 0)",
    )
    .add(
        participation_label=case(
            ("breadth_score IS NULL OR participation_score IS NULL", "INSUFFICIENT_DATA"),
            ("advancer_share >= 0.55 AND breadth_score > 0.2 AND participation_score >= 0.55", "BROAD_STRENGTH"),
            ("decliner_share >= 0.55 AND breadth_score < -0.2 AND participation_score <= 0.45", "BROAD_WEAKNESS"),
            ("breadth_score > 0 AND participation_score < 0.4", "NARROW_PARTICIPATION"),
            default="MIXED_PARTICIPATION",
        )
    )
)
COLUMNS = [
    "trade_date", "advancers", "decliners", "unchanged", "observed", "advancing_volume", "declining_volume", "new_highs", "new_lows",
    *(f"pct_above_{n}" for n in AVERAGES), "ad_ratio", "ad_line", "participation_score", "advancing_share", "breadth_score", "participation_label",
]
