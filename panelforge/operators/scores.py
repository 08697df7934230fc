"""Row scores: option metrics, earnings, fundamentals, flows and positioning."""

from __future__ import annotations

from panelforge.plans.recipe import Recipe, case, clamp, lookup, row_mean, rounded

OPTIONS = (
    Recipe()
    .add(
        iv_level=row_mean("iv_30d", "iv_60d"),
        realized_vs_implied=clamp("(iv_30d - rv_20d) / greatest(abs(iv_30d), abs(rv_20d), CAST(0.000000001 AS DOUBLE))"),
        iv_rank_score=row_mean(clamp("iv_rank / 100 * 2 - 1"), clamp("iv_percentile / 100 * 2 - 1")),
        put_call_pressure=clamp("1 - put_call_ratio"),
        call_pressure=clamp("2 * coalesce(call_volume, 0) / nullif(coalesce(call_volume, 0) + coalesce(put_volume, 0), 0) - 1"),
        gamma_pressure=clamp("gamma_exposure / 10000000"),
        skew_pressure=clamp("-skew_25_delta"),
        term_structure=clamp("term_slope"),
    )
    .add(
        options_regime=case(
            ("iv_level IS NULL AND realized_vs_implied IS NULL", "INSUFFICIENT_DATA"),
            ("iv_level >= 0.7 AND realized_vs_implied > 0.15", "HIGH_VOLATILITY"),
            ("iv_level <= 0.25 AND realized_vs_implied < -0.15", "LOW_VOLATILITY"),
            ("abs(realized_vs_implied) < 0.1", "MIXED_OPTIONS"),
            ("put_call_pressure < -0.2", "HEDGING_PRESSURE"),
            ("skew_pressure > 0.2", "SKEWED_PROTECTIVE"),
            default="MIXED_OPTIONS",
        )
    )
)
OPTIONS_COLUMNS = ["symbol", "iv_level", "realized_vs_implied", "iv_rank_score", "put_call_pressure", "call_pressure", "gamma_pressure", "skew_pressure", "term_structure", "options_regime"]

#: Scores of guidance words.
GUIDANCE = {
    "raise": 1.0, "raised": 1.0, "positive": 1.0, "positive_guidance": 1.0, "beat_and_raise": 1.0, "reaffirm": 0.3, "reaffirmed": 0.3,
    "mixed": 0.0, "neutral": 0.0, "hold": 0.0, "lower": -1.0, "lowered": -1.0, "negative": -1.0, "negative_guidance": -1.0, "withdraw": -0.5, "withdrew": -0.5,
}
#: Scores of revision words.
REVISIONS = {
    "positive": 1.0, "up": 1.0, "raised": 1.0, "improving": 0.7, "flat": 0.0, "neutral": 0.0, "mixed": 0.0,
    "negative": -1.0, "down": -1.0, "lowered": -1.0, "deteriorating": -0.7,
}


def _surprise(actual: str, estimate: str) -> str:
    return clamp(f"({actual} - {estimate}) / (CASE WHEN {estimate} = 0 THEN greatest(abs({actual}), CAST(1 AS DOUBLE)) ELSE abs({estimate}) END)")


def _word(column: str, table: dict) -> str:
    return f"CASE WHEN {column} IS NULL THEN NULL ELSE {lookup(f'lower(trim({column}))', table, 'CAST(0 AS DOUBLE)')} END"


#: ``as_of`` is the observation date.
EARNINGS = (
    Recipe()
    .add(
        days_to=("datediff(earnings_date, as_of)", "date_diff('day', as_of, earnings_date)"),
        eps_surprise=_surprise("eps_actual", "eps_estimate"),
        revenue_surprise=_surprise("revenue_actual", "revenue_estimate"),
        guidance_score=_word("guidance", GUIDANCE),
        revision_score=_word("revision", REVISIONS),
        pre_drift=clamp("pre_change_5d / 10"),
        post_reaction=clamp(row_mean("(post_change_1d / 10)", "(post_change_5d / 20)")),
        implied_vs_actual=clamp("CASE WHEN implied_move = 0 THEN actual_move / 10 ELSE (actual_move - implied_move) / abs(implied_move) END"),
    )
    .add(quality_mean=row_mean("eps_surprise", "revenue_surprise", "guidance_score", "revision_score", "pre_drift", "post_reaction", "implied_vs_actual"))
    .add(earnings_quality=rounded("quality_mean", 3))
    .add(
        earnings_risk="CASE WHEN earnings_quality IS NULL AND days_to IS NULL THEN NULL ELSE "
        + rounded(clamp("(1 - coalesce(earnings_quality, 0)) / 2 + CASE WHEN days_to IS NULL THEN CAST(0 AS DOUBLE) WHEN days_to > 21 THEN CAST(0.15 AS DOUBLE) WHEN days_to > 7 THEN CAST(0.08 AS DOUBLE) WHEN days_to >= 0 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END", 0), 3)
        + " END"
    )
    .add(
        earnings_regime=case(
            ("earnings_quality IS NULL AND days_to IS NULL", "INSUFFICIENT_DATA"),
            ("days_to > 0", "UPCOMING_EARNINGS_RISK"),
            ("days_to <= 0 AND post_reaction >= 0.25", "POSITIVE_EARNINGS_REACTION"),
            ("days_to <= 0 AND post_reaction <= -0.25", "NEGATIVE_EARNINGS_REACTION"),
            ("earnings_quality >= 0.5 AND earnings_risk <= 0.5", "STRONG_EARNINGS_QUALITY"),
            ("earnings_quality <= -0.35 AND earnings_risk >= 0.4", "WEAK_EARNINGS_QUALITY"),
            default="MIXED_EARNINGS",
        )
    )
)
EARNINGS_COLUMNS = ["symbol", "days_to", "eps_surprise", "revenue_surprise", "guidance_score", "revision_score", "pre_drift", "post_reaction", "implied_vs_actual", "earnings_quality", "earnings_risk", "earnings_regime"]

FUNDAMENTALS = (
    Recipe()
    .add(
        growth_score=row_mean(clamp("revenue_growth"), clamp("eps_growth")),
        profitability_score=row_mean(clamp("gross_margin"), clamp("operating_margin"), clamp("net_margin"), clamp("roe")),
        balance_score=row_mean(clamp("1 - debt_to_equity / 2"), clamp("(current_ratio - 1) / 2")),
        valuation_score=row_mean(*(clamp(f"1 - {x} / 30") for x in ("pe", "forward_pe", "price_to_sales", "price_to_fcf"))),
        cash_flow_score=row_mean(clamp("free_cash_flow / 100000000000"), clamp("fcf_margin")),
    )
    .add(composite=row_mean("growth_score", "profitability_score", "balance_score", "valuation_score", "cash_flow_score"))
    .add(
        fundamental_label=case(
            ("composite IS NULL", "INSUFFICIENT_DATA"),
            ("composite >= 0.55", "STRONG_FUNDAMENTALS"),
            ("composite >= 0.25", "HEALTHY_FUNDAMENTALS"),
            ("composite <= -0.15", "DISTRESSED_FUNDAMENTALS"),
            ("composite <= -0.05", "WEAK_FUNDAMENTALS"),
            default="MIXED_FUNDAMENTALS",
        )
    )
)
FUNDAMENTALS_COLUMNS = ["symbol", "growth_score", "profitability_score", "balance_score", "valuation_score", "cash_flow_score", "composite", "fundamental_label"]

#: (flow_date, symbol, flow_1d, flow_5d, flow_20d, aum, ratios, futures percentile, short interest, exposures).
FLOWS = (
    Recipe()
    .add(
        equity_part=clamp("(coalesce(flow_1d, 0) + coalesce(flow_5d, 0) + coalesce(flow_20d, 0)) / 3 / nullif(aum, 0) * 100000000"),
        defensive_part="CASE WHEN symbol IN ('XLP', 'XLU', 'XLV') THEN " + clamp("-coalesce(flow_1d, 0) / 100000000") + " END",
        credit_part="CASE WHEN symbol = 'HYG' THEN " + clamp("flow_1d / nullif(aum, 0) * 100000000") + " END",
        options_part=clamp("1 - " + row_mean("put_call", "equity_put_call", "index_put_call")),
        futures_part=clamp("2 * net_percentile - 1"),
        short_part=clamp("(short_pct + least(days_to_cover / 10, CAST(1 AS DOUBLE))) / 2"),
        exposure_part=row_mean(clamp("gross_exposure / 2"), clamp("net_exposure"), clamp("-cash_level")),
    )
    .group(["flow_date"], **{n: f"avg({n}_part)" for n in ("equity", "defensive", "credit", "options", "futures", "short", "exposure")})
    .add(
        crowdedness="least(" + row_mean(*(f"abs({n})" for n in ("equity", "defensive", "credit", "options", "futures", "short", "exposure"))) + ", CAST(1 AS DOUBLE))",
        risk=clamp(row_mean("equity", "defensive", "credit", "options", "futures", "short", "exposure")),
    )
    .add(
        flow_regime=case(
            ("risk IS NULL", "INSUFFICIENT_DATA"),
            ("crowdedness >= 0.65 AND risk >= 0.25", "CROWDED_LONG"),
            ("crowdedness >= 0.65 AND risk <= -0.25", "CROWDED_SHORT"),
            ("risk <= -0.25 OR (defensive > 0.2 AND risk <= 0)", "RISK_OFF_FLOWS"),
            ("equity > 0.2 AND credit > 0 AND risk > 0", "RISK_ON_FLOWS"),
            ("abs(risk) < 0.2", "LOW_SIGNAL_POSITIONING"),
            default="MIXED_POSITIONING",
        )
    )
)
FLOWS_COLUMNS = ["flow_date", "equity", "defensive", "credit", "options", "futures", "short", "exposure", "crowdedness", "risk", "flow_regime"]
