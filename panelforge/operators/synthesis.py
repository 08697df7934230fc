"""Synthesis of a day's states: macro liquidity, then market risk, then market regime, and the evidence state.

A state that a table does not know, or that is missing, scores 0; only the explicit insufficient states score null.
"""

from __future__ import annotations

from panelforge.operators.calendar_news import state_text
from panelforge.plans.recipe import Recipe, case, clamp, json_digest, lookup, rounded, row_mean

#: Scores of states, by layer and component.
TABLES = {
    "macro": {
        "rates_state": {"STRONG_LIQUIDITY_TAILWIND": 1.0, "LIQUIDITY_TAILWIND": 0.75, "MIXED_MACRO_LIQUIDITY": 0.0, "LIQUIDITY_HEADWIND": -0.75, "STRONG_LIQUIDITY_HEADWIND": -1.0, "INSUFFICIENT_DATA": None},
        "cross_state": {"RISK_ON": 0.75, "RISK_ON_EVIDENCE": 0.75, "MIXED_EVIDENCE": 0.0, "RISK_OFF": -0.75, "RISK_OFF_EVIDENCE": -0.75, "INSUFFICIENT_EVIDENCE": None},
        "flow_state": {"TIGHT_FLOW_CONDITIONS": -1.0, "FLOW_HEADWIND": -0.75, "MIXED_POSITIONING": 0.0, "FLOW_TAILWIND": 0.75, "EASY_FLOW_CONDITIONS": 1.0, "INSUFFICIENT_DATA": None},
        "volatility_state": {"LOW_VOLATILITY": 1.0, "NORMAL_VOLATILITY": 0.5, "ELEVATED_VOLATILITY": -0.25, "HIGH_VOLATILITY": -0.75, "EXTREME_VOLATILITY": -1.0, "MIXED_VOLATILITY": 0.0, "INSUFFICIENT_DATA": None},
        "breadth_state": {"BROAD_PARTICIPATION": 1.0, "HEALTHY_PARTICIPATION": 0.75, "MIXED_PARTICIPATION": 0.0, "NARROW_PARTICIPATION": -0.75, "DIVERGENT_PARTICIPATION": -0.5, "INSUFFICIENT_DATA": None},
        "rotation_state": {"RISK_ON_EVIDENCE": 0.75, "RISK_OFF_EVIDENCE": -0.75, "MIXED_EVIDENCE": 0.0, "INSUFFICIENT_EVIDENCE": None},
    },
    "risk": {
        "volatility_state": {"LOW_VOLATILITY": -1.0, "NORMAL_VOLATILITY": -0.25, "MIXED_VOLATILITY": 0.0, "ELEVATED_VOLATILITY": 0.5, "HIGH_VOLATILITY": 0.8, "EXTREME_VOLATILITY": 1.0, "INSUFFICIENT_DATA": None},
        "option_state": {"LOW_VOLATILITY": -0.5, "HEDGING_PRESSURE": 0.6, "SKEWED_PROTECTIVE": 0.75, "MIXED_OPTIONS": 0.0, "HIGH_VOLATILITY": 0.5, "INSUFFICIENT_DATA": None},
        "flow_state": {"EASY_FLOW_CONDITIONS": -0.5, "FLOW_TAILWIND": -0.25, "MIXED_POSITIONING": 0.0, "FLOW_HEADWIND": 0.5, "TIGHT_FLOW_CONDITIONS": 0.8, "INSUFFICIENT_DATA": None},
        "event_state": {"NO_MAJOR_EVENTS": -0.5, "LOW_EVENT_RISK": -0.25, "MODERATE_EVENT_RISK": 0.25, "HIGH_EVENT_RISK": 0.75, "EXTREME_EVENT_RISK": 1.0, "INSUFFICIENT_DATA": None},
        "news_state": {"POSITIVE_SENTIMENT": -0.5, "NEUTRAL_SENTIMENT": 0.0, "NEGATIVE_SENTIMENT": 0.6, "HIGH_NEGATIVE_SENTIMENT": 1.0, "MIXED_SENTIMENT": 0.2, "INSUFFICIENT_DATA": None},
        "breadth_state": {"BROAD_PARTICIPATION": -0.5, "HEALTHY_PARTICIPATION": -0.25, "MIXED_PARTICIPATION": 0.0, "NARROW_PARTICIPATION": 0.5, "DIVERGENT_PARTICIPATION": 0.75, "INSUFFICIENT_DATA": None},
        "macro_state": {"STRONG_LIQUIDITY_TAILWIND": -0.75, "LIQUIDITY_TAILWIND": -0.5, "MIXED_MACRO_LIQUIDITY": 0.0, "LIQUIDITY_HEADWIND": 0.6, "STRONG_LIQUIDITY_HEADWIND": 1.0, "INSUFFICIENT_DATA": None},
    },
    "regime": {
        "macro_state": {"STRONG_LIQUIDITY_TAILWIND": 1.0, "LIQUIDITY_TAILWIND": 0.75, "MIXED_MACRO_LIQUIDITY": 0.0, "LIQUIDITY_HEADWIND": -0.75, "STRONG_LIQUIDITY_HEADWIND": -1.0, "INSUFFICIENT_DATA": None},
        "risk_state": {"LOW_MARKET_RISK": 1.0, "NORMAL_MARKET_RISK": 0.5, "MIXED_MARKET_RISK": 0.0, "ELEVATED_MARKET_RISK": -0.25, "HIGH_MARKET_RISK": -0.75, "EXTREME_MARKET_RISK": -1.0, "INSUFFICIENT_DATA": None},
        "breadth_state": {"BROAD_PARTICIPATION": 1.0, "HEALTHY_PARTICIPATION": 0.75, "MIXED_PARTICIPATION": 0.0, "NARROW_PARTICIPATION": -0.75, "DIVERGENT_PARTICIPATION": -0.5, "INSUFFICIENT_DATA": None},
        "rotation_state": {"RISK_ON_LEADERSHIP": 0.75, "BROAD_IMPROVEMENT": 0.5, "NARROW_LEADERSHIP": -0.25, "DEFENSIVE_LEADERSHIP": -0.75, "BROAD_DETERIORATION": -0.5, "MIXED_ROTATION": 0.0, "NO_CLEAR_ROTATION": 0.0, "INSUFFICIENT_DATA": None},
        "cross_state": {"RISK_ON_CONFIRMATION": 0.75, "MIXED_INTERMARKET": 0.0, "EQUITY_CREDIT_DIVERGENCE": -0.25, "RATES_PRESSURE": -0.5, "DOLLAR_PRESSURE": -0.5, "RISK_OFF_PRESSURE": -0.75, "INSUFFICIENT_DATA": None},
        "volatility_state": {"LOW_VOLATILITY": 1.0, "NORMAL_VOLATILITY": 0.5, "MIXED_VOLATILITY": 0.0, "ELEVATED_VOLATILITY": -0.25, "HIGH_VOLATILITY": -0.75, "EXTREME_VOLATILITY": -1.0, "INSUFFICIENT_DATA": None},
    },
}
#: Score of each trend state, and the states of a bundle.
TREND_SCORES = {"STRONG_UPTREND": 1.0, "UPTREND": 0.5, "MIXED": 0.0, "DOWNTREND": -0.5, "STRONG_DOWNTREND": -1.0, "INSUFFICIENT_DATA": None}
STATES = ("breadth_state", "rotation_state", "cross_state", "rates_state", "volatility_state", "event_state", "news_state", "earnings_state", "macro_state", "risk_state", "regime_state", "fundamental_state", "flow_state", "option_state")


def trend_score(state: str) -> str:
    return lookup(state, TREND_SCORES, "CAST(0 AS DOUBLE)")


def _scores(layer: str) -> dict[str, str]:
    return {f"{layer}_{c[:-6]}": lookup(state_text(c), t, "CAST(0 AS DOUBLE)") for c, t in TABLES[layer].items()}


def _has(text: str) -> str:
    return " OR ".join(f"{s} LIKE '%{text}%'" for s in STATES)


#: Columns of states (all of STATES but the three that are made here) and price_trend_score in.
SYNTHESIS = (
    Recipe()
    .add(**_scores("macro"))
    .add(macro_score=rounded(row_mean(*(clamp(c) for c in _scores("macro"))), 3))
    .add(
        macro_state=case(
            ("macro_score IS NULL", "INSUFFICIENT_DATA"),
            ("macro_score >= 0.65", "STRONG_LIQUIDITY_TAILWIND"),
            ("macro_score >= 0.2", "LIQUIDITY_TAILWIND"),
            ("macro_score <= -0.65", "STRONG_LIQUIDITY_HEADWIND"),
            ("macro_score <= -0.2", "LIQUIDITY_HEADWIND"),
            default="MIXED_MACRO_LIQUIDITY",
        )
    )
    # the options component reads the macro state wherever there is one
    .add(**{k: v for k, v in _scores("risk").items() if k != "risk_option"}, risk_option=lookup(state_text("coalesce(macro_state, option_state)"), TABLES["risk"]["option_state"], "CAST(0 AS DOUBLE)"))
    .add(risk_score=rounded(row_mean(*(clamp(c) for c in _scores("risk"))), 3))
    .add(
        risk_state=case(
            ("risk_score IS NULL", "INSUFFICIENT_DATA"),
            ("risk_score <= -0.65", "LOW_MARKET_RISK"),
            ("risk_score <= -0.2", "NORMAL_MARKET_RISK"),
            ("risk_score <= 0.2", "MIXED_MARKET_RISK"),
            ("risk_score <= 0.55", "ELEVATED_MARKET_RISK"),
            ("risk_score <= 0.85", "HIGH_MARKET_RISK"),
            default="EXTREME_MARKET_RISK",
        )
    )
    .add(**_scores("regime"))
    .add(regime_score=rounded(row_mean(*(clamp(c) for c in _scores("regime")), clamp("price_trend_score")), 3))
    .add(
        regime_state=case(
            ("regime_score IS NULL", "INSUFFICIENT_DATA"),
            ("regime_score >= 0.6", "RISK_ON_EXPANSION"),
            ("regime_score >= 0.25", "RISK_ON_FRAGILE"),
            ("regime_score <= -0.6", "STRESS_REGIME"),
            ("regime_score <= -0.25", "DEFENSIVE_RISK_OFF"),
            default="NEUTRAL_MIXED",
        )
    )
    .add(
        evidence_state=case(
            (" OR ".join(f"coalesce({s}, '') = ''" for s in STATES), "INSUFFICIENT_EVIDENCE"),
            (_has("TIGHT"), "RISK_OFF_EVIDENCE"),
            (_has("EASY"), "RISK_ON_EVIDENCE"),
            (_has("RISK_OFF"), "RISK_OFF_EVIDENCE"),
            (_has("RISK_ON"), "RISK_ON_EVIDENCE"),
            (_has("MIXED"), "MIXED_EVIDENCE"),
            default="INSUFFICIENT_EVIDENCE",
        ),
        sections_present=" + ".join(f"(CASE WHEN {s} IS NULL THEN 0 ELSE 1 END)" for s in STATES),
    )
    .add(certification="CASE WHEN evidence_state = 'INSUFFICIENT_EVIDENCE' THEN 'UNCERTIFIED' ELSE 'CERTIFIED' END")
    .add(idempotency_key=json_digest("observation_date", *STATES))
)
COLUMNS = ["observation_date", *STATES, "macro_score", "risk_score", "regime_score", "price_trend_score", "evidence_state", "sections_present", "certification", "idempotency_key"]
