"""Cross-asset, rates and volatility panels: series in rows, one row for each day out."""

from __future__ import annotations

from panelforge.plans.recipe import Recipe, case, row_mean

#: Assets, rates and volatility indices of the panels.
ASSETS = ("SPY", "QQQ", "IWM", "TLT", "HYG", "GLD", "USO", "DXY", "VIX")


def _lag(value: str, n: int, key: str, day: str) -> str:
    return f"lag({value}, {n}) OVER (PARTITION BY {key} ORDER BY {day})"


def _pivot(value: str, key: str, names: tuple[str, ...] | list[str], prefix: str) -> dict:
    return {f"{prefix}{n.lower()}": f"max(CASE WHEN {key} = '{n}' THEN {value} END)" for n in names}


#: (symbol, trade_date, close): returns of nine assets over 5, 20 and 60 rows, component scores from those over 20.
CROSS_ASSET = (
    Recipe()
    .where("close IS NOT NULL AND symbol IN (" + ", ".join(f"'{a}'" for a in ASSETS) + ")")
    .add(**{f"past_{n}": _lag("close", n, "symbol", "trade_date") for n in (5, 20, 60)})
    .add(**{f"r{n}": f"(close - past_{n}) / nullif(past_{n}, 0)" for n in (5, 20, 60)})
    .group(["trade_date"], **{k: v for n in (5, 20, 60) for k, v in _pivot(f"r{n}", "symbol", ASSETS, f"r{n}_").items()})
    .add(
        equity=row_mean("r20_spy", "r20_qqq", "r20_iwm"),
        credit="r20_hyg",
        rates="-r20_tlt",
        dollar="-r20_dxy",
        commodity="-" + row_mean("r20_gld", "r20_uso"),
        volatility="-r20_vix",
    )
    .add(alignment=row_mean("equity", "credit", "rates", "dollar", "commodity", "volatility"))
    .add(
        intermarket_state=case(
            ("coalesce(equity, credit, rates, dollar, commodity, volatility) IS NULL", "INSUFFICIENT_DATA"),
            ("alignment >= 0.02", "RISK_ON_CONFIRMATION"),
            ("equity > 0 AND credit < 0", "EQUITY_CREDIT_DIVERGENCE"),
            ("rates > 0.15", "RATES_PRESSURE"),
            ("dollar > 0.15", "DOLLAR_PRESSURE"),
            ("alignment <= -0.02", "RISK_OFF_PRESSURE"),
            default="MIXED_INTERMARKET",
        ),
        risk_on="coalesce(alignment > 0.2, false)",
        risk_off="coalesce(alignment < -0.2, false)",
    )
    .add(divergence="intermarket_state = 'EQUITY_CREDIT_DIVERGENCE'")
)
CROSS_ASSET_COLUMNS = ["trade_date", "equity", "credit", "rates", "dollar", "commodity", "volatility", "alignment", "risk_on", "risk_off", "divergence", "intermarket_state", *(f"r{n}_{a.lower()}" for n in (5, 20, 60) for a in ASSETS)]

_RATES = ("FED_FUNDS", "US10Y", "US2Y", "REAL_YIELD_10Y", "DXY", "HYG", "SPY")
_PRESSURES = ("short_rate", "long_rate", "curve", "real_yield", "dollar")
_TIGHT = " + ".join(f"(CASE WHEN {p} >= 0.15 THEN 1 ELSE 0 END)" for p in _PRESSURES)
_EASY = " + ".join(f"(CASE WHEN {p} <= -0.05 THEN 1 ELSE 0 END)" for p in _PRESSURES)
#: (series, observation_date, value): pressure scores from 20-row changes, each series by its own rows.
RATES = (
    Recipe()
    .where("value IS NOT NULL")
    .add(change="value - " + _lag("value", 20, "series", "observation_date"), past=_lag("value", 20, "series", "observation_date"))
    .group(["observation_date"], **_pivot("change", "series", _RATES, "d_"), **_pivot("value", "series", ("US10Y", "US2Y"), "v_"), **_pivot("past", "series", ("US10Y", "US2Y"), "p_"))
    .add(slope="v_us10y - v_us2y", past_slope="p_us10y - p_us2y")
    .add(
        short_rate="-" + row_mean("d_fed_funds", "d_us2y"),
        long_rate="-d_us10y",
        curve="-" + row_mean("slope", "(slope - past_slope)"),
        real_yield="-d_real_yield_10y",
        dollar="d_dxy",
        credit="d_hyg",
        equity="d_spy",
    )
    .add(
        tight=_TIGHT,
        easy=_EASY,
        ups="(CASE WHEN credit > 0 THEN 1 ELSE 0 END) + (CASE WHEN equity > 0 THEN 1 ELSE 0 END)",
        downs="(CASE WHEN credit < 0 THEN 1 ELSE 0 END) + (CASE WHEN equity < 0 THEN 1 ELSE 0 END)",
    )
    .add(
        liquidity_regime=case(
            ("coalesce(short_rate, long_rate, curve, real_yield, dollar, credit, equity) IS NULL", "INSUFFICIENT_DATA"),
            ("credit > 0 AND equity > 0 AND dollar < 0 AND short_rate <= 0.5 AND long_rate <= 0.5", "LIQUIDITY_TAILWIND"),
            ("credit < 0 AND equity < 0 AND dollar > 0 AND (short_rate > 0 OR long_rate > 0)", "LIQUIDITY_HEADWIND"),
            ("tight >= 3 AND downs >= 1", "TIGHT_FINANCIAL_CONDITIONS"),
            ("easy >= 3 AND ups >= 1", "EASY_FINANCIAL_CONDITIONS"),
            ("ups >= 2 AND tight <= 1", "LIQUIDITY_TAILWIND"),
            ("tight >= 2 AND downs >= 1", "LIQUIDITY_HEADWIND"),
            default="MIXED_LIQUIDITY",
        )
    )
)
RATES_COLUMNS = ["observation_date", "slope", "short_rate", "long_rate", "curve", "real_yield", "dollar", "credit", "equity", "liquidity_regime"]

_VOLS = ("VIX", "VVIX", "VXN", "RVX")


def _pressure(n: str) -> str:
    return f"CASE WHEN level_{n} IS NULL AND d5_{n} IS NULL THEN NULL ELSE coalesce(level_{n}, 0) / 100 + coalesce(d5_{n}, 0) END"


#: (symbol, trade_date, close): levels, absolute changes, stress as the mean of the four pressures.
VOLATILITY = (
    Recipe()
    .where("close IS NOT NULL AND symbol IN ('VIX', 'VVIX', 'VXN', 'RVX')")
    .add(**{f"past_{n}": _lag("close", n, "symbol", "trade_date") for n in (1, 5, 20)})
    .add(**{f"d{n}": f"close - past_{n}" for n in (1, 5, 20)})
    .group(["trade_date"], **_pivot("close", "symbol", _VOLS, "level_"), **_pivot("d5", "symbol", _VOLS, "d5_"), d1_vix="max(CASE WHEN symbol = 'VIX' THEN d1 END)", d20_vix="max(CASE WHEN symbol = 'VIX' THEN d20 END)")
    .add(**{f"pressure_{n.lower()}": _pressure(n.lower()) for n in _VOLS})
    .add(stress=row_mean(*(f"pressure_{n.lower()}" for n in _VOLS)))
    .add(
        volatility_regime=case(
            ("level_vix IS NULL AND stress IS NULL", "INSUFFICIENT_DATA"),
            ("level_vix < 15 AND coalesce(stress, 0) < 0.2", "LOW_VOLATILITY"),
            ("level_vix < 20 AND coalesce(stress, 0) < 0.4", "NORMAL_VOLATILITY"),
            ("level_vix < 28", "ELEVATED_VOLATILITY"),
            ("level_vix < 40", "HIGH_VOLATILITY"),
            ("level_vix IS NOT NULL", "EXTREME_VOLATILITY"),
            ("stress < 0.2", "LOW_VOLATILITY"),
            ("stress < 0.4", "NORMAL_VOLATILITY"),
            ("stress < 0.6", "ELEVATED_VOLATILITY"),
            default="MIXED_VOLATILITY",
        )
    )
)
VOLATILITY_COLUMNS = ["trade_date", *(f"level_{n.lower()}" for n in _VOLS), "d1_vix", "d20_vix", *(f"d5_{n.lower()}" for n in _VOLS), *(f"pressure_{n.lower()}" for n in _VOLS), "stress", "volatility_regime"]
