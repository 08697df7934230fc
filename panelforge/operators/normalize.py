"""Normalizers: raw text rows to typed rows with the reasons for which a row is rejected."""

from __future__ import annotations

from panelforge.functions import expr as x
from panelforge.functions.expr import both
from panelforge.plans.recipe import Recipe, lookup, sha256

PRICES = ("open", "high", "low", "close")
#: Kinds of instruments by vendor code; other codes pass in lower case.
ASSET_TYPES = {"cs": "equity", "common stock": "equity", "stock": "equity", "etf": "etf", "index": "index"}

#: (ticker, date, open, high, low, close, volume, transactions, adjusted), all text.
STOCK_DAY = (
    Recipe()
    .add(
        symbol=x.safe_text("ticker"),
        trade_date=x.safe_date("date"),
        **{f"{p}_value": x.safe_number(p) for p in PRICES},
        volume_value=x.safe_number("volume"),
        transactions_value=x.safe_integer("transactions"),
        is_adjusted=x.safe_bool("adjusted", "false"),
    )
    .settled()
    .add(
        reasons=x.reasons(
            missing_symbol="symbol IS NULL",
            invalid_trade_date="trade_date IS NULL",
            **{f"invalid_{p}": f"{p}_value IS NULL" for p in PRICES},
            invalid_volume="volume_value IS NULL",
            invalid_transactions="trim(transactions) <> '' AND transactions_value IS NULL",
        )
    )
    .add(accepted="reasons = ''")
)
STOCK_COLUMNS = ["ticker", "symbol", "trade_date", *(f"{p}_value" for p in PRICES), "volume_value", "transactions_value", "is_adjusted", "reasons", "accepted"]

#: Accepted rows as canonical bars.
CANONICAL_BARS = STOCK_DAY.where("accepted").pick(symbol="upper(symbol)", trade_date="trade_date", **{p: f"{p}_value" for p in PRICES}, volume="volume_value", adjusted="is_adjusted", timeframe="'1d'", vendor="'vendor'", dataset_version="'v1'", file_sha="'abc'", seq="ticker || date || open || close")
#: The keys of every joiner.
KEYS = (
    Recipe()
    .add(adjustment_status="CASE WHEN adjusted THEN 'adjusted' ELSE 'unadjusted' END")
    .add(
        handoff_key=sha256("vendor", "'equity'", "symbol", "trade_date", "dataset_version", "file_sha", "adjustment_status"),
        flow_key=sha256("vendor", "dataset_version", "file_sha", "trade_date", "symbol", "'1d'"),
        nul_key=sha256("vendor", "symbol", "trade_date", nul=True),
        identity_key=sha256("symbol", "vendor", "timeframe", "adjustment_status", "dataset_version"),
    )
    .add(key_prefix="substr(handoff_key, 1, 12)", news_id="'news-' || substr(nul_key, 1, 24)")
)
CANONICAL = CANONICAL_BARS.then(KEYS)
CANONICAL_COLUMNS = ["symbol", "trade_date", *PRICES, "volume", "adjusted", "timeframe", "adjustment_status", "handoff_key", "flow_key", "nul_key", "identity_key", "key_prefix", "news_id"]

#: (ticker, volume, transactions, high, low): contract parts, warnings, and whether the row is dropped.
OPTION_SYMBOLS = (
    Recipe()
    .add(working="CASE WHEN substr(ticker, 1, 2) = 'O:' THEN substr(ticker, 3) ELSE ticker END")
    .add(size="length(working)", tail="CASE WHEN length(working) >= 15 THEN substr(working, length(working) - 14) END")
    .add(
        underlying_text="CASE WHEN size > 15 THEN substr(working, 1, size - 15) END",
        shape_ok=x.matches("tail", "^[0-9]{6}[CP][0-9]{8}$"),
    )
    .add(expiration_try="CASE WHEN shape_ok THEN try_cast('20' || substr(tail, 1, 2) || '-' || substr(tail, 3, 2) || '-' || substr(tail, 5, 2) AS DATE) END")
    .add(
        warning="CASE WHEN ticker IS NULL OR size < 15 THEN 'symbol too short' WHEN underlying_text IS NULL OR NOT shape_ok THEN 'symbol format not recognized' WHEN expiration_try IS NULL THEN 'symbol parse failed' END",
    )
    .add(parse_ok="warning IS NULL")
    .add(
        underlying="CASE WHEN parse_ok THEN underlying_text END",
        expiration="CASE WHEN parse_ok THEN expiration_try END",
        option_type="CASE WHEN parse_ok THEN substr(tail, 7, 1) END",
        strike="CASE WHEN parse_ok THEN CAST(substr(tail, 8) AS BIGINT) / CAST(1000 AS DOUBLE) END",
        errors=x.reasons(NEGATIVE_VOLUME="volume < 0", NEGATIVE_TRANSACTIONS="NOT (volume < 0) AND transactions < 0"),
        row_warnings=x.reasons(symbol="NOT parse_ok", high_lower_than_low="high < low"),
    )
)
OPTION_COLUMNS = ["ticker", "underlying", "expiration", "option_type", "strike", "parse_ok", "warning", "errors", "row_warnings"]

#: Vendor reference rows to the symbol master, with its checks.
SYMBOL_MASTER = (
    Recipe()
    .add(symbol=x.safe_text("ticker"), active_flag="CASE WHEN active IS NOT NULL THEN active WHEN delisted IS NOT NULL THEN NOT delisted END", kind="lower(" + x.safe_text("type") + ")")
    .add(
        asset_type=lookup("kind", {k: f"'{v}'" for k, v in ASSET_TYPES.items()}, "kind"),
        exchange_code=x.safe_text("exchange"),
        full_name=x.safe_text("name"),
        currency_code="coalesce(" + x.safe_text("currency") + ", 'USD')",
        quality_status="CASE WHEN active_flag THEN 'pass' WHEN NOT active_flag THEN 'warn' END",
        errors=x.reasons(symbol_present="symbol IS NULL", active_boolean="active_flag IS NULL"),
    )
    .add(identity_key=both("CASE WHEN symbol IS NOT NULL AND coalesce(trim(asset_type), '') <> '' THEN {digest} END", digest=sha256("'vendor'", "'reference_tickers'", "'abc'", "asset_type", "symbol")))
)
SYMBOL_COLUMNS = ["symbol", "full_name", "asset_type", "exchange_code", "currency_code", "active_flag", "quality_status", "identity_key", "errors"]

#: Texts of epochs and dates by both rules.
EPOCHS = Recipe().add(by_digits=x.epoch_day_by_digits("stamp"), by_size=x.epoch_day_by_size("stamp"))
