"""Rows of further vendor tables to canonical columns: trimmed texts, plain numbers, ISO days, UTC times.

Inputs are texts. A text that does not parse is null; only ``OHLCV`` and ``EOD`` drop rows, those without a time or symbol.
"""

from __future__ import annotations

from panelforge.functions import expr as x
from panelforge.functions.expr import both
from panelforge.operators.records import INDEX_SYMBOLS
from panelforge.plans.recipe import Expr, Recipe, sha256


def stamp(c: Expr) -> Expr:
    """A time as text, so that both engines show it alike."""
    return both("{s}", s=(f"date_format({c[0]}, 'yyyy-MM-dd HH:mm:ss')", f"strftime({c[1]}, '%Y-%m-%d %H:%M:%S')"))


def spec(texts: str = "", numbers: str = "", days: str = "", upper: str = "", **more: Expr) -> Recipe:
    """A row's columns by kind, each list divided by blanks."""
    columns: dict[str, Expr] = {c: x.safe_text(c) for c in texts.split()}
    columns |= {c: x.safe_number(c) for c in numbers.split()}
    columns |= {c: x.safe_date(c) for c in days.split()}
    columns |= {c: x.symbol(c) for c in upper.split()}
    return Recipe().pick(**columns, **more)


#: (stamp) to the UTC time; a date alone is its midnight, a time without an offset is UTC.
TIMES = Recipe().pick("stamp", utc=stamp(x.safe_datetime("stamp")))
#: The first key that is there decides, even where its value is null.
PRESENT = Recipe().pick("event_id", picked=x.first_present("props", "symbol", "ticker", "k"))
#: Configurable names to a canonical bar; the time is required.
OHLCV = (
    Recipe()
    .add(moment=x.safe_datetime("ts_text"))
    .settled()
    .where("moment IS NOT NULL")
    .pick(
        symbol=x.safe_text("ticker"), market_time=stamp(("moment", "moment")), timeframe="coalesce(" + x.safe_text("tf") + ", '1d')", adjusted=x.safe_bool("adjusted_text", "false"),
        **{n: x.safe_number(f"{n}_text") for n in ("open", "high", "low", "close", "volume")}, vendor=x.safe_text("vendor"), quality_status=x.safe_text("quality"),
    )
)
#: End-of-day rows: the day's midnight; adjusted by the flag, else if an adjusted close is there.
EOD = (
    Recipe()
    .add(symbol="coalesce(" + x.safe_text("symbol_text") + ", " + x.safe_text("ticker") + ")", day=x.safe_date("date_text"), flag=x.safe_bool("adjusted_text"))
    .settled()
    .where("symbol IS NOT NULL AND day IS NOT NULL")
    .pick("symbol", symbol_id="symbol", market_date="day", timeframe="'1d'", adjusted="coalesce(flag, adj_close_text IS NOT NULL)", close=x.safe_number("close_text"), quality_status="'pending'")
)
FLOWS = spec("record_id record_type observation_date symbol asset_class unit source raw_source_id notes", "value")
BREADTH = spec("metric_id metric_type observation_date universe symbol source notes", "value numerator denominator")
CROSS_ASSET = spec("symbol asset_group source vendor_symbol notes", "open high low close volume", "market_date")
#: The payload stays if it is an object.
FUNDAMENTALS = spec("record_family symbol source period notes", "", "record_date", payload="CASE WHEN substr(trim(payload), 1, 1) = '{' THEN payload END")
OPTION_QUOTES = spec("contract_symbol underlying_symbol expiration_date option_type source notes", "strike bid ask last volume open_interest implied_volatility")
#: Values that are numbers already; texts, even of digits, are null.
VOL_INDEX = Recipe().pick("symbol", observation_date=x.safe_date("day_text"), value="CASE WHEN kind IN ('int', 'float') THEN raw_value END", source="source", unit="unit")
#: Tickers come as text divided by commas.
NEWS = spec("news_id published_at source publisher title summary url sentiment_label raw_source_id notes", "sentiment_score").steps[0][1]
NEWS_ROWS = Recipe().pick(
    **NEWS,
    tickers=("array_join(filter(transform(split(tickers, ','), t -> trim(t)), t -> t <> ''), ',')", "array_to_string(list_filter(list_transform(string_split(tickers, ','), lambda t: trim(t)), lambda t: t <> ''), ',')"),
)
#: Marks of links that carry secrets.
SECRETS = ("token=", "api_key", "apikey", "secret", "password", "credential")
#: Feed items to news rows; items whose link looks like a secret are told apart.
RSS = (
    Recipe()
    .add(link=x.safe_text("link_text"), headline=x.safe_text("title_text"), moment=x.safe_datetime("published_text"), guid=x.safe_text("guid_text"))
    .add(rejected="coalesce(" + " OR ".join(f"instr(lower(link), '{m}') > 0" for m in SECRETS) + ", false)", published=stamp(("moment", "moment")))
    .add(
        news_id=both("coalesce({own}, 'news-' || substr({digest}, 1, 24))", own=x.safe_text("id_text"), digest=sha256("'vendor'", "'rss'", "guid", "headline", "published", "link", nul=True)),
        source="coalesce(" + x.safe_text("source_name") + ", " + x.safe_text("source_text") + ", 'RSS Feed')",
    )
    .pick("news_id", "guid", "source", "headline", "published", "link", "rejected")
)
#: Volatility indices by their vendor's name.
VOL_SYMBOLS = {vendor: symbol for vendor, symbol in INDEX_SYMBOLS.items() if vendor != symbol}
#: Volatility observations: canonical symbol, time required, warnings for unknown symbols and sources that differ.
VOL_OBSERVATIONS = (
    Recipe()
    .add(known="CASE " + " ".join(f"WHEN vendor_symbol = '{v}' THEN '{s}'" for v, s in VOL_SYMBOLS.items()) + " END", day=x.safe_date("day_text"))
    .add(
        errors=x.reasons(timestamp_missing="ts_text IS NULL", source_missing="trim(coalesce(source, '')) = ''", symbol_missing="coalesce(known, plain_symbol) IS NULL", date_missing="day IS NULL", value_missing="value IS NULL"),
        warnings=x.reasons(unsupported_symbol="vendor_symbol IS NOT NULL AND known IS NULL", source_mismatch="source <> 'vendor_index'"),
    )
    .pick("vendor_symbol", "day", "value", "errors", "warnings", symbol="coalesce(known, plain_symbol)", index_family="'VOLATILITY'", accepted="errors = ''")
)


def only(column: str, names: tuple[str, ...] | None) -> Recipe:
    """Rows whose trimmed, upper-case value is wanted; all rows where no names are given."""
    if not names:
        return Recipe()
    return Recipe().where(f"upper(trim({column})) IN (" + ", ".join(f"'{n.strip().upper()}'" for n in names) + ")")
