"""Quality rules, acceptance policies, summaries and profiles."""

from __future__ import annotations

from panelforge.functions import expr as x
from panelforge.plans.recipe import Expr, Recipe, listed

_PAIR = [("high", ">=", "low", "gte"), ("high", ">=", "open", "gte"), ("high", ">=", "close", "gte"), ("low", "<=", "open", "lte"), ("low", "<=", "close", "lte")]
#: Failing condition of each rule of a bar; a relation is judged only where both sides are there.
BAR_RULES: dict[str, Expr] = {
    "timestamp_present": "trade_date IS NULL",
    "symbol_present": "coalesce(symbol, '') = ''",
    "timeframe_present": "coalesce(timeframe, '') = ''",
    **{f"{p}_present": f"{p} IS NULL" for p in ("open", "high", "low", "close")},
    **{f"{a}_{word}_{b}": f"NOT ({a} {op} {b})" for a, op, b, word in _PAIR},
    "volume_non_negative": "volume < 0",
    "adjusted_boolean": "adjusted IS NULL",
}
#: Whether a rule is judged at all.
_JUDGED = {**{f"{a}_{word}_{b}": f"{a} IS NOT NULL AND {b} IS NOT NULL" for a, _, b, word in _PAIR}, "volume_non_negative": "volume IS NOT NULL"}

#: Bars with typed but unchecked columns in; failed rules and what remains valid out.
CHECKED = Recipe().add(failures=x.reasons(**BAR_RULES)).add(valid="failures = ''")


def rule_counts(rules: dict[str, Expr], judged: dict[str, str]) -> Recipe:
    """One row: judged and failed rows of each rule, in one pass."""
    return Recipe().group(
        [],
        rows="count(*)",
        **{f"judged_{r}": f"count(CASE WHEN {judged.get(r, 'true')} THEN 1 END)" for r in rules},
        **{f"failed_{r}": f"count(CASE WHEN {e} THEN 1 END)" for r, e in rules.items()},
    )


def totals(rules: dict[str, Expr]) -> Recipe:
    add = " + ".join
    return Recipe().add(total=add(f"judged_{r}" for r in rules), failed=add(f"failed_{r}" for r in rules)).add(passed="total - failed", status="CASE WHEN failed = 0 THEN 'pass' ELSE 'fail' END")


RULE_SUMMARY = rule_counts(BAR_RULES, _JUDGED).then(totals(BAR_RULES))
DUPLICATES = Recipe().group(["symbol", "trade_date", "timeframe", "adjusted"], n="count(*)").where("n > 1")
_KEY = "PARTITION BY symbol, trade_date, timeframe, adjusted ORDER BY seq"

#: First row of a key decides, later ones are duplicates even of a rejected one.
ACCEPT_FIRST = (
    CHECKED.add(place=f"row_number() OVER ({_KEY})")
    .add(decision="CASE WHEN place > 1 THEN 'DUPLICATE' WHEN NOT valid THEN 'REJECTED' ELSE 'ACCEPTED' END")
    .group(["symbol", "decision"], n="count(*)")
)
#: The three policies of accepting rows with errors and duplicates.
POLICIES = (
    CHECKED.add(later=f"row_number() OVER ({_KEY}) > 1", batch_bad="bool_or(NOT valid) OVER (PARTITION BY symbol)", batch_twice="count(*) OVER (PARTITION BY symbol, trade_date, timeframe, adjusted) > 1")
    .add(any_twice="bool_or(batch_twice) OVER (PARTITION BY symbol)")
    .group(
        ["symbol"],
        rows="count(*)",
        row_accepted="count(CASE WHEN valid THEN 1 END)",
        row_dedupe_accepted="count(CASE WHEN valid AND NOT later THEN 1 END)",
        batch_accepted="count(CASE WHEN NOT batch_bad AND NOT any_twice THEN 1 END)",
    )
)
#: Failed rows of a series: counts by reason, the first five failed days, first and last day.
FAILURES = (
    CHECKED.add(bad_place="CASE WHEN NOT valid THEN row_number() OVER (PARTITION BY symbol, valid ORDER BY trade_date NULLS LAST, seq) END")
    .group(
        ["symbol"],
        rows="count(*)",
        failed="count(CASE WHEN NOT valid THEN 1 END)",
        first_failed=listed("CASE WHEN bad_place <= 5 THEN trade_date END", "bad_place"),
        first_day="min(trade_date)",
        last_day="max(trade_date)",
    )
)
#: What a raw text file holds, in one pass.
FILE_PROFILE = Recipe().group(
    [],
    rows="count(*)",
    symbols=f"count(DISTINCT upper({x.safe_text('ticker')}))",
    blank_symbols=f"count(CASE WHEN {x.safe_text('ticker')} IS NULL THEN 1 END)",
    **{f"unparsed_{c}": x.both(f"count(CASE WHEN trim({c}) <> '' AND {{v}} IS NULL THEN 1 END)", v=x.safe_number(c)) for c in ("open", "high", "low", "close", "volume", "transactions")},
    **{f"blank_{c}": f"count(CASE WHEN trim({c}) = '' THEN 1 END)" for c in ("open", "volume", "transactions")},
    first_day=x.both("min({v})", v=x.safe_date("date")),
    last_day=x.both("max({v})", v=x.safe_date("date")),
)
