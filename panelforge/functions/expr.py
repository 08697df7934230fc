"""Column expressions of the normalizers, as SQL for both engines. Texts that do not parse become null."""

from __future__ import annotations

from panelforge.plans.recipe import Expr

_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
TRUE, FALSE = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")


def matches(column: str, pattern: str) -> Expr:
    return f"{column} rlike '{pattern}'", f"regexp_matches({column}, '{pattern}')"


def both(template: str, **parts: Expr) -> Expr:
    """Fill a template with expressions that may differ by engine."""
    return tuple(template.format(**{k: v if isinstance(v, str) else v[i] for k, v in parts.items()}) for i in (0, 1))  # type: ignore[return-value]


def safe_text(c: str) -> str:
    return f"nullif(trim({c}), '')"


def safe_bool(c: str, default: str = "NULL") -> str:
    t = f"lower(trim({c}))"
    quoted = lambda names: ", ".join(f"'{n}'" for n in names)
    return f"(CASE WHEN {t} IN ({quoted(TRUE)}) THEN true WHEN {t} IN ({quoted(FALSE)}) THEN false ELSE {default} END)"


def safe_number(c: str) -> Expr:
    return both(f"(CASE WHEN {{m}} THEN try_cast(trim({c}) AS DOUBLE) END)", m=matches(f"trim({c})", _NUMBER))


def safe_integer(c: str) -> Expr:
    return both(f"(CASE WHEN {{m}} THEN try_cast(trim({c}) AS BIGINT) END)", m=matches(f"trim({c})", "^[+-]?[0-9]+$"))


def safe_date(c: str) -> Expr:
    return both(f"(CASE WHEN {{m}} THEN try_cast(trim({c}) AS DATE) END)", m=matches(f"trim({c})", "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))


def symbol(c: str) -> str:
    return f"upper({safe_text(c)})"


def day_of_seconds(seconds: str) -> Expr:
    """Day of seconds since 1970; null beyond the year 9999."""
    days = f"try_cast(floor({seconds} / 86400) AS INT)"
    inside = f"{days} BETWEEN -719162 AND 2932896"
    return f"CASE WHEN {inside} THEN date_add(DATE '1970-01-01', {days}) END", f"CASE WHEN {inside} THEN (DATE '1970-01-01' + {days}) END"


def epoch_day_by_digits(c: str) -> Expr:
    """19 digits or more are nanoseconds, 16 microseconds, 13 milliseconds, fewer seconds; ISO dates pass."""
    n = f"length(trim({c}))"
    scale = f"(CASE WHEN {n} >= 19 THEN CAST(1000000000 AS DOUBLE) WHEN {n} >= 16 THEN CAST(1000000 AS DOUBLE) WHEN {n} >= 13 THEN CAST(1000 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END)"
    seconds = f"(try_cast(trim({c}) AS DOUBLE) / {scale})"
    return both("(CASE WHEN {digits} THEN ({day}) WHEN {iso} THEN try_cast(substr(trim(" + c + "), 1, 10) AS DATE) END)", digits=matches(f"trim({c})", "^[0-9]+$"), day=day_of_seconds(seconds), iso=matches(f"trim({c})", "^[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"))


def epoch_day_by_size(c: str) -> Expr:
    """From 10**18 on nanoseconds, from 10**15 microseconds, else seconds; ten characters are an ISO date."""
    v = f"try_cast(trim({c}) AS DOUBLE)"
    seconds = f"(CASE WHEN {v} >= 1e18 THEN {v} / 1e9 WHEN {v} >= 1e15 THEN {v} / 1e6 ELSE {v} END)"
    return both("(CASE WHEN length(trim(" + c + ")) = 10 THEN (CASE WHEN {iso} THEN try_cast(trim(" + c + ") AS DATE) END) WHEN {digits} THEN ({day}) END)", iso=matches(f"trim({c})", "^[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]$"), digits=matches(f"trim({c})", "^[0-9]+$"), day=day_of_seconds(seconds))


def reasons(**rules: Expr) -> Expr:
    """Names of the rules whose failing condition holds, in order, joined by commas; empty if none does."""
    parts = {f"p{i}": e for i, e in enumerate(rules.values())}
    text = ", ".join(f"CASE WHEN {{p{i}}} THEN '{name}' END" for i, name in enumerate(rules))
    return both(f"concat_ws(',', {text})", **parts)


def safe_datetime(c: str) -> Expr:
    """ISO date or time; ``Z`` is UTC, an offset is applied, none means UTC, whatever the session's zone."""
    text = f"replace(trim({c}), 'Z', '+00:00')"
    pattern = "^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?([+-][0-9]{2}:[0-9]{2})?)?$"
    m, shifted = matches(text, pattern), matches(text, "T?[0-9]{2}:[0-9]{2}[0-9:.]*[+-][0-9]{2}:[0-9]{2}$")
    minutes = f"(CAST(substr({text}, -5, 2) AS INTEGER) * 60 + CAST(substr({text}, -2) AS INTEGER)) * (CASE WHEN substr({text}, -6, 1) = '-' THEN -1 ELSE 1 END)"
    plain = f"try_cast(substr({text}, 1, length({text}) - 6) AS TIMESTAMP) - to_minutes({minutes})"
    timed = f"regexp_replace({text}, '([T ][0-9][0-9]:[0-9][0-9])([+-]|$)', '$1:00$2')"
    zoned = f"CASE WHEN {shifted[0]} THEN {timed} WHEN length({text}) = 10 THEN {text} || 'T00:00:00+00:00' ELSE {timed} || '+00:00' END"
    return f"(CASE WHEN {m[0]} THEN try_cast({zoned} AS TIMESTAMP) END)", f"(CASE WHEN NOT {m[1]} THEN NULL WHEN {shifted[1]} THEN {plain} ELSE try_cast({text} AS TIMESTAMP) END)"


def first_present(json: str, *keys: str) -> Expr:
    """Value, as text, of the first of ``keys`` that the object has."""
    spark = " ".join(f"WHEN array_contains(json_object_keys({json}), '{k}') THEN get_json_object({json}, '$.{k}')" for k in keys)
    duck = " ".join(f"WHEN list_contains(json_keys({json}), '{k}') THEN json_extract_string({json}, '$.{k}')" for k in keys)
    return f"(CASE {spark} END)", f"(CASE WHEN NOT json_valid({json}) THEN NULL {duck} END)"
