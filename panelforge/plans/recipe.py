"""Recipes: ordered steps of column expressions over one input.

Expressions are SQL that Spark and DuckDB share; where the dialects differ a pair (Spark, DuckDB) is given. ``apply``
builds a DataFrame plan, ``sql`` the equivalent query text, so that each formula is written once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Expr = str | tuple[str, str]


def _side(e: Expr, k: int) -> str:
    return e if isinstance(e, str) else e[k]


@dataclass(frozen=True)
class Recipe:
    steps: tuple = ()

    def add(self, **columns: Expr) -> Recipe:
        """New columns; they may not use each other."""
        return Recipe((*self.steps, ("add", columns)))

    def where(self, condition: Expr) -> Recipe:
        return Recipe((*self.steps, ("where", condition)))

    def group(self, keys: list[str], **aggregates: Expr) -> Recipe:
        return Recipe((*self.steps, ("group", (keys, aggregates))))

    def pick(self, *names: str, **columns: Expr) -> Recipe:
        """Only these columns, renamed or computed ones by keyword."""
        return Recipe((*self.steps, ("pick", {n: n for n in names} | columns)))

    def settled(self) -> Recipe:
        """The columns so far are computed once: what follows reads their values, as Spark repeats in a filter what it filters by."""
        return Recipe((*self.steps, ("settle", None)))

    def gathered(self, *keys: str, joined: bool = True) -> Recipe:
        """Rows of equal keys meet here; a group, window or join by these and other keys deals nothing anew.

        Spark joins small parts to one task, by their bytes on disk; ``joined`` false is for rows so narrow there that too many would meet in it."""
        return Recipe((*self.steps, ("gather", (keys, joined))))

    def either(self, spark: Recipe, sql: Recipe) -> Recipe:
        """The same columns by steps of their own in each engine; Spark may leave helper columns beside them."""
        return Recipe((*self.steps, ("either", (spark, sql))))

    def then(self, other: Recipe) -> Recipe:
        return Recipe((*self.steps, *other.steps))

    def apply(self, df: DataFrame) -> DataFrame:
        for kind, what in self.steps:
            if kind == "add":
                df = df.selectExpr("*", *[f"{_side(e, 0)} AS {n}" for n, e in what.items()])
            elif kind == "where":
                df = df.where(_side(what, 0))
            elif kind == "settle":
                # no filter moves below a generator of all columns, and no expression into it
                df = df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
            elif kind == "gather":
                keys, joined = what
                df = df.repartition(*([] if joined else [int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))]), *keys)
            elif kind == "either":
                df = what[0].apply(df)
            elif kind == "group":
                keys, aggregates = what
                df = df.groupBy(*keys).agg(*[F.expr(_side(e, 0)).alias(n) for n, e in aggregates.items()])
            else:
                df = df.selectExpr(*[f"{_side(e, 0)} AS {n}" for n, e in what.items()])
        return df

    def sql(self, source: str) -> str:
        """DuckDB text over ``source``, a table name or a parenthesised query."""
        for kind, what in self.steps:
            if kind == "add":
                source = f"(SELECT *, {', '.join(f'{_side(e, 1)} AS {n}' for n, e in what.items())} FROM {source})"
            elif kind == "where":
                source = f"(SELECT * FROM {source} WHERE {_side(what, 1)})"
            elif kind == "either":
                source = what[1].sql(source)
            elif kind == "group":
                keys, aggregates = what
                listed = [*keys, *(f"{_side(e, 1)} AS {n}" for n, e in aggregates.items())]
                source = f"(SELECT {', '.join(listed)} FROM {source}" + (f" GROUP BY {', '.join(keys)})" if keys else ")")
            elif kind == "pick":
                source = f"(SELECT {', '.join(f'{_side(e, 1)} AS {n}' for n, e in what.items())} FROM {source})"
        return source


def query(source: str) -> str:
    """A parenthesised source as a statement."""
    return f"SELECT * FROM {source}"


# ---- pieces of shared SQL ----


def row_mean(*parts: str) -> str:
    """Mean of the parts that are not null; null if none is."""
    total = " + ".join(f"coalesce({p}, 0)" for p in parts)
    count = " + ".join(f"(CASE WHEN {p} IS NULL THEN 0 ELSE 1 END)" for p in parts)
    return f"(({total}) / nullif(CAST({count} AS DOUBLE), 0))"


def rounded(x: str, digits: int = 6) -> str:
    """Half up to so many digits, by the same steps in both engines."""
    return f"(floor(({x}) * {10**digits} + CAST(0.5 AS DOUBLE)) / CAST({10**digits} AS DOUBLE))"


def clamp(x: str, low: float = -1, high: float = 1) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest(CAST({low} AS DOUBLE), least(CAST({high} AS DOUBLE), {x})) END)"


def case(*branches: tuple[str, str], default: str = "NULL") -> str:
    """Text labels in order of their conditions."""
    return "CASE " + " ".join(f"WHEN {c} THEN '{label}'" for c, label in branches) + f" ELSE {default if default == 'NULL' else repr(default)} END"


def lookup(column: str, table: dict, missing: str) -> str:
    """Value of a text in a fixed table; None stands for null."""
    branches = " ".join(f"WHEN {column} = '{k}' THEN {'NULL' if v is None else v if isinstance(v, str) else f'CAST({v} AS DOUBLE)'}" for k, v in table.items())
    return f"(CASE {branches} ELSE {missing} END)"


def sha256(*parts: str, nul: bool = False) -> Expr:
    """Hex digest of text parts joined by bars, or each ended by NUL; null parts are empty."""
    filled = [f"coalesce(CAST({p} AS STRING), '')" for p in parts]
    if nul:
        end = ("char(0)", "chr(0)")
        joined = [" || ".join(f"{p} || {e}" for p in filled) for e in end]
    else:
        joined = [" || '|' || ".join(filled)] * 2
    return f"sha2({joined[0]}, 256)", f"sha256({joined[1]})"


def json_digest(*columns: str) -> Expr:
    """Hex digest of the compact JSON object of text columns, keys sorted; nulls stay as null."""
    fields = [f"'\"{c}\":' || coalesce('\"' || CAST({c} AS STRING) || '\"', 'null')" for c in sorted(columns)]
    text = "'{' || " + " || ',' || ".join(fields) + " || '}'"
    return f"sha2({text}, 256)", f"sha256({text})"


def listed(value: str, order: str) -> Expr:
    """Values of a group as text, in the given order, joined by commas; null values left out."""
    return (
        f"array_join(transform(array_sort(collect_list(CASE WHEN {value} IS NOT NULL THEN struct({order} AS o, {value} AS v) END)), x -> CAST(x.v AS STRING)), ',')",
        f"coalesce(string_agg(CAST({value} AS VARCHAR), ',' ORDER BY {order}, {value}), '')",
    )


def distinct(value: str) -> Expr:
    """Different values of a group as text, in their order, joined by commas; null values left out."""
    return f"array_join(array_sort(collect_set({value})), ',')", f"coalesce(string_agg(DISTINCT {value}, ',' ORDER BY {value}), '')"
