"""Registered queries: an operator over the test tables, and its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from panelforge.plans.recipe import Recipe, query, rounded
from panelforge.sources.views import table


@dataclass
class Catalog:
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def recipe(self, name: str, source: str, *recipes: Recipe, columns: list[str] | None = None, doubles: tuple[str, ...] = ()) -> None:
        """Recipes one after the other over a table; ``doubles`` are rounded, as sums differ in their last bits."""
        whole = Recipe()
        for r in recipes:
            whole = whole.then(r)
        if columns:
            whole = whole.pick(**{c: rounded(c) if c in doubles else c for c in columns})
        self.queries[name] = lambda spark, sf_dir: whole.apply(table(spark, sf_dir, source))
        self.sql[name] = query(whole.sql(source))

    def plan(self, name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
        self.queries[name] = build
        if sql:
            self.sql[name] = sql
