"""Connected components of a link table by alternating large-star and small-star steps, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.scratch import discard, materialize


def _downhill(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller end, loops left out."""
    a, b = F.greatest("src", "dst"), F.least("src", "dst")
    return links.where("src <> dst").select(a.alias("src"), b.alias("dst")).distinct()


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("src").agg(F.min("dst").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour, or to the node if that is less."""
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = _least_neighbour(both)
    return both.join(low, "src").where("dst > src").select(F.col("dst").alias("src"), F.least("src", "low").alias("dst"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node's smaller neighbours and the node itself are linked to the least of them."""
    low = _least_neighbour(links)
    moved = links.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(low.select("src", F.col("low").alias("dst")))


def _all_stars(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and that one has none."""
    lows = links.groupBy("src").agg(F.count("*").alias("n"))
    roots = links.select(F.col("dst").alias("src")).distinct().withColumn("root", F.lit(True))
    return lows.join(roots, "src", "left").where("n > 1 or root").count() == 0


def connected_components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component): the least id reachable, for every id that has a link to another.

    ``src`` and ``dst`` hold comparable ids; rows with a null end are ignored, repeated links and loops change nothing,
    an empty table gives an empty table. Each round is written to the shared folder, so lineage stays short.
    """
    named = links.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna()
    now = materialize(_downhill(named))
    while not _all_stars(now):
        after = materialize(_downhill(_small_star(_downhill(_large_star(now)))))
        discard(now)
        now = after
    return now.select(F.col("src").alias("id"), F.col("dst").alias("component"))
