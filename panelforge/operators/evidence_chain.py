"""Evidence chain of loaded chunks: bars, run, quality, lineage and checkpoint rows, each PASS, WARN or FAIL.

For each chunk and kind of state the newest row inside the chunk counts, else the symbol's newest of all. Rows find their
chunk by the stretches of ``WIDTH`` days that it meets (a chunk of 90 days meets three or four), and bars and all three kinds
of states, a row for each day, go through one join and one grouping. Expected days are counted from the calendar alone. A component that is required passes if it is there, else fails; one that is not required but
there is a warning. A chain is as bad as its worst component.

Defined cases: states without a date only serve as the symbol's newest if nothing dated is there; of equal dates the
larger ``id`` is newer; a chunk without expected days misses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("run", "quality", "lineage")
#: Days of a stretch by which rows find their chunks.
WIDTH = 32


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / WIDTH)


def _facts(bars: DataFrame, days: DataFrame, told: DataFrame) -> DataFrame:
    """kind, symbol, day, n, open (an expected day), newest: one row a symbol and day of bars, one a kind, symbol and day of states."""
    open_days = F.broadcast(days.withColumn("open", F.lit(True)))
    seen = bars.groupBy("symbol", F.col("trade_date").alias("day")).agg(F.count("*").alias("n")).join(open_days, "day", "left")
    facts = seen.withColumn("kind", F.lit("bars")).unionByName(told.where("day IS NOT NULL"), allowMissingColumns=True)
    return facts.withColumn("bucket", _bucket(F.col("day")))


def _met(chunks: DataFrame, bars: DataFrame, days: DataFrame, states: DataFrame) -> DataFrame:
    """chunks with expected, bars, missing and for each kind of states its status, match (exact, fallback, none) and rows inside the chunk."""
    days = days.select("day").distinct()
    calendar = days.groupBy(_bucket(F.col("day")).alias("bucket")).agg(F.collect_list("day").alias("days"))
    calendar = calendar.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "days"))).alias("calendar"))
    buckets = F.sequence(_bucket(F.col("chunk_start")), _bucket(F.col("chunk_end")))
    inside = lambda day: day.between(F.col("chunk_start"), F.col("chunk_end"))
    open_in = lambda b: F.size(F.filter(F.coalesce(F.try_element_at("calendar", b), F.array().cast("array<date>")), inside))
    expected = F.aggregate(buckets, F.lit(0).cast("long"), lambda n, b: n + open_in(b))
    spread = chunks.crossJoin(F.broadcast(calendar)).select("symbol", "chunk_start", "chunk_end", "needs", expected.alias("expected"), F.explode(buckets).alias("bucket"))

    newest = F.struct(F.col("day").isNotNull().alias("dated"), "day", "id", "status")
    told = states.where(F.col("kind").isin(*KINDS)).groupBy("kind", "symbol", "day").agg(F.max(newest).alias("newest"), F.count("*").alias("n"))
    # facts grow with the input, whatever their estimated size: they are never broadcast
    met = spread.join(_facts(bars, days, told).hint("merge"), ["symbol", "bucket"], "left")
    of = lambda k, value: F.when((F.col("kind") == k) & inside(F.col("day")), F.col(value))
    each = [c for k in KINDS for c in (F.max(of(k, "newest")).alias(f"{k}_newest"), F.sum(of(k, "n")).alias(f"{k}_n"))]
    met = met.groupBy("symbol", "chunk_start", "chunk_end", "needs", "expected").agg(F.coalesce(F.sum(of("bars", "n")), F.lit(0)).alias("bars"), F.count(of("bars", "open")).alias("seen"), *each)
    last = told.groupBy("symbol").agg(*[c for k in KINDS for c in (F.max(F.when(F.col("kind") == k, F.col("newest"))).alias(f"{k}_last"), F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(f"{k}_all"))])
    out = []
    for k in KINDS:
        here, ever = F.col(f"{k}_newest"), F.col(f"{k}_last")
        out += [
            F.coalesce(here["status"], ever["status"]).alias(f"{k}_status"),
            F.when(here.isNotNull(), "exact").when(ever.isNotNull(), "fallback").otherwise("none").alias(f"{k}_match"),
            F.coalesce(F.when(here.isNotNull(), F.col(f"{k}_n")).otherwise(F.col(f"{k}_all")), F.lit(0)).alias(f"{k}_rows"),
        ]
    missing = (F.col("expected") - F.col("seen")).alias("missing")
    return met.join(last.hint("merge"), "symbol", "left").select("symbol", "chunk_start", "chunk_end", "needs", "bars", "expected", missing, *out)


def _needed(required, present):
    return F.when(required, F.when(present, "PASS").otherwise("FAIL")).when(present, "WARN").otherwise("PASS")


def evidence_chain(chunks: DataFrame, bars: DataFrame, days: DataFrame, states: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """chunks (symbol, chunk_start, chunk_end, needs: struct of a flag for bars, run, quality, lineage, checkpoint), bars and
    expected days, states (kind, symbol, day, id, status), checkpoints (symbol, chunk_start, last_success) to component statuses."""
    saved = checkpoints.groupBy("symbol", "chunk_start").agg(F.max("last_success").alias("last_success"), F.lit(True).alias("saved"))
    rows = _met(chunks, bars, days, states).join(saved.hint("merge"), ["symbol", "chunk_start"], "left")
    need = lambda c: F.coalesce(F.col(f"needs.{c}"), F.lit(False))
    bars_status = F.when(need("bars") & ((F.col("bars") == 0) | (F.col("missing") > 0)), "FAIL").otherwise(_needed(need("bars"), F.col("bars") > 0))
    held = F.coalesce(F.col("saved"), F.lit(False))
    reached = held & F.coalesce(F.col("last_success") >= F.col("chunk_end"), F.lit(False))
    checkpoint = F.when(need("checkpoint"), F.when(reached, "PASS").otherwise("FAIL")).when(held, "WARN").otherwise("PASS")
    parts = {"bars": bars_status} | {k: _needed(need(k), F.col(f"{k}_rows") > 0) for k in KINDS} | {"checkpoint": checkpoint}
    rows = rows.withColumns({f"{k}_component": e for k, e in parts.items()})
    worst = lambda s: F.array_contains(F.array(*[f"{k}_component" for k in parts]), s)
    counts = ["bars", *(f"{k}_rows" for k in KINDS)]
    every = lambda test: F.forall(F.array(*[F.col(c).cast("long") for c in counts]), test)
    shape = F.when(every(lambda n: n == 0) & (F.col("missing") == 0), "missing").when(every(lambda n: n > 0) & (F.col("missing") == 0), "complete").otherwise("partial")
    rows = rows.withColumn("evidence_status", F.when(worst("FAIL"), "FAIL").when(worst("WARN"), "WARN").otherwise("PASS")).withColumn("shape", shape)
    return rows.select("symbol", "chunk_start", "chunk_end", "bars", "expected", "missing", *[f"{k}_{c}" for k in KINDS for c in ("status", "match", "rows")], *[f"{k}_component" for k in parts], "evidence_status", "shape")
