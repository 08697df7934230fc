"""Trading days, coverage, gaps, overlap, latest state and needed ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.plans.recipe import Recipe, distinct

#: Weekdays without trading.
CLOSED = ("2025-01-01", "2025-01-09")


def trading_days(dates: DataFrame, column: str = "trade_date") -> DataFrame:
    """Weekdays from the first to the last of the dates, but known closures; the calendar is small by nature."""
    ends = dates.agg(F.min(column).cast("date").alias("low"), F.max(column).cast("date").alias("high")).where("low IS NOT NULL")
    days = ends.select(F.explode(F.sequence("low", "high")).alias("day"))
    return days.where((F.weekday("day") < 5) & ~F.col("day").cast("string").isin(*CLOSED))


def trading_days_sql(source: str, column: str = "trade_date") -> str:
    closed = ", ".join(f"DATE '{d}'" for d in CLOSED)
    ends = f"(SELECT CAST(min({column}) AS DATE) AS low, CAST(max({column}) AS DATE) AS high FROM {source})"
    return f"(SELECT day FROM (SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day FROM {ends}) WHERE isodow(day) < 6 AND day NOT IN ({closed}))"


#: Trading days with the ones before and after them.
NEIGHBOURS = Recipe().add(previous_day="lag(day, 1) OVER (ORDER BY day)", next_day="lead(day, 1) OVER (ORDER BY day)", days_since=("datediff(day, lag(day, 1) OVER (ORDER BY day))", "date_diff('day', lag(day, 1) OVER (ORDER BY day), day)"))
#: Expected days joined to a symbol's days: (symbol, day, seen) in.
COVERAGE = (
    Recipe()
    .group(["symbol"], expected="count(*)", observed="count(CASE WHEN seen THEN 1 END)", first_missing="min(CASE WHEN NOT seen THEN day END)", last_missing="max(CASE WHEN NOT seen THEN day END)")
    .add(missing="expected - observed", ratio="observed / CAST(expected AS DOUBLE)")
)


def expected_days(bars: DataFrame, days: DataFrame) -> DataFrame:
    """Every symbol on every expected day, and whether it has a bar; the calendar side is broadcast by its size."""
    symbols = bars.select("symbol").distinct()
    have = bars.select("symbol", F.col("trade_date").alias("day")).distinct().withColumn("seen", F.lit(True))
    # symbols x calendar days is the answer's own grain
    return symbols.crossJoin(days).join(have, ["symbol", "day"], "left").select("symbol", "day", F.coalesce("seen", F.lit(False)).alias("seen"))


def expected_days_sql(bars: str, days: str) -> str:
    return (
        f"(SELECT s.symbol, d.day, h.symbol IS NOT NULL AS seen FROM (SELECT DISTINCT symbol FROM {bars}) s CROSS JOIN {days} d "
        f"LEFT JOIN (SELECT DISTINCT symbol, trade_date FROM {bars}) h ON h.symbol = s.symbol AND h.trade_date = d.day)"
    )


#: Runs of missing days as ranges to fill.
GAPS = (
    Recipe()
    .add(number="row_number() OVER (PARTITION BY symbol ORDER BY day)")
    .where("NOT seen")
    .add(run="number - row_number() OVER (PARTITION BY symbol ORDER BY day)")
    .group(["symbol", "run"], gap_start="min(day)", gap_end="max(day)", days="count(*)")
    .pick("symbol", "gap_start", "gap_end", "days")
)
#: Keys with more than one row, and their sources.
OVERLAP = Recipe().group(["symbol", "trade_date"], n="count(*)", adjusted_values="count(DISTINCT adjusted)", sources=distinct("CASE WHEN adjusted THEN 'adjusted' ELSE 'raw' END")).where("n > 1")
ROW_PROFILE = Recipe().group(["symbol"], n="count(*)", first_day="min(trade_date)", last_day="max(trade_date)", adjusted_values="count(DISTINCT adjusted)")


def latest_status(as_of: str) -> Recipe:
    """Latest bar of each symbol against the last expected day, and the range an update needs."""
    return (
        Recipe()
        .group(["symbol"], latest=f"max(CASE WHEN trade_date <= DATE '{as_of}' THEN trade_date END)")
        .add(expected_day=(f"date_sub(DATE '{as_of}', greatest(weekday(DATE '{as_of}') - 4, 0))", f"DATE '{as_of}' - CAST(greatest(isodow(DATE '{as_of}') - 5, 0) AS INTEGER)"))
        .add(
            status="CASE WHEN latest IS NULL THEN 'no_existing_data' WHEN latest >= expected_day THEN 'up_to_date' ELSE 'update_needed' END",
            needed_start=("CASE WHEN latest IS NULL THEN expected_day ELSE date_add(latest, 1) END", "CASE WHEN latest IS NULL THEN expected_day ELSE latest + 1 END"),
            needed_end=(f"date_add(DATE '{as_of}', 1)", f"DATE '{as_of}' + 1"),
        )
    )


def chunks(days: int) -> Recipe:
    """(symbol, start_day, end_day) cut into ranges of at most ``days`` days."""
    return (
        Recipe()
        .add(number=(f"explode(sequence(0, CAST(floor(datediff(end_day, start_day) / {days}) AS INT)))", f"unnest(range(0, CAST(floor(date_diff('day', start_day, end_day) / {days}) AS BIGINT) + 1))"))
        .add(chunk_start=(f"date_add(start_day, number * {days})", f"start_day + CAST(number * {days} AS INTEGER)"))
        .add(chunk_end=(f"least(date_add(chunk_start, {days - 1}), end_day)", f"least(chunk_start + {days - 1}, end_day)"))
        .pick("symbol", "chunk_start", "chunk_end", chunk_number="CAST(number AS BIGINT)")
    )


#: Thresholds of the symbol master: share of missing exchanges and names, duplicates.
MASTER_COVERAGE = (
    Recipe()
    .group(
        [],
        symbols="count(*)",
        active="count(CASE WHEN active_flag THEN 1 END)",
        inactive="count(CASE WHEN NOT active_flag THEN 1 END)",
        missing_exchange="count(CASE WHEN exchange_code IS NULL THEN 1 END)",
        missing_name="count(CASE WHEN full_name IS NULL THEN 1 END)",
        duplicates="count(*) - count(DISTINCT symbol)",
    )
    .add(exchange_share="missing_exchange / CAST(symbols AS DOUBLE)", name_share="missing_name / CAST(symbols AS DOUBLE)")
    .add(status="CASE WHEN symbols = 0 OR duplicates > 0 THEN 'FAIL' WHEN exchange_share > 0.05 OR name_share > 0.05 THEN 'WARN' ELSE 'PASS' END")
)
