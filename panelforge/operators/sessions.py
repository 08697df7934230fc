"""Exchange calendar by rule: holidays from their rules, early closes, sessions with their times; no table of dates.

Holidays are fixed days moved off the weekend, n-th weekdays of a month, and Good Friday from Easter (anonymous Gregorian
computus), each from the year that it came into force. Special closures are a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (name, first year, month, weekday with Monday as 0, n-th of the month or -1 for the last).
NTH = [("mlk_day", 1998, 1, 0, 3), ("presidents_day", 1971, 2, 0, 3), ("memorial_day", 1971, 5, 0, -1), ("labor_day", 1894, 9, 0, 1), ("thanksgiving", 1942, 11, 3, 4)]
#: Fixed values: (name, first year, month, day, whether a Saturday's holiday moves to the Friday before).
FIXED = [("new_year", 1885, 1, 1, False), ("juneteenth", 2022, 6, 19, True), ("independence_day", 1885, 7, 4, True), ("christmas", 1885, 12, 25, True)]
#: Closures that follow no rule.
SPECIAL = ("2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09")
OPEN, CLOSE, EARLY = "09:30", "16:00", "13:00"


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th such weekday of the month; -1 is the last."""
    if n > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        return F.date_add(first, F.pmod(weekday - F.weekday(first), F.lit(7)) + 7 * (n - 1))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, F.pmod(F.weekday(last) - weekday, F.lit(7)))


def observed(day: Column, saturdays: bool) -> Column:
    """A holiday on Sunday is kept on Monday, one on Saturday on Friday or not at all."""
    moved = F.date_sub(day, 1) if saturdays else F.lit(None).cast("date")
    return F.when(F.weekday(day) == 6, F.date_add(day, 1)).when(F.weekday(day) == 5, moved).otherwise(day)


def easter(year: Column) -> Column:
    whole = lambda a, b: F.floor(a / b).cast("int")
    a, b, c = year % 19, whole(year, 100), year % 100
    d, e = whole(b, 4), b % 4
    g = whole(8 * b + 13, 25)
    h = (19 * a + b - d - g + 15) % 30
    i, k = whole(c, 4), c % 4
    n = (32 + 2 * e + 2 * i - h - k) % 7
    m = whole(a + 11 * h + 19 * n, 433)
    month = whole(h + n - 7 * m + 90, 25)
    return F.make_date(year, month, (h + n - 7 * m + 33 * month + 19) % 32)


def holidays(years: DataFrame) -> DataFrame:
    """day, holiday of each year of the column ``year``."""
    y = F.col("year").cast("int")
    rules = [F.struct(observed(F.make_date(y, F.lit(m), F.lit(d)), sat).alias("day"), F.lit(name).alias("holiday"), F.lit(since).alias("since")) for name, since, m, d, sat in FIXED]
    rules += [F.struct(nth_weekday(y, m, w, n).alias("day"), F.lit(name).alias("holiday"), F.lit(since).alias("since")) for name, since, m, w, n in NTH]
    rules.append(F.struct(F.date_sub(easter(y), 2).alias("day"), F.lit("good_friday").alias("holiday"), F.lit(1885).alias("since")))
    return years.select("year", F.explode(F.array(*rules)).alias("r")).where("r.day IS NOT NULL AND year >= r.since").select("r.day", "r.holiday")


def sessions(dates: DataFrame, column: str, special: tuple[str, ...] = SPECIAL) -> DataFrame:
    """day, is_open, closure (weekend, holiday's name, special), open_time, close_time of all days from the first to the last of the dates.

    The calendar is small by nature: a row for each day."""
    ends = dates.agg(F.min(column).cast("date").alias("low"), F.max(column).cast("date").alias("high")).where("low IS NOT NULL")
    days = ends.select(F.explode(F.sequence("low", "high")).alias("day"))
    closed = holidays(ends.select(F.explode(F.sequence(F.year("low"), F.year("high"))).alias("year")))
    out = days.join(closed.groupBy("day").agg(F.min("holiday").alias("holiday")), "day", "left")
    closure = F.when(F.weekday("day") >= 5, "weekend").when(F.col("holiday").isNotNull(), F.col("holiday")).when(F.col("day").cast("string").isin(*special), "special")
    y = F.year("day")
    eve = F.col("day") == nth_weekday(y, 11, 3, 4) + F.expr("INTERVAL 1 DAY")
    half = eve | ((F.month("day") == 7) & (F.dayofmonth("day") == 3)) | ((F.month("day") == 12) & (F.dayofmonth("day") == 24))
    out = out.withColumn("closure", closure).withColumn("is_open", F.col("closure").isNull())
    return out.select("day", "is_open", "closure", F.when(F.col("is_open"), OPEN).alias("open_time"), F.when(F.col("is_open"), F.when(half, EARLY).otherwise(CLOSE)).alias("close_time"))


def missing_days(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """symbol, expected, observed, ratio, missing_days: the open days between a symbol's first and last bar that it lacks, as a list.

    A symbol's open days are counted from a numbered calendar, so only its gaps are ever exploded."""
    numbered = calendar.where("is_open").select("day").withColumn("number", F.expr("row_number() OVER (ORDER BY day)"))
    have = bars.select("symbol", F.col("trade_date").alias("day")).distinct().join(F.broadcast(numbered), "day")
    gaps = have.withColumn("after", F.expr("lead(number) OVER (PARTITION BY symbol ORDER BY number)"))
    told = gaps.groupBy("symbol").agg(F.count("*").alias("observed"), (F.max("number") - F.min("number") + 1).cast("long").alias("expected"))
    lost = gaps.where("after > number + 1").select("symbol", F.explode(F.sequence(F.col("number") + 1, F.col("after") - 1)).alias("number")).join(F.broadcast(numbered), "number")
    lists = lost.groupBy("symbol").agg(F.array_sort(F.collect_list("day")).alias("missing_days"))
    out = told.join(lists, "symbol", "left").withColumn("missing_days", F.coalesce("missing_days", F.array().cast("array<date>")))
    return out.select("symbol", "expected", "observed", (F.col("observed") / F.col("expected")).alias("ratio"), "missing_days")
