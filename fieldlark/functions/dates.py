"""Week arithmetic: Mondays, Monday-based week numbers, and the closed periods of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("weekly", "biweekly", "days")


def monday_before(d: Column) -> Column:
    return F.date_trunc("week", d).cast("date")


def monday_after(d: Column) -> Column:
    return F.when(F.weekday(d) == 0, d.cast("date")).otherwise(F.next_day(d, "MO"))


def week_number(d: Column) -> Column:
    """Week of the year with weeks from Monday; days before the first Monday are in week 0."""
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def biweekly_before(d: Column) -> Column:
    """The last Monday of an odd week up to `d`."""
    m = monday_before(d)
    return F.when(week_number(m) % 2 == 1, m).otherwise(F.date_sub(m, 7))


def biweekly_after(d: Column) -> Column:
    """The first Monday of an odd week from `d` on."""
    m = monday_after(d)
    return F.when(week_number(m) % 2 == 1, m).otherwise(F.date_add(m, 7))


def effective_end(end: Column, today: Column, delay: int = 3) -> Column:
    """Images arrive late: the end of a run is `delay` days before today at most."""
    return F.least(end, F.date_sub(today, delay))


def periods(spark: SparkSession, start: str, end: str, kind: str = "weekly", days: int | None = None, today: str | None = None) -> DataFrame:
    """start_date, end_date (exclusive), end_incl: whole periods between two dates, none of which reaches past today.

    Weekly and biweekly periods begin on (odd-week) Mondays: the start moves forward to one and the end back. An error if
    both fall on one day.
    """
    if kind not in KINDS or (kind == "days") != (days is not None):
        raise ValueError(f"kind is one of {KINDS}, and `days` goes with 'days' alone")
    after, before = {"weekly": (monday_after, monday_before), "biweekly": (biweekly_after, biweekly_before), "days": (lambda d: d, lambda d: d)}[kind]
    n = {"weekly": 7, "biweekly": 14}.get(kind, days)
    given = spark.range(1).select(F.to_date(F.lit(start)).alias("s"), F.to_date(F.lit(end)).alias("e"), F.coalesce(F.to_date(F.lit(today).cast("string")), F.current_date()).alias("t"))
    bounds = given.select(after(F.col("s")).alias("s"), before(F.col("e")).alias("e"), "t")
    row = bounds.first()
    if row["s"] == row["e"]:
        raise ValueError(f"the aligned start and end are both {row['s']}: no period between them")
    last = F.date_sub(F.least("e", "t"), n)
    found = bounds.where(F.col("s") <= last).select(F.explode(F.sequence("s", last, F.expr(f"interval {n} days"))).alias("start_date"))
    return found.select("start_date", F.date_add("start_date", n).alias("end_date"), F.date_add("start_date", n - 1).alias("end_incl"))
