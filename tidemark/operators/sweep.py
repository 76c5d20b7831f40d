"""Load over time by a sweep line: signed weights at interval ends instead of a row a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.calendar import add_working_days
from tidemark.operators.scans import Slices
from tidemark.sources.work import Scratch


def weekdays_before(day: Column) -> Column:
    """Mondays to Fridays before a date, counted from a fixed Monday: differences count weekdays between dates."""
    n = F.unix_date(day.cast("date")) + 3  # 1970-01-01 was a Thursday
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def interval_allocations(allocations: DataFrame, resource: str, item: str, role: str, weight: str, start: str, end: str, hours: str) -> DataFrame:
    """The strongest role of each pair as one interval, with its weighted hours a weekday (``daily``). Intervals without a
    weekday, without a bound, or that end before they start, are none. One aggregation, partial before its exchange."""
    best = F.min_by(F.struct(F.col(start).cast("date").alias("start"), F.col(end).cast("date").alias("end"), F.coalesce(hours, F.lit(0)).alias("h"), F.col(weight).alias("w")), F.struct((-F.col(weight)).alias("w"), F.col(role).alias("r")))
    rows = allocations.groupBy(resource, item).agg(best.alias("_b")).select(resource, item, "_b.*")
    n = weekdays_before(F.date_add("end", 1)) - weekdays_before(F.col("start"))
    return rows.withColumn("_n", n).where("end >= start and _n > 0").select(resource, item, "start", "end", (F.col("h") / F.col("_n") * F.col("w")).alias("daily"))


def load_steps(intervals: DataFrame, keys: list[str], start: str, end: str, weight: str, calendar: DataFrame | None = None, slices: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Keys, ``from_day``, ``until_day`` (not in it), ``load`` and ``active`` (intervals), constant from one breakpoint to the
    next, and ``work_days``: the step's weekdays, or with a calendar its working days. Gaps, where nothing is active, have no
    row; null weights count as 0.

    Rows are at most two an interval, however long the intervals are. Running sums go over slices of each key's time, so one
    resource with most of the intervals is no task of its own. Loads are rounded to nine places: what a sum of ends leaves of
    weights that have gone is far below.
    """
    scratch = scratch or Scratch(intervals.sparkSession)
    a, b, w = F.col(start).cast("date"), F.col(end).cast("date"), F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    ends = F.explode(F.array(F.struct(a.alias("day"), w.alias("w"), F.lit(1).alias("n")), F.struct(F.date_add(b, 1).alias("day"), (-w).alias("w"), F.lit(-1).alias("n"))))
    deltas = intervals.where(a.isNotNull() & b.isNotNull() & (b >= a)).select(*keys, ends.alias("_e")).groupBy(*keys, "_e.day").agg(F.sum("_e.w").alias("_w"), F.sum("_e.n").alias("_n"))
    sums = Slices(deltas, keys, ["day"], slices, scratch).running({"load": F.col("_w"), "active": F.col("_n")})
    steps = Slices(sums.drop("_w", "_n"), keys, ["day"], slices, scratch).following("day", "until_day").where("active > 0")
    steps = steps.select(*keys, F.col("day").alias("from_day"), "until_day", F.round("load", 9).alias("load"), "active")
    if calendar is not None:
        return add_working_days(steps, "from_day", "until_day", calendar, "work_days")
    return steps.withColumn("work_days", weekdays_before(F.col("until_day")) - weekdays_before(F.col("from_day")))


def overload(steps: DataFrame, keys: list[str], capacity: Column) -> DataFrame:
    """Of each key: ``conflict_days``, its work days with a load above the capacity, ``busy_days``, those with any, and the
    ``peak`` load. Keys without a work day have no row."""
    over = F.when(F.col("load") > capacity, F.col("work_days")).otherwise(0)
    return steps.where("work_days > 0").groupBy(*keys).agg(F.sum(over).alias("conflict_days"), F.sum("work_days").alias("busy_days"), F.max("load").alias("peak"))
