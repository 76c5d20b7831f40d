"""Measures and report result sets over facts and dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass
class Star:
    """A fact with its dimensions; a dimension may join by several columns, of which one is active."""

    fact: DataFrame
    joins: dict[str, tuple[DataFrame, str, dict[str, str]]] = field(default_factory=dict)

    def rows(self, *dims: str, roles: dict[str, str] | None = None) -> DataFrame:
        """The fact left-joined to the named dimensions, each by its active role unless another is named."""
        out = self.fact
        for d in dims:
            table, key, columns = self.joins[d]
            column = columns[(roles or {}).get(d, next(iter(columns)))]
            other = table.withColumnRenamed(key, "_dk")
            out = out.join(other, F.col(column) == F.col("_dk"), "left").drop("_dk")
        return out

    def measure(self, by: list[str], measures: dict[str, Column], dims: list[str], where: Column | None = None, roles: dict[str, str] | None = None, totals: bool = False) -> DataFrame:
        rows = self.rows(*dims, roles=roles)
        rows = rows.where(where) if where is not None else rows
        grouped = rows.rollup(*by) if totals else rows.groupBy(*by)
        return grouped.agg(*[m.alias(n) for n, m in measures.items()])


def share(part: Column, whole: Column) -> Column:
    """part / whole, null where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def conflict_days(days: DataFrame, resource: str, day: str, hours: str, capacity: str, block: str | None = None) -> DataFrame:
    """(resource, day) pairs whose hours exceed the capacity. block: a column that the day decides and rows are partitioned by."""
    per = days.groupBy(resource, *([block] if block else []), day).agg(F.sum(hours).alias("hours"), F.max(capacity).alias("capacity"))
    return per.where(F.col("hours") > F.col("capacity")).select(resource, day, "hours", "capacity")


def overallocated(allocations: DataFrame, resource: str, weight: str, capacity: str) -> DataFrame:
    return allocations.groupBy(resource).agg(F.sum(weight).alias("load"), F.max(capacity).alias("capacity")).withColumn("is_overallocated", F.col("load") > F.col("capacity"))


def capacity_grid(days: DataFrame, resource: str, day: str, grain: str, value: Column, low: float, high: float, block: str | None = None) -> DataFrame:
    """resource by day or Monday week, a value and its load band by two thresholds. block: a column that the period decides
    and rows are partitioned by."""
    period = F.col(day).cast("date") if grain == "day" else F.trunc(day, "week")
    out = days.groupBy(resource, *([block] if block else []), period.alias("period")).agg(value.alias("load")).select(resource, "period", "load")
    band = F.when(F.col("load") > high, "over").when(F.col("load") > low, "busy").otherwise("free")
    return out.withColumns({"load_band": band, "span": F.date_format("period", "MMM yyyy")})


def day_pivot(days: DataFrame, resource: str, day: str, first: str, n: int, value: Column) -> DataFrame:
    """resource by the next n days from ``first`` that are no weekend days."""
    start = F.lit(first).cast("date")
    near = days.where((F.col(day) >= start) & (F.col(day) < F.date_add(start, n)) & (F.weekday(day) < 5))
    return near.groupBy(resource, F.date_format(day, "yyyy-MM-dd").alias("day")).agg(value.alias("n"))


def day_matrix(days: DataFrame, resource: str, day: str, first: str, n: int, value: Column) -> DataFrame:
    """As ``day_pivot``, one column a day: yyyy-MM-dd of each of the next n days that is no weekend day, 0 where nothing is."""
    wanted = [d for d in (date.fromisoformat(first) + timedelta(days=i) for i in range(n)) if d.weekday() < 5]
    names = [d.isoformat() for d in wanted]
    near = days.where(F.col(day).cast("date").isin(wanted)).withColumn("_day", F.date_format(day, "yyyy-MM-dd"))
    return near.groupBy(resource).pivot("_day", names).agg(value).na.fill(0)


def detail_table(rows: DataFrame, columns: list[str], count: Column | None = None) -> DataFrame:
    """A report's detail table: one row for each set of labels, dates and type, with a count (rows, unless another is given)."""
    return rows.groupBy(*columns).agg((F.count("*") if count is None else count).alias("n"))


def stage_days(periods: DataFrame, entity: str, stage: str, days: str) -> DataFrame:
    """Days and periods stacked by entity and stage, with the stage's share of the entity's days (null where they are 0)."""
    per = periods.groupBy(entity, stage).agg(F.sum(days).alias("days"), F.count("*").alias("periods"))
    return per.withColumn("share", share(F.col("days"), F.sum("days").over(Window.partitionBy(entity))))


def listed(df: DataFrame, where: Column, columns: list[str], order: list[Column]) -> DataFrame:
    return df.where(where).select(*columns).orderBy(*order)


def slicer(df: DataFrame, label: str, sort_by: str | None = None, unlike: list[str] | None = None, contains: str | None = None) -> DataFrame:
    """Distinct labels, without some, with a text, ordered by their companion column."""
    rows = df.where(~F.col(label).isin(unlike)) if unlike else df
    rows = rows.where(F.lower(label).contains(contains.lower())) if contains else rows
    cols = [label, sort_by] if sort_by else [label]
    return rows.select(*cols).distinct().orderBy(sort_by or label)


def gantt_rows(df: DataFrame, path: str, status: str, label: tuple[str, str] | None = None, milestones: bool | None = None) -> DataFrame:
    """Items with both planned dates by path, with a status class and whether actual dates exist. label: two columns that are
    joined to ``label``, a null one left out. milestones: only items that are (or aren't) one; None: all."""
    low = F.lower(F.col(status))
    kind = F.when(low.contains("done") | low.contains("closed"), "done").when(low.contains("block"), "blocked").when(low.contains("progress"), "active").otherwise("planned")
    rows = df.where("start is not null and end is not null").withColumns({"status_class": kind, "is_milestone": F.col("start") == F.col("end"), "has_actual": F.col("actual_start").isNotNull()})
    rows = rows.withColumn("label", F.concat_ws(": ", *label)) if label else rows
    rows = rows if milestones is None else rows.where(F.col("is_milestone") == F.lit(milestones))
    return rows.orderBy(F.col(path).asc_nulls_last())
