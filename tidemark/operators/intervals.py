"""Points in intervals, and the version in force, as equi joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.scans import Slices
from tidemark.sources.work import Scratch


def join_points(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, width: int, how: str = "left") -> DataFrame:
    """Points with the intervals [low, high] that hold them: intervals are listed under every bucket of ``width`` they
    touch, points under one, and the bounds are the residual. Choose a width near the usual interval length."""
    listed = intervals.where(F.col(high) >= F.col(low)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    at = points.withColumn("_pb", F.floor(F.col(point) / width))
    return at.join(listed, (F.col("_pb") == F.col("_b")) & (F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high)), how).drop("_b", "_pb")


def assert_disjoint(intervals: DataFrame, low: str, high: str, partition: list[str] | None = None) -> DataFrame:
    """intervals, or an error: each start is held against the end before it, in slices of the sorted order."""
    rows = intervals.select(*(partition or []), F.col(low).alias("_low"), F.col(high).alias("_high"))
    before = Slices(rows, partition or [], ["_low", "_high"]).carried({"_before": F.col("_high")}, current=False)
    if not before.where(F.col("_before") >= F.col("_low")).isEmpty():
        raise ValueError("intervals overlap")
    return intervals


def as_of_join(facts: DataFrame, versions: DataFrame, keys: list[str], at: str, valid_from: str, columns: list[str]) -> DataFrame:
    """Each fact with the last version of its key that began at or before it: one union and one window, so long histories
    cost a sort and not a product. Versions with equal starts: the last in column order."""
    f = facts.select("*", F.col(at).alias("_t"), F.lit(1).alias("_side"), F.lit(None).alias("_v"))
    v = versions.select(*keys, F.col(valid_from).alias("_t"), F.lit(0).alias("_side"), F.struct(*columns).alias("_v"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    both = f.unionByName(v, allowMissingColumns=True).withColumn("_last", F.last("_v", ignorenulls=True).over(w))
    return both.where("_side = 1").select(*facts.columns, *[F.col(f"_last.{c}").alias(c) for c in columns])


def dyadic_cover(low: Column, high: Column) -> Column:
    """The fewest aligned cells, (level, cell) for cell * 2^level to (cell + 1) * 2^level - 1, that make up the whole numbers
    of [low, high]: two a level at most, about twice the binary logarithm of the length. An empty interval has none."""
    high = high.cast("long") + 1
    low = low.cast("long")
    shifted = lambda c, j: F.call_function("shiftright", c, j)
    levels = F.sequence(F.lit(0), F.floor(F.log2(F.greatest(high - low, F.lit(1)).cast("double"))).cast("int") + 1)

    def cells(j: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), j)
        first, end = shifted(low + size - 1, j), shifted(high, j)
        odd = lambda c: F.pmod(c, F.lit(2)) == 1
        left = F.when((first < end) & odd(first), F.struct(j.alias("level"), first.alias("cell")))
        right = F.when((first < end) & odd(end), F.struct(j.alias("level"), (end - 1).alias("cell")))
        return F.array(left, right)

    return F.when(high > low, F.filter(F.flatten(F.transform(levels, cells)), lambda x: x.isNotNull()))


def join_ranges(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, how: str = "left", scratch: Scratch | None = None) -> DataFrame:
    """Points, whole numbers, with the intervals [low, high] that hold them, whatever the intervals' lengths.

    Intervals are listed under the cells of their dyadic cover, distinct points under the cell they have on each level that
    occurs, so a pair meets exactly once, in one equi join without candidates to drop. Rows grow with the logarithm of the
    lengths, not with the lengths. Partitions of a cell that many points share, those of a long interval, are ones that Spark
    splits. Points without an interval stay with nulls (``left``) or go (``inner``); null points and bounds meet nothing, and
    neither do intervals that end before they start. Columns of both sides must differ in name.
    """
    if clash := {c.lower() for c in points.columns} & {c.lower() for c in intervals.columns}:
        raise ValueError(f"both sides have {sorted(clash)}")
    if how not in ("left", "inner"):
        raise ValueError(f"join {how!r}")
    scratch = scratch or Scratch(points.sparkSession)
    listed = scratch.keep(intervals.withColumn("_c", F.explode(dyadic_cover(F.col(low), F.col(high)))).withColumns({"_level": F.col("_c.level"), "_cell": F.col("_c.cell")}).drop("_c"))
    levels = sorted(r[0] for r in listed.select("_level").distinct().collect())  # 64 at most
    at = F.col(point).cast("long")
    cells = F.array(*[F.struct(F.lit(j).alias("level"), F.shiftright(F.col("_at"), j).alias("cell")) for j in levels]) if levels else F.array().cast("array<struct<level:int,cell:bigint>>")
    asked = points.select(at.alias("_at")).where("_at is not null").distinct().select("_at", F.explode(cells).alias("_p"))
    asked = asked.select("_at", F.col("_p.level").alias("_level"), F.col("_p.cell").alias("_cell"))
    met = scratch.keep(asked.join(listed, ["_level", "_cell"]).drop("_level", "_cell"))
    return points.withColumn("_at", at).join(met, "_at", how).select(*[F.col(f"`{c}`") for c in [*points.columns, *intervals.columns]])


def range_totals(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, values: dict[str, tuple[str, str]], low_levels: int = 6, scratch: Scratch | None = None) -> DataFrame:
    """Points, whole numbers, with totals over the intervals [low, high] that hold them: for each named value (column; min, max,
    sum or count), as an aggregation of ``join_ranges`` would give, without its pairs of a point and an interval.

    Intervals are first totalled by cell of their dyadic covers; a point adds up its cells, one a level. Cells of the levels
    from ``low_levels`` on are added up once for all points of a block of 2^low_levels numbers. So rows grow with points and
    intervals, not with how many intervals hold a point. Points that none holds have count 0, other totals null.
    """
    if strange := {k for _, k in values.values()} - {"min", "max", "sum", "count"}:
        raise ValueError(f"unknown aggregates {sorted(strange)}")
    if clash := {c.lower() for c in points.columns} & {n.lower() for n in values}:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    scratch = scratch or Scratch(points.sparkSession)
    over = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}
    names = [f"_v{i}" for i in range(len(values))]
    kinds = [k for _, k in values.values()]
    merged = [over[k](n).alias(n) for n, k in zip(names, kinds, strict=True)]
    own = [(F.count if k == "count" else over[k])(c).alias(n) for n, (c, k) in zip(names, values.values(), strict=True)]
    used = list(dict.fromkeys(c for c, _ in values.values()))
    cells = intervals.select(*used, F.explode(dyadic_cover(F.col(low), F.col(high))).alias("_c"))
    totals = scratch.keep(cells.groupBy(F.col("_c.level").alias("_level"), F.col("_c.cell").alias("_cell")).agg(*own))
    levels = sorted(r[0] for r in totals.select("_level").distinct().collect())  # 64 at most

    def asked(rows: DataFrame, column: str, begin: int, chosen: list[int]) -> DataFrame:
        each = F.array(*[F.struct(F.lit(j).alias("level"), F.shiftright(F.col(column), j - begin).alias("cell")) for j in chosen]) if chosen else F.array().cast("array<struct<level:int,cell:bigint>>")
        listed = rows.select(column, F.explode(each).alias("_p")).select(column, F.col("_p.level").alias("_level"), F.col("_p.cell").alias("_cell"))
        return listed.join(totals, ["_level", "_cell"]).select(column, *names)

    at = F.col(point).cast("long")
    once = points.select(at.alias("_at")).where("_at is not null").distinct()
    block = F.shiftright(F.col("_at"), low_levels)
    wide = asked(once.select(block.alias("_block")).distinct(), "_block", low_levels, [j for j in levels if j >= low_levels])
    wide = scratch.keep(wide.groupBy("_block").agg(*merged))
    near = asked(once, "_at", 0, [j for j in levels if j < low_levels])
    far = once.withColumn("_block", block).join(wide, "_block").select("_at", *names)
    met = near.unionByName(far).groupBy("_at").agg(*merged)
    out = [(F.coalesce(n, F.lit(0)) if k == "count" else F.col(n)).alias(name) for n, k, name in zip(names, kinds, values, strict=True)]
    return points.withColumn("_at", at).join(met, "_at", "left").select(*[F.col(f"`{c}`") for c in points.columns], *out)


def as_of_slices(facts: DataFrame, versions: DataFrame, keys: list[str], at: str, valid_from: str, columns: list[str], slices: int | None = None) -> DataFrame:
    """``as_of_join`` for histories of any length: a key that holds a large share of all rows is spread over slices of its
    time, and what a slice last knew is carried into the next. Versions with equal starts: the last in column order."""
    f = facts.select("*", F.col(at).alias("_t"), F.lit(1).alias("_side"), F.lit(None).alias("_v"))
    v = versions.select(*keys, F.col(valid_from).alias("_t"), F.lit(0).alias("_side"), F.struct(*columns).alias("_v"))
    both = Slices(f.unionByName(v, allowMissingColumns=True), keys, ["_t", "_side", "_v"], slices).carried({"_last": F.col("_v")})
    return both.where("_side = 1").select(*[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"_last.{c}").alias(c) for c in columns])
