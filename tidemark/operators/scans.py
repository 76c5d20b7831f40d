"""Ordered scans over keys of any size: the order is cut into slices, and what one slice ends with is carried into the next.

A window by key puts a key's whole history into one task. Here rows are range-partitioned by key and order, so a hot key
covers several slices; windows run inside slices, and only ends of slices travel: a key that begins in a slice after
another key's rows has nothing to be carried, so one row a slice boundary is all there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidemark.sources.work import Scratch

SLICE = "_slice"


class Slices:
    """Rows in slices of (keys, order), written with their slice's number, so every later step sees the same cuts.

    Rows equal in all of keys and order share a slice: give an order that tells rows apart where many may tie. Null keys are
    one key; null order values come first. ``slices``: how many, else the session's shuffle partitions.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], slices: int | None = None, scratch: Scratch | None = None) -> None:
        spark = df.sparkSession
        if SLICE in df.columns:
            raise ValueError(f"the rows have a column {SLICE}")
        self.keys, self.order, self.scratch = keys, order, scratch or Scratch(spark)
        self.n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
        by = [F.col(c) for c in [*keys, *order]]
        self.rows = self.scratch.keep(df.repartitionByRange(self.n, *by).withColumn(SLICE, F.spark_partition_id()))
        self.columns = df.columns

    def _window(self) -> WindowSpec:
        return Window.partitionBy(SLICE, *self.keys).orderBy(*self.order)

    def _reaching(self, ends: DataFrame, value: Column, forward: bool = True) -> DataFrame:
        """``ends`` has one row a slice and key; ``value`` becomes ``_in``. Rows of the slices that a key begins in (``forward``;
        else ends in) have nothing to take over and go, so at most one row a slice is left."""
        every = Window.partitionBy(*self.keys)
        edge = F.col(SLICE) > F.min(SLICE).over(every) if forward else F.col(SLICE) < F.max(SLICE).over(every)
        made = ends.withColumns({"_in": value, "_reached": edge}).where("_reached")
        return made.select(SLICE, *[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], "_in")

    def _before(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)

    def _with(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        """Rows with ``_in``. The carry has at most one row a slice, of a number given by ``slices``: it is broadcast."""
        on = [rows[SLICE] == carry[SLICE]]
        for i, k in enumerate(self.keys):
            on.append(rows[k].eqNullSafe(carry[f"_k{i}"]))
        return rows.join(F.broadcast(carry), on, "left").drop(carry[SLICE]).drop(*[f"_k{i}" for i in range(len(self.keys))])

    def carried(self, values: dict[str, Column], current: bool = True) -> DataFrame:
        """Rows with the last value that isn't null at or before each (``current``) or before it, by key and order."""
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0 if current else -1)
        rows = self.rows.withColumns({f"_x{i}": v for i, v in enumerate(values.values())})
        at = F.struct(*self.order)
        ends = rows.groupBy(SLICE, *self.keys).agg(F.struct(*[F.max_by(F.when(F.col(f"_x{i}").isNotNull(), F.struct(F.col(f"_x{i}").alias("v"))), F.when(F.col(f"_x{i}").isNotNull(), at)).alias(f"x{i}") for i in range(len(values))]).alias("_end"))
        last = F.struct(*[F.last(F.col(f"_end.x{i}"), ignorenulls=True).over(self._before()).alias(f"x{i}") for i in range(len(values))])
        carry = self._reaching(ends, last)
        inside = rows.withColumns({f"_y{i}": F.last(F.when(F.col(f"_x{i}").isNotNull(), F.struct(F.col(f"_x{i}").alias("v"))), ignorenulls=True).over(upto) for i in range(len(values))})
        out = self._with(inside, carry)
        return out.select(*[F.col(f"`{c}`") for c in self.columns], *[F.coalesce(F.col(f"_y{i}.v"), F.col(f"_in.x{i}.v")).alias(n) for i, n in enumerate(values)])

    def following(self, column: str, out: str) -> DataFrame:
        """Rows with the next row's value of a column, by key and order; null for a key's last row."""
        w = self._window()
        rows = self.rows.withColumns({"_next": F.lead(F.struct(F.col(column).alias("v"))).over(w)})
        firsts = self.rows.groupBy(SLICE, *self.keys).agg(F.min_by(F.struct(F.col(column).alias("v")), F.struct(*self.order)).alias("_head"))
        back = Window.partitionBy(*self.keys).orderBy(F.col(SLICE).desc()).rowsBetween(-1, -1)
        carry = self._reaching(firsts, F.last("_head").over(back), forward=False)
        joined = self._with(rows, carry)
        return joined.select(*[F.col(f"`{c}`") for c in self.columns], F.coalesce(F.col("_next.v"), F.when(F.col("_next").isNull(), F.col("_in.v"))).alias(out))

    def running(self, values: dict[str, Column]) -> DataFrame:
        """Rows with running sums up to and with each row, by key and order; null values add nothing."""
        rows = self.rows.withColumns({f"_x{i}": F.coalesce(v, F.lit(0)) for i, v in enumerate(values.values())})
        upto = self._window().rowsBetween(Window.unboundedPreceding, 0)
        totals = rows.groupBy(SLICE, *self.keys).agg(*[F.sum(f"_x{i}").alias(f"_s{i}") for i in range(len(values))])
        carry = self._reaching(totals, F.struct(*[F.sum(f"_s{i}").over(self._before()).alias(f"s{i}") for i in range(len(values))]))
        inside = rows.withColumns({f"_y{i}": F.sum(f"_x{i}").over(upto) for i in range(len(values))})
        out = self._with(inside, carry)
        return out.select(*[F.col(f"`{c}`") for c in self.columns], *[(F.col(f"_y{i}") + F.coalesce(F.col(f"_in.s{i}"), F.lit(0))).alias(n) for i, n in enumerate(values)])
