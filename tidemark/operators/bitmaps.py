"""Exact distinct counts that add up along levels, from bitmaps made once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, item: str, by: list[str]) -> DataFrame:
    """One bitmap of items for each combination of ``by`` and bucket of 32,768 item numbers: 4 kB a row, whatever it counts.

    Items are whole numbers, dense ones best (a key of a dimension): sparse ones make many nearly empty bitmaps. Null items
    count for nothing; negative ones are numbers too. Tables kept in this form are counted later without the rows.
    """
    rows = df.where(F.col(item).isNotNull()).select(*by, F.col(item).cast("long").alias("_i"))
    return rows.groupBy(*by, F.bitmap_bucket_number("_i").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_i")).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of fewer columns, or of several tables' union."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_matrix(bitmaps: DataFrame, by: list[str], out: str = "items") -> DataFrame:
    """Distinct items at each level: all of ``by``, all but the last, and so on to one total row. ``level`` is how many of
    the columns count, so a null that is a value differs from one that is a total. Columns must not be named bucket or bits.

    One pass over the bitmaps: they are merged by level and bucket, then counted and added up, as buckets share no items.
    """
    sets = [[*by[:k], "bucket"] for k in range(len(by), -1, -1)]
    level = sum((1 - F.grouping(c).cast("int") for c in by), F.lit(0)).alias("level")
    merged = bitmaps.groupingSets(sets, *by, "bucket").agg(level, F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by, "level").agg(F.sum(F.bitmap_count("bits")).alias(out))
