"""Cleansing, deduplication and guards."""

from __future__ import annotations

from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def dedup_latest(df: DataFrame, keys: list[str], order_by: str, tiebreak: list[str] | None = None, nulls_last: bool = True) -> DataFrame:
    """The newest row of each key; ties fall to the largest tiebreak columns."""
    first = F.col(order_by).desc_nulls_last() if nulls_last else F.col(order_by).desc()
    w = Window.partitionBy(*keys).orderBy(first, *[F.col(c).desc() for c in tiebreak or []])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_any(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicates(keys)


def _meaningful(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    return F.when(c.isNotNull() & (F.trim(c) != ""), 1) if isinstance(kind, T.StringType) else F.when(c.isNotNull(), 1)


def profile(df: DataFrame) -> dict[str, int]:
    """Row count (under ``*``) and meaningful values of each column, in one pass."""
    row = df.agg(F.count("*").alias("*"), *[F.count(_meaningful(f.name, f.dataType)).alias(f.name) for f in df.schema]).first()
    return row.asDict()


def drop_empty_columns(df: DataFrame, protect: tuple[str, ...] = ()) -> DataFrame:
    """Without columns that hold nothing; protected and ``_`` names stay, and so does a table without rows."""
    seen = profile(df)
    gone = [c for c in df.columns if seen["*"] and not seen[c] and c not in protect and not c.startswith("_")]
    return df.drop(*gone)


def guard_dates(df: DataFrame) -> DataFrame:
    """Dates and timestamps outside years 1 to 9999 become null."""
    lo, hi = F.lit("0001-01-01"), F.lit("9999-12-31")
    out = {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            out[f.name] = F.when(c.between(lo.cast("date"), hi.cast("date")), c)
        elif isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            out[f.name] = F.when((c >= lo.cast("timestamp")) & (c <= F.lit("9999-12-31 23:59:59").cast("timestamp")), c)
    return df.withColumns(out) if out else df


def clean_tabular(df: DataFrame, fix_dates: bool = True) -> DataFrame:
    df = drop_empty_columns(df)
    return guard_dates(df) if fix_dates else df


def exclude_columns(df: DataFrame, patterns: list[str]) -> DataFrame:
    return df.drop(*[c for c in df.columns if any(fnmatchcase(c, p) for p in patterns)])


def assert_unique(df: DataFrame, keys: list[str], label: str = "rows") -> DataFrame:
    """df, or an error with at most ten repeated keys."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(10).collect()
    if twice:
        raise ValueError(f"{label}: repeated keys {[tuple(r)[:-1] for r in twice]}")
    return df


def assert_unique_keys(df: DataFrame, keys: list[str], label: str = "table") -> DataFrame:
    """df, or an error where a key repeats; null parts are equal to each other."""
    bad = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").limit(10).collect()
    if bad:
        raise ValueError(f"{label}: repeated keys {[tuple(r)[: len(keys)] for r in bad]}")
    return df


def assert_keys(df: DataFrame, keys: list[str], label: str = "table") -> DataFrame:
    """df, or an error where a key column is null or a key repeats; one aggregation finds both."""
    null = F.when(sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0)) > 0, 1).otherwise(0)
    bad = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(null).alias("_null")).where("_n > 1 or _null = 1").limit(10).collect()
    if bad:
        kind = "null" if any(r["_null"] for r in bad) else "repeated"
        raise ValueError(f"{label}: {kind} keys {[tuple(r)[: len(keys)] for r in bad]}")
    return df


def assert_columns(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    have = dict(df.dtypes)
    wrong = [f"{c}: missing" for c in expected if c not in have] + [f"{c}: {have[c]} for {t}" for c, t in expected.items() if c in have and have[c] != t]
    if wrong:
        raise ValueError("columns differ: " + "; ".join(wrong))
    return df


def with_defaults(df: DataFrame, defaults: dict[str, tuple[str, object]], strict: bool = False) -> DataFrame:
    """Columns cast to (type, default for null); bad values count as null unless strict."""
    missing = [c for c in defaults if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    cast = lambda c, t: F.col(c).cast(t) if strict else F.col(c).try_cast(t)
    return df.withColumns({c: F.coalesce(cast(c, t), F.lit(d).cast(t)) for c, (t, d) in defaults.items()})
