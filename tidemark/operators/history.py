"""Upserts and versioned dimensions on plain files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import guid
from tidemark.operators.clean import assert_unique_keys


def upsert(target: DataFrame | None, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows with equal keys (null parts are equal too); other target rows stay. New source
    columns widen the table; columns that the source lacks become null in replaced rows. Twice the same source: once. A source
    that has a key twice is an error: which row should win isn't known."""
    assert_unique_keys(source, keys, "source")
    if target is None:
        return source
    k = {c: F.col(f"s.{c}") for c in keys}
    on = None
    for c in keys:
        same = F.col(f"t.{c}").eqNullSafe(k[c])
        on = same if on is None else on & same
    kept = target.alias("t").join(source.select(*keys).alias("s"), on, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def merge_sql(target: str, view: str, keys: list[str], columns: list[str]) -> str:
    """The same upsert as a MERGE statement, for catalogs that have it and for audit."""
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    rest = [c for c in columns if c not in keys]
    change = "WHEN MATCHED THEN UPDATE SET " + ", ".join(f"t.`{c}` = s.`{c}`" for c in rest) + " " if rest else ""
    names, values = ", ".join(f"`{c}`" for c in columns), ", ".join(f"s.`{c}`" for c in columns)
    return f"MERGE INTO {target} t USING {view} s ON {on} {change}WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"


def state_hash(columns: list[str]) -> Column:
    """SHA-256 of the tracked values; null differs from empty, and a value's place counts."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]), 256)


def scd2_merge(current: DataFrame | None, snapshot: DataFrame, keys: list[str], tracked: list[str], now: datetime | str, key: str = "key") -> DataFrame:
    """The whole history after a snapshot: changed rows close at ``now`` and get a new version, new ones open, unchanged
    ones and those missing from the snapshot stay as they are. One join of the open rows with the snapshot. A snapshot that
    has a key twice is an error."""
    assert_unique_keys(snapshot, keys, "snapshot")
    at = F.lit(now).cast("timestamp")
    fresh = snapshot.withColumn("_scd_hash", state_hash(tracked))
    opened = fresh.withColumns({"valid_from": at, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
    opened = opened.withColumn(key, guid(*[F.col(k) for k in keys], F.col("_scd_hash"), F.col("valid_from")))
    if current is None:
        return opened
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    now_open = current.where("is_current")
    seen = now_open.alias("o").join(fresh.select(*keys, F.col("_scd_hash").alias("_new")).alias("n"), on, "left")
    changed = F.coalesce(F.col("n._new") != F.col("o._scd_hash"), F.lit(False))
    kept = seen.select(*[F.when(changed, at).otherwise(F.col("o.valid_to")).alias(c) if c == "valid_to" else (F.col("o.is_current") & ~changed).alias(c) if c == "is_current" else F.col(f"o.{c}") for c in current.columns])
    same = now_open.select(*keys, F.col("_scd_hash").alias("_old"))
    on_new = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys] + [F.col("n._scd_hash") == F.col("o._old")]
    new = opened.alias("n").join(same.alias("o"), on_new, "left_anti")
    return current.where("not is_current").unionByName(kept).unionByName(new)


def scd2_counts(current: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """One row: inserted, changed, unchanged. Null keys are equal to each other, as in ``scd2_merge``; a key twice is an error."""
    assert_unique_keys(snapshot, keys, "snapshot")
    old = current.where("is_current").select(*keys, F.col("_scd_hash").alias("_old")).alias("o")
    fresh = snapshot.withColumn("_new", state_hash(tracked)).alias("n")
    both = fresh.join(old, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys], "left")
    return both.agg(F.count_if(F.col("_old").isNull()).alias("inserted"), F.count_if(F.col("_old") != F.col("_new")).alias("changed"), F.count_if(F.col("_old") == F.col("_new")).alias("unchanged"))
