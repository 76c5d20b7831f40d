"""Deterministic keys as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the namespace of all keys. Another one would give other keys.
NAMESPACE = "6f9163ee6a1e4b8a9e2b2f6a6f6a6f6a"


def text_of(c: Column) -> Column:
    """The one canonical text of a key part: its string form, empty for null."""
    return F.coalesce(c.cast("string"), F.lit(""))


def guid(*parts: Column) -> Column:
    """UUID version 5 of the parts joined by ``||``: SHA-1 of namespace and name, with version and variant bits."""
    name = F.concat_ws("||", *[text_of(p) for p in parts])
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    cut = lambda at, n: F.substring(h, at, n)
    return F.concat(cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-5"), cut(14, 3), F.lit("-"), variant, cut(18, 3), F.lit("-"), cut(21, 12))


def add_guid_key(df: DataFrame, parts: list[str], name: str = "key") -> DataFrame:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"key column {name!r} exists already (names are case-insensitive)")
    return df.withColumn(name, guid(*[F.col(p) for p in parts]))


def add_parent_key(df: DataFrame, parent_id: str, name: str = "parent_key") -> DataFrame:
    """The parent's key without a self join: null for roots."""
    return df.withColumn(name, F.when(F.col(parent_id).isNotNull(), guid(F.col(parent_id))))
