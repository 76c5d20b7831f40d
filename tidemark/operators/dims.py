"""Keyed dimensions and facts: Unknown members, key lookups, guarded builds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import add_guid_key, guid
from tidemark.operators.clean import assert_columns, assert_keys, with_defaults

UNKNOWN = "Unknown"


def add_unknown_member(df: DataFrame, sentinels: dict[str, object]) -> DataFrame:
    """One row with the sentinels and nulls elsewhere, unless the table has such a row."""
    kinds = dict(df.dtypes)
    row = df.sparkSession.range(1).select(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in sentinels.items()])
    have = df.select(*sentinels).where(" and ".join(f"`{c}` <=> {_sql(v)}" for c, v in sentinels.items())).limit(1)
    return df.unionByName(row.join(have, list(sentinels), "left_anti"), allowMissingColumns=True)


def _sql(v: object) -> str:
    return "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else str(v)


def unknown_key(dim: DataFrame, natural: str, key: str, unknown: object = UNKNOWN) -> str:
    row = dim.where(F.col(natural) == unknown).select(key).limit(1).collect()
    if not row:
        raise ValueError(f"the dimension has no {unknown!r} member")
    return row[0][0]


def lookup_key(fact: DataFrame, dim: DataFrame, fact_column: str, natural: str, key: str, out: str | None = None, default_to_unknown: bool = False, unknown: object = UNKNOWN) -> DataFrame:
    """Left equi join for one dimension key; of a versioned dimension only current rows count. Strategy is Spark's choice."""
    rows = dim.where("is_current") if "is_current" in dim.columns else dim
    out = out or key
    found = fact.join(rows.select(F.col(natural).alias("_nk"), F.col(key).alias("_k")), F.col(fact_column) == F.col("_nk"), "left")
    value = F.coalesce("_k", F.lit(unknown_key(rows, natural, key, unknown))) if default_to_unknown else F.col("_k")
    return found.withColumn(out, value).drop("_nk", "_k")


def lookup_keys(fact: DataFrame, dim: DataFrame, roles: dict[str, str], natural: str, key: str, default_to_unknown: bool = True, unknown: object = UNKNOWN) -> DataFrame:
    """The same dimension in several roles: fact column to key column."""
    for column, out in roles.items():
        fact = lookup_key(fact, dim, column, natural, key, out, default_to_unknown, unknown)
    return fact


def lookup_as_of(fact: DataFrame, dim: DataFrame, fact_column: str, natural: str, key: str, as_of: str, out: str | None = None) -> DataFrame:
    """The key of the version in force: equi join on the natural key, half-open range as its residual."""
    rows = dim.select(F.col(natural).alias("_nk"), F.col(key).alias("_k"), F.col("valid_from").alias("_f"), F.col("valid_to").alias("_t"))
    on = (F.col(fact_column) == F.col("_nk")) & (F.col(as_of) >= F.col("_f")) & (F.col("_t").isNull() | (F.col(as_of) < F.col("_t")))
    return fact.join(rows, on, "left").withColumn(out or key, F.col("_k")).drop("_nk", "_k", "_f", "_t")


@dataclass
class TableSpec:
    """What a dimension or fact must look like; the build follows it."""

    name: str
    kind: str = "dim"
    merge_fields: list[str] = field(default_factory=list)
    key: str = "key"
    types: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, tuple[str, object]] = field(default_factory=dict)
    sentinels: dict[str, object] = field(default_factory=dict)
    unknown_member: bool | None = None
    fallbacks: dict[str, tuple[DataFrame, str, str]] = field(default_factory=dict)
    expected: dict[str, str] = field(default_factory=dict)
    tracked: list[str] = field(default_factory=list)
    write_mode: str = "upsert"

    def __post_init__(self) -> None:
        if self.kind not in ("dim", "fact", "scd2"):
            raise ValueError(f"{self.name}: kind {self.kind!r}")
        if not self.merge_fields:
            raise ValueError(f"{self.name}: no merge fields")
        if self.kind == "fact" and self.unknown_member:
            raise ValueError(f"{self.name}: facts have no Unknown member")
        if self.kind == "scd2" and (self.write_mode == "overwrite" or not self.tracked):
            raise ValueError(f"{self.name}: history needs tracked columns and can't be overwritten")
        if self.unknown_member is None:
            self.unknown_member = self.kind != "fact"


def fill_fallbacks(df: DataFrame, fallbacks: dict[str, tuple[DataFrame, str, str]], unknown: object = UNKNOWN) -> DataFrame:
    """Null foreign keys get the key of their dimension's Unknown row, each dimension read once."""
    known: dict[tuple[int, str, str], str] = {}
    for column, (dim, natural, key) in fallbacks.items():
        at = (id(dim), natural, key)
        known[at] = known.get(at) or unknown_key(dim, natural, key, unknown)
        df = df.withColumn(column, F.coalesce(column, F.lit(known[at])))
    return df


def unknown_row(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The Unknown member as one row of df's columns."""
    known = {c: spec.sentinels.get(c, UNKNOWN) for c in spec.merge_fields} | {k: v for k, v in spec.sentinels.items() if k in df.columns}
    return df.sparkSession.range(1).select(*[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema])


def build_table(df: DataFrame, spec: TableSpec, one_pass: bool = False) -> DataFrame:
    """Types, Unknown member, defaults, fallbacks, schema and key checks, then the key: rows ready to be written. Looking for
    an Unknown member and checking the keys both read all rows once more; with ``one_pass`` neither is done here, but by a
    write that does so on its way (``BucketTable``)."""
    missing = [c for c in spec.merge_fields if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: merge fields missing: {missing}")
    if spec.unknown_member:
        kinds = {c: spec.types.get(c, "string") for c in spec.merge_fields}
        df = df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})
        if not one_pass:
            df = add_unknown_member(df, {c: spec.sentinels.get(c, UNKNOWN) for c in spec.merge_fields} | {k: v for k, v in spec.sentinels.items() if k in df.columns})
    if spec.defaults:
        df = with_defaults(df, {c: d for c, d in spec.defaults.items() if c not in spec.merge_fields})
    df = fill_fallbacks(df, spec.fallbacks)
    if spec.expected:
        assert_columns(df, spec.expected)
    if not one_pass:
        assert_keys(df, spec.merge_fields, spec.name)
    return df if spec.kind == "scd2" else add_guid_key(df, spec.merge_fields, spec.key)


def synthetic_key(*values: object):
    return guid(*[F.lit(v) for v in values])
