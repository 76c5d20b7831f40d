"""Configuration as data: entities, sources, mappings, gold tables, calendars; loaded from JSON or dicts."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.calendar import date_dimension
from tidemark.operators.dims import TableSpec, build_table, unknown_row
from tidemark.operators.history import scd2_merge
from tidemark.operators.semi import Mapping
from tidemark.sources.buckets import BucketTable, Guards
from tidemark.sources.sinks import exists, recover, replace_table, upsert_table


@dataclass
class Entity:
    entity_name: str
    records_path: str = ""
    total_path: str = ""
    next_path: str = ""
    pagination: str = "none"
    page_size: int = 100
    key_path: str = "id"
    incremental_column: str | None = None
    initial_watermark: str = "1900-01-01 00:00"


@dataclass
class Source:
    source_name: str
    entities: list[Entity] = field(default_factory=list)


@dataclass
class SilverEntity:
    source_name: str
    entity_name: str
    keys: list[str]
    mappings: list[Mapping]
    order_by: str = "extracted_at"


@dataclass
class GoldTable:
    table_name: str
    select_sql: str
    kind: str = "dim"
    merge_fields: list[str] = field(default_factory=list)
    key: str = "key"
    tracked: list[str] = field(default_factory=list)
    write_mode: str = "upsert"


@dataclass
class CalendarSpec:
    table_name: str
    start_date: str
    end_date: str
    fiscal_start: int = 1


def _read(given: str | dict | list) -> dict | list:
    return json.loads(Path(given).read_text()) if isinstance(given, str) else given


def _made(cls, values: dict):
    known = {f.name for f in fields(cls)}
    if strange := sorted(set(values) - known):
        raise ValueError(f"{cls.__name__} has no {strange}")
    return cls(**values)


def load_source(given: str | dict) -> Source:
    d = dict(_read(given))
    return Source(d["source_name"], [_made(Entity, e) for e in d.get("entities", [])])


def load_gold(given: str | list) -> list[GoldTable]:
    return [_made(GoldTable, t) for t in _read(given)]


def load_calendar(given: str | dict) -> CalendarSpec:
    return _made(CalendarSpec, dict(_read(given)))


def merge_table(df: DataFrame, spec: TableSpec, path: str, now: datetime | str | None = None) -> DataFrame:
    """Builds rows by their specification and writes them to a table folder: a new history for scd2 (changes as of ``now``),
    a full replacement for ``overwrite``, else an upsert by the merge fields. Returns the table as it then stands."""
    rows, spark = build_table(df, spec), df.sparkSession
    if spec.kind == "scd2":
        recover(spark, path)
        old = spark.read.parquet(path) if exists(spark, path) else None
        replace_table(scd2_merge(old, rows, spec.merge_fields, spec.tracked, now or datetime.now(UTC), spec.key), path)
    elif spec.write_mode == "overwrite":
        replace_table(rows, path)
    else:
        upsert_table(rows, path, spec.merge_fields)
    return spark.read.parquet(path)


def merge_buckets(df: DataFrame, spec: TableSpec, table: BucketTable) -> int:
    """Builds rows by their specification and writes them to a table in buckets, in one pass over them: null and repeated
    keys are found while rows are dealt to buckets, and nothing is published then. An Unknown member that the rows or the
    table have already stays as it is. Returns the table's version."""
    if spec.kind == "scd2":
        raise ValueError(f"{spec.name}: a history is not an upsert by its merge fields")
    if table.keys != spec.merge_fields:
        raise ValueError(f"{spec.name}: the table has the keys {table.keys}")
    kinds = {c: spec.types.get(c, "string") for c in spec.merge_fields} if spec.unknown_member else {}
    rows, guards = build_table(df, spec, one_pass=True), Guards(no_null_keys=True, types=spec.expected or None)
    spare = build_table(unknown_row(df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()}), spec), spec, one_pass=True) if spec.unknown_member else None
    return table.replace(rows, guards, spare) if spec.write_mode == "overwrite" else table.upsert(rows, guards, spare=spare)


def build_gold(spark: SparkSession, tables: list[GoldTable], folder: str | None = None, now: datetime | str | None = None) -> dict[str, DataFrame]:
    """Each table's SELECT, built by its specification, in order; later ones may read earlier ones as views. With a folder,
    each is merged into its table there."""
    out = {}
    for t in tables:
        spec = TableSpec(t.table_name, t.kind, t.merge_fields, t.key, tracked=t.tracked, write_mode=t.write_mode)
        rows = spark.sql(t.select_sql)
        out[t.table_name] = merge_table(rows, spec, f"{folder}/{t.table_name}", now) if folder else build_table(rows, spec)
        out[t.table_name].createOrReplaceTempView(t.table_name)
    return out


def build_calendar(spark: SparkSession, spec: CalendarSpec) -> DataFrame:
    return date_dimension(spark, spec.start_date, spec.end_date, spec.fiscal_start)
