"""JSON records parsed once, as VARIANT values, from which all columns and child rows are taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from tidemark.functions.documents import json_path, typed
from tidemark.operators.semi import ExplodeSpec, Mapping


def parsed(df: DataFrame, source: str = "raw_data", out: str = "_v") -> DataFrame:
    """``df`` with its JSON texts as a VARIANT column; texts that aren't JSON, or have a key twice, give null. A column that is
    VARIANT already is taken as it is, so children of children cost no parse."""
    v = F.col(source) if isinstance(df.schema[source].dataType, VariantType) else F.try_parse_json(F.col(source))
    return df.withColumn(out, v)


def text_at(v: Column, path: str) -> Column:
    """The value at a dot path as text; objects and arrays as JSON; missing steps and JSON null: null."""
    return F.try_variant_get(v, json_path(path), "string")


def map_records(df: DataFrame, mappings: list[Mapping], source: str = "raw_data", keep: list[str] | None = None) -> DataFrame:
    """The mapped columns of each record, from one parse of its text whatever their number. Malformed texts give nulls.
    Numbers read as text are in their shortest form, 1.50 as 1.5."""
    return parsed(df, source).select(*(keep or []), *[typed(text_at(F.col("_v"), m.path), m.kind, m.fmt).alias(m.target) for m in mappings])


def explode_records(df: DataFrame, spec: ExplodeSpec, elements: str | None = None) -> DataFrame:
    """One row an element of a nested array, with the parent's key, carried columns and mapped values. A missing array, an
    empty one and what is no array give nothing. elements: a name under which the element itself stays, as VARIANT, for a
    further level."""
    base = parsed(df, spec.source)
    parent = text_at(F.col("_v"), spec.parent_path) if spec.parent_path is not None else F.col(spec.parent_name)
    items = F.try_variant_get(F.col("_v"), json_path(spec.array_path), "array<variant>")
    rows = base.select(parent.alias(spec.parent_name), *spec.carry, F.explode(items).alias("_e"))
    made = [typed(text_at(F.col("_e"), m.path), m.kind, m.fmt).alias(m.target) for m in spec.mappings]
    return rows.select(spec.parent_name, *spec.carry, *([F.col("_e").alias(elements)] if elements else []), *made)


def shape(v: Column, path: str = "") -> Column:
    """object, array, null or scalar: what stands at a path; null where nothing does."""
    kind = F.schema_of_variant(F.try_variant_get(v, json_path(path), "variant"))
    return F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "VOID", "null").when(kind.isNotNull(), "scalar")


def one_of_shapes(v: Column, path: str, fields: list[str], separator: str = ", ") -> Column:
    """Text of a value that some records write plainly, some as an object, some as a list of either: the scalar itself, the
    first of ``fields`` that the object has, or the list's texts joined. Objects without such a field: their JSON."""
    at = json_path(path)

    def single(x: Column) -> Column:
        named = [F.try_variant_get(x, json_path(f), "string") for f in fields]
        return F.coalesce(*named, F.try_variant_get(x, "$", "string"))

    whole = F.try_variant_get(v, at, "variant")
    many = F.try_variant_get(v, at, "array<variant>")
    return F.when(shape(v, path) == "array", F.array_join(F.transform(many, single), separator)).when(shape(v, path) != "null", single(whole))


def unpack_records(pages: DataFrame, records_path: str = "", body: str = "body") -> DataFrame:
    """One row a record of each page's list, as VARIANT in ``record``; other columns stay. A body that is no JSON, or has no
    list there, gives none."""
    items = F.try_variant_get(F.col("_v"), json_path(records_path), "array<variant>")
    rest = [c for c in pages.columns if c != body]
    return parsed(pages, body).select(*rest, F.explode(items).alias("record"))
