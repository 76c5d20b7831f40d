"""Dot paths, typed values and rich text of JSON documents held in string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPES = {"string": "string", "int": "int", "long": "bigint", "double": "double", "boolean": "boolean"}


def json_path(path: str) -> str:
    """``a.b`` as a JSON path with quoted steps; an empty path is the whole value."""
    return "$" + "".join(f"['{p}']" for p in path.split(".") if p)


def at_path(doc: Column, path: str, default: str | None = None) -> Column:
    """The value at a dot path as text; objects and arrays as JSON; missing steps and JSON null give the default."""
    found = F.get_json_object(doc, json_path(path)) if path else doc
    return found if default is None else F.coalesce(found, F.lit(default))


def typed(value: Column, kind: str, fmt: str | None = None) -> Column:
    """Text to a declared type; what does not fit is null."""
    if kind == "date":
        return F.try_to_date(value, fmt) if fmt else F.to_date(F.try_to_timestamp(value))
    if kind == "timestamp":
        return F.try_to_timestamp(value, F.lit(fmt)) if fmt else F.try_to_timestamp(value)
    if kind not in TYPES:
        raise ValueError(f"unknown data type {kind!r}")
    return value.try_cast(TYPES[kind])


def unquoted(value: Column) -> Column:
    """A JSON string scalar without its quotes, and without leading hash signs."""
    return F.regexp_replace(F.regexp_replace(value, '^"|"$', ""), "^#+", "")


_INLINE = "array<struct<type:string,text:string,attrs:struct<text:string>,content:array<struct<type:string,text:string,attrs:struct<text:string>>>>>"
_EDGES = r"(?U)^\s+|\s+$"


def _joined(blocks: Column) -> Column:
    """Blocks without white space at their ends, empty ones left out, joined by a blank line; nothing left: null."""
    trimmed = F.transform(blocks, lambda t: F.regexp_replace(t, _EDGES, ""))
    return F.nullif(F.array_join(F.filter(trimmed, lambda t: t != ""), "\n\n"), F.lit(""))


def _shown(kind: Column, text: Column, label: Column) -> Column:
    """What a node of the format's four visible types shows, from its text and its attributes' text; null for other types."""
    label = F.coalesce(label, F.lit(""))
    return F.when(kind == "text", F.coalesce(text, F.lit(""))).when(kind == "hardBreak", "\n").when(kind == "mention", F.concat(F.lit("@"), label)).when(kind == "emoji", label)


def _node(n: Column) -> Column:
    return _shown(n["type"], n["text"], n["attrs"]["text"])


def rich_text_flat(doc: Column) -> Column:
    """Text of rich-text JSON whose blocks hold inline nodes, by a declared schema. Blocks are joined by a blank line; empty: null."""
    body = F.coalesce(F.get_json_object(doc, "$.content"), F.when(F.ltrim(doc).startswith("["), doc))
    blocks = F.transform(F.from_json(body, _INLINE), lambda b: F.coalesce(_node(b), F.array_join(F.transform(b["content"], _node), "")))
    return F.when(body.isNull(), F.nullif(doc, F.lit(""))).otherwise(_joined(blocks))


def _nested(n: Column, depth: int) -> Column:
    """Text of a VARIANT node: what it shows itself, else that of its children (a list's elements or an object's content)."""
    get = lambda path, kind="string": F.try_variant_get(n, path, kind)
    children = F.coalesce(get("$", "array<variant>"), get("$.content", "array<variant>"))
    if depth:
        below = F.coalesce(F.array_join(F.transform(children, lambda c: _nested(c, depth - 1)), ""), F.lit(""))
    else:
        below = F.when(F.size(children) > 0, F.raise_error("rich text is nested too deeply: raise depth")).otherwise("")
    return F.coalesce(_shown(get("$.type"), get("$.text"), get("$.attrs.text")), below)


def rich_text(doc: Column | str, depth: int = 12) -> Column:
    """Text of rich-text JSON of any node types, nested to ``depth`` levels below a block, from one parse into a VARIANT.

    The document may be the whole object or its list of blocks. What is no JSON, or has a key twice, stays as it is; a JSON
    scalar is its own text, and none if it is empty, false or zero. Deeper nesting is an error, as text would be lost.
    """

    doc = F.col(doc) if isinstance(doc, str) else doc

    def text(v: Column) -> Column:
        blocks = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$.content", "array<variant>"))
        kind, plain = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
        scalar = F.when(kind == "BOOLEAN", F.when(plain == "true", "True")).when(~kind.startswith("OBJECT") & (F.coalesce(plain.try_cast("double"), F.lit(1.0)) != 0), F.nullif(plain, F.lit("")))
        return F.when(v.isNull(), doc).when(blocks.isNotNull(), _joined(F.transform(blocks, lambda b: _nested(b, depth)))).otherwise(scalar)

    return F.transform(F.array(F.try_parse_json(doc)), text)[0]
