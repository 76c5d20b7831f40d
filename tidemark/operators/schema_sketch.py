"""Schemas of JSON loads as small mergeable sketches: (path, type) rows per load, joined along a lattice of types."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH = "load_id string, path string, kind string"
#: The lattice: each type, and those directly above it; ``any`` is above all and ``null`` below all.
ABOVE = {"null": ("boolean", "bigint", "date", "binary", "object", "array"), "bigint": ("decimal",), "decimal": ("double",), "date": ("timestamp_ntz",), "timestamp_ntz": ("timestamp",), "timestamp": ("string",), "double": ("string",), "boolean": ("string",), "string": ("any",), "object": ("any",), "array": ("any",), "binary": ("any",), "any": ()}


def _up(kind: str) -> set[str]:
    found, todo = set(), [kind]
    while todo:
        k = todo.pop()
        found.add(k)
        todo += ABOVE[k]
    return found


def joined(a: str, b: str) -> str:
    """The least type above both."""
    both = _up(a) & _up(b)
    return next(k for k in both if both <= _up(k))


def parse_kind(text: str) -> list[tuple[str, str]]:
    """(path, type) pairs of a type text such as ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``; array elements have the step [*], and
    names with dots, brackets or backticks stand in backticks."""
    found: list[tuple[str, str]] = []

    def name(i: int) -> tuple[str, int]:
        if text[i] != "`":
            j = text.index(":", i)
            return text[i:j], j
        out, i = "", i + 1
        while text[i : i + 2] == "``" or text[i] != "`":
            step = 2 if text[i : i + 2] == "``" else 1
            out, i = out + text[i], i + step
        return out, i + 1

    def kind(i: int, path: str) -> int:
        head = re.match(r"[A-Z_]+", text[i:]).group()
        i += len(head)
        if head not in ("OBJECT", "ARRAY"):
            plain = {"void": "null", "float": "double", "variant": "any"}.get(head.lower(), head.lower())
            found.append((path, plain))
            return text.index(")", i) + 1 if text[i : i + 1] == "(" else i
        found.append((path, head.lower()))
        i += 1  # <
        if head == "ARRAY":
            return kind(i, f"{path}[*]") + 1
        while text[i] != ">":
            step, i = name(i)
            step = f"`{step}`" if any(c in step for c in ".[`") else step
            i = kind(i + 2, f"{path}.{step}" if path else step)
            i += 2 if text[i] == "," else 0
        return i + 1

    kind(0, "")
    return found


def sketch(records: DataFrame, source: str = "raw_data", load: str = "load_id") -> DataFrame:
    """(load_id, path, kind) of each load's records. Spark merges types record by record, partially in each task; a load's
    sketch is as small as its schema. Texts that aren't JSON count for nothing; the root has the path ''."""
    texts = records.groupBy(load).agg(F.schema_of_variant_agg(F.try_parse_json(source)).alias("t")).collect()
    rows = [(r[0], p, k) for r in texts if r["t"] not in (None, "VOID") for p, k in parse_kind(r["t"])]
    return records.sparkSession.createDataFrame(rows, SKETCH)


def merged(sketches: DataFrame) -> list[tuple[str, str]]:
    """One (path, kind) list of several loads' sketches, types joined along the lattice."""
    out: dict[str, str] = {}
    for r in sketches.select("path", "kind").distinct().collect():
        out[r[0]] = joined(out[r[0]], r[1]) if r[0] in out else r[1]
    return sorted(out.items())


def drift(sketches: DataFrame, loads: list[str]) -> DataFrame:
    """How each load differs from what all loads before it, in the given order, have shown: added paths, missing paths, and
    types that the lattice has to widen. No load's records are read again. Columns: load_id, path, change, before, after."""
    by_load: dict[str, dict[str, str]] = {x: {} for x in loads}
    for r in sketches.where(F.col("load_id").isin(loads)).collect():
        by_load[r["load_id"]][r["path"]] = r["kind"]
    rows, known = [], dict(by_load[loads[0]]) if loads else {}
    for x in loads[1:]:
        now = by_load[x]
        rows += [(x, p, "missing", known[p], None) for p in known if p not in now]
        for p, k in now.items():
            if p not in known:
                rows.append((x, p, "added", None, k))
            elif (up := joined(known[p], k)) != known[p]:
                rows.append((x, p, "widened", known[p], up))
            known[p] = joined(known[p], k) if p in known else k
    return sketches.sparkSession.createDataFrame(rows, "load_id string, path string, change string, before string, after string")


def struct_of(paths: list[tuple[str, str]]) -> T.StructType:
    """A schema for ``from_json`` that holds every merged path. What is any, null or mixed is text."""
    kinds = dict(paths)
    plain = {"bigint": T.LongType(), "decimal": T.DoubleType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    below: dict[str, list[tuple[str, str]]] = {}
    for p in kinds:
        if p.endswith("[*]"):
            continue
        at = max((q for q in kinds if q != p and (q == "" or p.startswith(f"{q}.")) and kinds[q] == "object"), key=len, default=None)
        if at is not None and p:
            below.setdefault(at, []).append((p[len(at) + 1 :] if at else p, p))

    def made(path: str) -> T.DataType:
        k = kinds[path]
        if k == "object":
            return T.StructType([T.StructField(n[1:-1] if n.startswith("`") else n, made(p)) for n, p in sorted(below.get(path, []), key=lambda x: x[0].removeprefix("`"))])
        if k == "array":
            return T.ArrayType(made(f"{path}[*]") if f"{path}[*]" in kinds else T.StringType())
        return plain.get(k, T.StringType())

    return made("") if kinds.get("") == "object" else T.StructType([])
