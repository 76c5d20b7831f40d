"""Semi-structured records to tables: flattening, array handling, exploding, renaming."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.documents import at_path, json_path, rich_text, typed
from tidemark.operators.clean import dedup_latest, drop_empty_columns, exclude_columns

ALWAYS_DROPPED = ["expand", "self", "*_self"]


@dataclass
class Mapping:
    """A target column from a dot path, with a declared type."""

    target: str
    path: str
    kind: str = "string"
    fmt: str | None = None


def map_columns(df: DataFrame, mappings: list[Mapping], source: str = "raw_data", keep: list[str] | None = None) -> DataFrame:
    return df.select(*(keep or []), *[typed(at_path(F.col(source), m.path), m.kind, m.fmt).alias(m.target) for m in mappings])


def clean_name(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z_]", "_", name)).strip("_")


def distinct_names(names: list[str]) -> list[str]:
    """Sanitised names; a later one that meets an earlier one (in any case) gets a number."""
    seen: set[str] = set()
    out = []
    for n in names:
        base = made = clean_name(n) or "column"
        i = 2
        while made.lower() in seen:
            made, i = f"{base}_{i}", i + 1
        seen.add(made.lower())
        out.append(made)
    return out


def _array_text(c: Column, kind: T.ArrayType) -> Column:
    e = kind.elementType
    if isinstance(e, T.StringType):
        return F.array_join(c, ", ")
    for name in ("value", "displayName"):
        if isinstance(e, T.StructType) and name in e.fieldNames():
            return F.array_join(c.getField(name).cast("array<string>"), ", ")
    return F.to_json(c)


def _leaves(schema: T.StructType, at: Column | None, prefix: str, depth: int):
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if at is None else at.getField(f.name)
        name = f"{prefix}_{f.name}" if prefix else f.name
        if isinstance(f.dataType, T.StructType) and depth > 0:
            yield from _leaves(f.dataType, c, name, depth - 1)
        elif isinstance(f.dataType, T.ArrayType):
            yield name, _array_text(c, f.dataType)
        elif isinstance(f.dataType, T.StructType | T.MapType):
            yield name, F.to_json(c)
        else:
            yield name, c


def flatten(df: DataFrame, depth: int = 5) -> DataFrame:
    """Structs become ``a_b_c`` columns down to a depth; arrays and what is deeper become text."""
    found = list(_leaves(df.schema, None, "", depth))
    return df.select(*[c.alias(n) for (_, c), n in zip(found, distinct_names([n for n, _ in found]), strict=True)])


def infer_schema(df: DataFrame, source: str = "raw_data", ratio: float = 1.0) -> T.StructType:
    """Schema of JSON texts from one pass over all rows, or over a share of them; the texts stay in the JVM."""
    spark, texts = df.sparkSession, df.select(F.col(source).cast("string")).where(F.col(source).isNotNull())
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return T.StructType.fromJson(json.loads(spark._jsparkSession.read().option("samplingRatio", str(ratio)).json(strings).schema().json()))


def _unlike(kind: T.DataType) -> T.DataType:
    """A struct type whose fields, down to the first array, differ in more than their case."""
    if not isinstance(kind, T.StructType):
        return kind
    names = kind.fieldNames()
    if len({n.lower() for n in names}) < len(names):
        names = distinct_names(names)
    return T.StructType([T.StructField(n, _unlike(f.dataType)) for n, f in zip(names, kind.fields, strict=True)])


def _nullable(schema: T.StructType) -> T.StructType:
    """What a JSON text may lack, it may lack everywhere: no declared field or element is certain."""
    return T.StructType.fromJson(json.loads(re.sub(r'("nullable"|"containsNull"|"valueContainsNull"):false', r"\1:true", schema.json())))


def auto_standardize(df: DataFrame, source: str = "raw_data", depth: int = 5, carry: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """JSON payload to flat columns; a declared schema skips the inference pass."""
    schema = _nullable(schema or infer_schema(df, source))
    plain = _unlike(schema)
    body = F.from_json(source, schema)
    parsed = df.select(*(carry or []), (body if plain == schema else body.cast(plain)).alias("_p"))
    schema = plain
    found = list(_leaves(schema, F.col("_p"), "", depth))
    names = distinct_names([*(carry or []), *[n for n, _ in found]])[len(carry or []) :]
    return parsed.select(*(carry or []), *[c.alias(n) for (_, c), n in zip(found, names, strict=True)])


def run_auto_standardize(df: DataFrame, keys: list[str], order_by: str | None = None, exclude: list[str] | None = None, post=None, sort_columns: bool = True, **kw) -> DataFrame:
    """Flatten, exclude, keep the newest of each key (ties by all columns), drop empty columns, post-process, exclude again, order columns."""
    drop = [*ALWAYS_DROPPED, *(exclude or [])]
    out = exclude_columns(auto_standardize(df, **kw), drop)
    if order_by:
        out = dedup_latest(out, keys, order_by, [c for c in out.columns if c not in (*keys, order_by)])
    out = drop_empty_columns(out, tuple(keys))
    out = exclude_columns(post(out) if post else out, drop)
    return out.select(*sorted(out.columns)) if sort_columns else out


@dataclass
class ExplodeSpec:
    """A child table of a nested array: one row an element, with the parent's key and carried columns."""

    array_path: str
    mappings: list[Mapping]
    parent_name: str
    parent_path: str | None = None
    source: str = "raw_data"
    carry: list[str] = field(default_factory=list)


def explode_array(df: DataFrame, spec: ExplodeSpec) -> DataFrame:
    """Rows whose array is missing, empty or no array give nothing. A mapping with an empty path takes the element."""
    doc = F.col(spec.source)
    body = F.get_json_object(doc, json_path(spec.array_path)) if spec.array_path else doc
    parent = at_path(doc, spec.parent_path) if spec.parent_path is not None else F.col(spec.parent_name)
    items = F.from_json(F.when(F.ltrim(body).startswith("["), body), "array<string>")
    rows = df.select(parent.alias(spec.parent_name), *[c for c in spec.carry], F.explode(items).alias("_e"))
    keep = [spec.parent_name, *spec.carry]
    return rows.select(*keep, *[typed(at_path(F.col("_e"), m.path), m.kind, m.fmt).alias(m.target) for m in spec.mappings])


def _issue(path: str, **kw: str) -> ExplodeSpec:
    return ExplodeSpec(path, [Mapping(k, v) for k, v in kw.items()], "issue_key", "key")


#: Child tables of an issue tracker's records: array path, target columns and their paths.
CHILD_TABLES = {
    "issue_links": _issue("fields.issuelinks", link_id="id", link_type="type.name", inward_label="type.inward", outward_label="type.outward", inward_issue_key="inwardIssue.key", outward_issue_key="outwardIssue.key"),
    "issue_components": _issue("fields.components", component_id="id", component_name="name"),
    "issue_fix_version": _issue("fields.fixVersions", version_id="id", version_name="name"),
    "issue_affects_version": _issue("fields.versions", version_id="id", version_name="name"),
    "issue_labels": _issue("fields.labels", label=""),
    "comments": _issue("fields.comment.comments", comment_id="id", author_account_id="author.accountId", body="body", created="created"),
    "issue_people_involved": _issue("fields.people", person_account_id="accountId", person_name="displayName", person_email="emailAddress", person_active="active"),
    "worklogs": _issue("fields.worklog.worklogs", worklog_id="id", author_account_id="author.accountId", started="started", time_spent_seconds="timeSpentSeconds"),
    "histories": _issue("changelog.histories", history_id="id", author_account_id="author.accountId", created="created", items="items"),
    "attachments": _issue("fields.attachment", attachment_id="id", filename="filename", size="size"),
    "issue_subtasks": _issue("fields.subtasks", subtask_id="id", subtask_key="key"),
    "issue_sprints": _issue("fields.sprints", sprint_id="id", sprint_name="name", state="state"),
    "history_items": ExplodeSpec("", [Mapping("field_name", "field"), Mapping("old_value", "from"), Mapping("old_value_formatted", "fromString"), Mapping("new_value", "to"), Mapping("new_value_formatted", "toString")], "history_id", None, "items", ["issue_key"]),
    "audit_log_changed_values": ExplodeSpec("changedValues", [Mapping("field_name", "fieldName"), Mapping("changed_from", "changedFrom"), Mapping("changed_to", "changedTo")], "record_id", "id"),
    "audit_log_associated_items": ExplodeSpec("associatedItems", [Mapping("item_id", "id"), Mapping("item_name", "name"), Mapping("item_type", "typeName")], "record_id", "id"),
    "dashboard_edit_permissions": ExplodeSpec("editPermissions", [Mapping("permission_id", "id"), Mapping("kind", "type"), Mapping("user_id", "user.accountId"), Mapping("group_name", "group.name"), Mapping("project_id", "project.id"), Mapping("role_id", "role.id")], "dashboard_id", "id"),
    "dashboard_share_permissions": ExplodeSpec("sharePermissions", [Mapping("permission_id", "id"), Mapping("kind", "type"), Mapping("user_id", "user.accountId"), Mapping("group_name", "group.name"), Mapping("project_id", "project.id"), Mapping("role_id", "role.id")], "dashboard_id", "id"),
    "project_role_actors": ExplodeSpec("actors", [Mapping("actor_id", "id"), Mapping("actor_name", "displayName"), Mapping("kind", "type"), Mapping("account_id", "actorUser.accountId"), Mapping("group_name", "actorGroup.name")], "role_id", "id"),
    "project_issue_types": ExplodeSpec("issueTypes", [Mapping("issue_type_id", "id"), Mapping("issue_type_name", "name")], "project_id", "id"),
}


def clean_rich_text_columns(df: DataFrame, convert=rich_text) -> DataFrame:
    """``X_content``, ``X_type`` and ``X_version`` together are rich text: converted to ``X``, the others dropped."""
    stems = [c[: -len("_content")] for c in df.columns if c.endswith("_content")]
    for x in stems:
        if f"{x}_type" in df.columns and f"{x}_version" in df.columns and x not in df.columns:
            df = df.withColumn(f"{x}_content", convert(F.col(f"{x}_content"))).withColumnRenamed(f"{x}_content", x).drop(f"{x}_type", f"{x}_version")
    return df


def field_names(lookup: DataFrame, id_column: str = "id", name_column: str = "name", most: int = 100_000) -> dict[str, str]:
    """A lookup table of field names, which is as small as a schema; a larger one is an error."""
    rows = lookup.select(id_column, name_column).where(F.col(name_column).isNotNull()).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} field names")
    return {r[0]: r[1] for r in rows}


def rename_fields(df: DataFrame, names: dict[str, str], pattern: str = r"customfield_\d+") -> DataFrame:
    """The part of a column's name that matches becomes its friendly name; names that meet all get their digits."""
    made = {}
    for c in df.columns:
        m = re.search(pattern, c)
        if m and m.group() in names:
            made[c] = c[: m.start()] + clean_name(names[m.group()]) + c[m.end() :]
    taken: dict[str, int] = {}
    for c in df.columns:
        n = made.get(c, c).lower()
        taken[n] = taken.get(n, 0) + 1
    return df.withColumnsRenamed({c: f"{n}_{re.sub(r'[^0-9]', '', re.search(pattern, c).group())}" if taken[n.lower()] > 1 else n for c, n in made.items()})


def parse_payload(df: DataFrame, schema: str | T.StructType, source: str = "raw_data") -> DataFrame:
    return df.select(F.from_json(source, schema).alias("_p")).select("_p.*")
