"""Landing raw records: envelope, pages, watermarks, incremental slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.documents import at_path, json_path
from tidemark.operators.history import upsert

ENVELOPE = "primary_key string, raw_data string, source_system string, entity string, load_id string, extracted_at timestamp, ingest_date date"


def envelope(records: DataFrame, source: str, entity: str, load_id: str, key_path: str, extracted_at: str | Column, payload: str | None = None) -> DataFrame:
    """Records wrapped into the seven columns; the key is the value at a dot path of the JSON payload, as text."""
    raw = F.col(payload) if payload else F.to_json(F.struct("*"))
    at = extracted_at if isinstance(extracted_at, Column) else F.lit(extracted_at)
    rows = records.select(raw.alias("raw_data"), at.cast("timestamp").alias("extracted_at"))
    return rows.select(at_path(F.col("raw_data"), key_path).alias("primary_key"), "raw_data", F.lit(source).alias("source_system"), F.lit(entity).alias("entity"), F.lit(load_id).alias("load_id"), "extracted_at", F.to_date("extracted_at").alias("ingest_date"))


def land(rows: DataFrame, path: str, rows_per_file: int = 1_000_000) -> int:
    """Appends an envelope by ingest_date, at most so many rows a file; returns the rows. None: nothing is written. Rows are
    counted while they are written, and keep their partitions: no shuffle."""
    if rows.isEmpty():
        return 0
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("ingest_date").parquet(path)
    return seen.get["n"]


def read_landed(spark, path: str, since: str | None = None, load_id: str | None = None) -> DataFrame:
    """Landed rows, by partition from a date on, or of one load."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    df = df.where(F.col("ingest_date") >= F.lit(since).cast("date")) if since else df
    return df.where(F.col("load_id") == load_id) if load_id else df


def unpack_pages(pages: DataFrame, records_path: str = "", body: str = "body") -> DataFrame:
    """One row (``raw_data``) a record of each page's list; a missing list gives none. Parent and page columns stay."""
    found = F.get_json_object(body, json_path(records_path)) if records_path else F.col(body)
    items = F.from_json(F.when(F.ltrim(found).startswith("["), found), "array<string>")
    return pages.select(*[c for c in pages.columns if c != body], F.explode(items).alias("raw_data"))


def check_pages(pages: DataFrame, page_size: int, total_path: str | None = None, next_path: str | None = None, records_path: str = "") -> DataFrame:
    """Each entity's last page and whether it ends the list: offset and rows reach the total, or no next mark, or a short
    page."""
    found = F.get_json_object("body", json_path(records_path)) if records_path else F.col("body")
    n = F.coalesce(F.json_array_length(found), F.lit(0))
    w = Window.partitionBy("entity").orderBy("page_no")
    rows = pages.withColumn("n", n).withColumn("seen", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_next", F.lead("page_no").over(w)).where("_next is null")
    if total_path:
        done = F.col("seen") >= F.get_json_object("body", json_path(total_path)).try_cast("bigint")
    elif next_path:
        done = F.get_json_object("body", json_path(next_path)).isNull()
    else:
        done = F.col("n") < page_size
    return rows.select("entity", "page_no", "seen", F.coalesce(done, F.lit(False)).alias("is_complete"))


def tag_parents(records: DataFrame, parents: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Records with ``_parent_id``, and each parent's outcome: with rows or without."""
    tagged = records.withColumn("_parent_id", F.col(key))
    outcome = parents.join(tagged.groupBy("_parent_id").agg(F.count("*").alias("records")), parents[key] == F.col("_parent_id"), "left").select(parents[key].alias("parent_id"), F.coalesce("records", F.lit(0)).alias("records"))
    return tagged, outcome.withColumn("status", F.when(F.col("records") > 0, "loaded").otherwise("skipped"))


def get_watermark(control: DataFrame | None, entity: str, initial: str) -> str:
    row = control.where(F.col("entity_name") == entity).select("last_watermark").limit(1).collect() if control is not None else []
    return row[0][0] if row and row[0][0] is not None else initial


def new_watermark(records: DataFrame, path: str, started: str | Column, by: list[str] | None = None) -> DataFrame:
    """last_watermark: the largest value at a path, ISO instants cut to the minute, so the next slice overlaps; nothing
    there: the extraction's start."""
    value = F.max(at_path(F.col("raw_data"), path))
    begun = started if isinstance(started, Column) else F.lit(started)
    cut = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}"), F.concat(F.substring(value, 1, 10), F.lit(" "), F.substring(value, 12, 5))).otherwise(value)
    return records.groupBy(*(by or [])).agg(F.coalesce(cut, begun).alias("last_watermark"))


def save_watermark(control: DataFrame | None, entity: str, value: str, at: str, spark) -> DataFrame:
    row = spark.createDataFrame([(entity, value)], "entity_name string, last_watermark string").withColumn("updated_at", F.lit(at).cast("timestamp"))
    return upsert(control, row, ["entity_name"])


def slice_since(df: DataFrame, column: str, watermark: str) -> DataFrame:
    return df.where(F.col(column) >= F.lit(watermark).cast(dict(df.dtypes)[column]))
