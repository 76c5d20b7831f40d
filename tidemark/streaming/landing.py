"""Landing as a stream: new files become envelopes, batches are upserted by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.clean import dedup_latest
from tidemark.sources.buckets import BucketTable
from tidemark.sources.landing import envelope
from tidemark.sources.sinks import upsert_table


def stream_envelopes(spark: SparkSession, path: str, schema: str, source: str, entity: str, key_path: str, load_id: str = "stream") -> DataFrame:
    records = spark.readStream.schema(schema).parquet(path)
    return envelope(records, source, entity, load_id, key_path, F.current_timestamp())


def land_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return rows.writeStream.option("checkpointLocation", checkpoint).partitionBy("ingest_date").trigger(availableNow=True).format("parquet").start(path)


def upsert_stream(rows: DataFrame, path: str, keys: list[str], order_by: str, checkpoint: str, tiebreak: list[str] | None = None) -> StreamingQuery:
    """Each batch's newest row of a key replaces the table's; a batch that runs twice changes nothing, if ``order_by`` and
    ``tiebreak`` tell a key's rows apart."""

    def write(batch: DataFrame, _: int) -> None:
        upsert_table(dedup_latest(batch, keys, order_by, tiebreak), path, keys)

    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def upsert_bucket_stream(rows: DataFrame, table: BucketTable, order_by: str, tiebreak: list[str], name: str, checkpoint: str) -> StreamingQuery:
    """``upsert_stream`` into a table in buckets: a batch rewrites only the buckets of its keys, and the table's version
    records the stream's batch, so one that runs twice changes nothing. tiebreak: columns that order rows of one instant."""

    def write(batch: DataFrame, number: int) -> None:
        table.upsert(dedup_latest(batch, table.keys, order_by, tiebreak), batch=(name, number))

    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def windowed_counts(events: DataFrame, at: str, keys: list[str], length: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Events per window and key, with a watermark for late rows; for streams and batches alike."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return events.withWatermark(at, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")
