"""Run logs: step states, completed steps, which run to resume."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG = "run_id string, step_name string, status string, logged_at timestamp"


def log_step(spark, path: str, run_id: str, step: str, status: str, at: str) -> None:
    spark.createDataFrame([(run_id, step, status)], "run_id string, step_name string, status string").withColumn("logged_at", F.lit(at).cast("timestamp")).write.mode("append").parquet(path)


def latest_steps(log: DataFrame) -> DataFrame:
    return log.groupBy("run_id", "step_name").agg(F.max_by("status", F.struct("logged_at", "status")).alias("status"), F.max("logged_at").alias("logged_at"))


def completed_steps(log: DataFrame | None, run_id: str) -> set[str]:
    """Steps whose last state in the run is success; a run has as many rows here as it has steps."""
    if log is None:
        return set()
    return {r[0] for r in latest_steps(log.where(F.col("run_id") == run_id)).where("status = 'succeeded'").select("step_name").collect()}


def resolve_run_id(log: DataFrame | None, required: list[str], override: str | None = None) -> str:
    """The run to go on with: an override, the last run if a required step is missing, else a new one."""
    if override:
        return override
    last = log.groupBy("run_id").agg(F.max("logged_at").alias("t")).orderBy(F.desc("t"), "run_id").limit(1).collect() if log is not None else []
    if last and not set(required) <= completed_steps(log, last[0][0]):
        return last[0][0]
    return uuid.uuid4().hex
