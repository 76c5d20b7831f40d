"""Tables that cut lineage, written to the folder every executor and the driver can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a temporary folder of our own, for a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = _own["path"] = _own.get("path") or tempfile.mkdtemp(prefix="tidemark-", dir="/tmp")
    return path.rstrip("/")


def partitions(df: DataFrame, rows_each: int = 250_000) -> int:
    """How many partitions hold ``df`` with about ``rows_each`` rows each, so what a task sorts or hashes stays as it is while
    tables grow. Small tables get the session's shuffle partitions, or fewer. Counts the rows: of a table, from its footers."""
    n = df.count()
    return max(1, -(-n // rows_each), min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 20_000))


class Scratch:
    """Written tables of one operator call. ``keep`` writes and rereads; ``drop`` removes one that is not needed again, and
    ``last`` writes the result and removes all others, so that only results stay until the folder's owner clears it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame) -> str:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        return path

    def keep(self, df: DataFrame) -> DataFrame:
        schema = df.schema
        return self.spark.read.schema(schema).parquet(self.write(df))

    def last(self, df: DataFrame) -> DataFrame:
        out = self.keep(df)
        for i in range(1, self.n):
            self.drop(f"{self.root}/{i}")
        return out

    def drop(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
