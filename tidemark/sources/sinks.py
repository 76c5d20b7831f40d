"""Table folders: discovery, staged replacement, concurrent jobs, model views."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import InheritableThread
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.clean import clean_tabular, profile
from tidemark.operators.history import upsert
from tidemark.operators.semi import distinct_names


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def replace_table(df: DataFrame, path: str, **options: str) -> None:
    """Full replacement by a staged folder and a swap, so a table may be read, changed and written back.

    The old table is moved aside, and deleted only when the new one is in its place; ``recover`` mends a swap that broke off.
    """
    spark, staged = df.sparkSession, f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    recover(spark, path)
    df.write.options(**options).parquet(staged)
    fs, target = _fs(spark, path)
    aside = _fs(spark, _aside(path))[1]
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"{path} could not be moved aside")
    if not fs.rename(_fs(spark, staged)[1], target):
        raise OSError(f"{staged} could not be moved to {path}")
    fs.delete(aside, True)


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}__before"


def recover(spark: SparkSession, path: str) -> bool:
    """Puts a table back that a broken swap has left aside; True if it did."""
    fs, target = _fs(spark, path)
    aside = _fs(spark, _aside(path))[1]
    if not fs.exists(aside):
        return False
    if fs.exists(target):  # the new table is in its place, only the deletion was missed
        fs.delete(aside, True)
        return False
    if not fs.rename(aside, target):
        raise OSError(f"{aside} could not be moved back")
    return True


def upsert_table(df: DataFrame, path: str, keys: list[str]) -> None:
    spark = df.sparkSession
    recover(spark, path)
    replace_table(upsert(spark.read.parquet(path) if exists(spark, path) else None, df, keys), path)


def retire_columns(spark: SparkSession, path: str, columns: list[str]) -> bool:
    """Drops those of the columns that a table has; none: the table stays untouched."""
    df = spark.read.parquet(path)
    gone = [c for c in columns if c in df.columns]
    if gone:
        replace_table(df.drop(*gone), path)
    return bool(gone)


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or no rows of its schema where it is missing."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def ancient_dates(spark: SparkSession) -> None:
    """Dates before 1582 are read and written as they stand."""
    for side in ("Read", "Write"):
        spark.conf.set(f"spark.sql.parquet.datetimeRebaseModeIn{side}", "CORRECTED")
        spark.conf.set(f"spark.sql.parquet.int96RebaseModeIn{side}", "CORRECTED")


def table_folders(spark: SparkSession, root: str, skip: tuple[str, ...] = (), skip_prefixes: tuple[str, ...] = ()) -> list[str]:
    fs, p = _fs(spark, root)
    names = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []
    bad = tuple(x.lower() for x in skip_prefixes)
    return [n for n in names if n not in skip and not n.startswith(("_", ".")) and not (bad and n.lower().startswith(bad))]


@dataclass
class TableReport:
    name: str
    status: str
    rows: int = 0
    dropped: tuple[str, ...] = ()
    error: str = ""


def clean_folder(spark: SparkSession, source: str, target: str, fmt: str = "parquet", workers: int = 8, prune: bool = True, skip: tuple[str, ...] = (), skip_prefixes: tuple[str, ...] = (), limit: float | None = None) -> list[TableReport]:
    """Every table folder of source cleaned into target, several at once, each in a pool of its name; a table's failure is
    reported and stops no other, and one that takes more than ``limit`` seconds is cancelled alone.
    Targets whose folder is gone are removed, unless nothing at all was found."""

    def one(name: str) -> TableReport:
        try:
            df = spark.read.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).load(f"{source}/{name}")
            seen = profile(df)
            if not seen["*"]:
                return TableReport(name, "empty")
            out = clean_tabular(df)
            out = out.toDF(*distinct_names(out.columns))
            replace_table(out, f"{target}/{name}")
            return TableReport(name, "written", seen["*"], tuple(c for c in df.columns if not seen[c] and not c.startswith("_")))
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):
                return TableReport(name, "empty")
            return TableReport(name, "failed", error=str(e)[:300])
        except Exception as e:  # noqa: BLE001  a table's failure is its report
            return TableReport(name, "failed", error=str(e)[:300])

    names, made = table_folders(spark, source, skip, skip_prefixes), {}
    ends = run_fairly(spark, {n: (lambda n=n: made.__setitem__(n, one(n))) for n in names}, workers, limit)
    made |= {r.name: TableReport(r.name, r.status, error=r.error) for r in ends if r.name not in made or r.status == "cancelled"}
    reports = [made[n] for n in names]
    if prune and names:
        for gone in set(table_folders(spark, target)) - set(names):
            fs, p = _fs(spark, f"{target}/{gone}")
            fs.delete(p, True)
            reports.append(TableReport(gone, "pruned"))
    return reports


def model_view(df: DataFrame, drop: tuple[str, ...] = (), proper: tuple[str, ...] = ()) -> DataFrame:
    """Column names in words, some values in proper case, some columns left out."""
    out = df.drop(*drop).withColumns({c: F.initcap(c) for c in proper})
    return out.toDF(*[c.replace("_", " ") for c in out.columns])


def role_playing(dim: DataFrame, prefix: str) -> DataFrame:
    """A dimension under another role's column names."""
    return dim.toDF(*[f"{prefix}_{c}" for c in dim.columns])


def fair_settings(pools: dict[str, tuple[int, int]], file: str) -> dict[str, str]:
    """Settings for a new session in which jobs of different pools share the cores: each pool has a weight and a least
    number of cores. Written to a file that the driver reads; pools that it doesn't name get weight 1 and no least."""
    named = "".join(f'<pool name="{n}"><schedulingMode>FAIR</schedulingMode><weight>{w}</weight><minShare>{m}</minShare></pool>' for n, (w, m) in pools.items())
    with open(file, "w") as out:
        out.write(f"<?xml version='1.0'?><allocations>{named}</allocations>")
    return {"spark.scheduler.mode": "FAIR", "spark.scheduler.allocation.file": f"file://{file}"}


@dataclass
class JobReport:
    name: str
    status: str
    seconds: float
    error: str = ""


def run_fairly(spark: SparkSession, jobs: dict[str, Callable[[], object]], workers: int = 8, limit: float | None = None, pool: Callable[[str], str] | None = None) -> list[JobReport]:
    """Jobs side by side, each in a pool (of its own name unless ``pool`` gives another) and a job group of its own, in the
    order in which they end.

    In a session of ``fair_settings`` a small table ends while a large one that began first still runs; without them pools
    don't matter and stages queue. A job that fails is reported and stops no other. One that takes more than ``limit``
    seconds is cancelled by its group, alone: its running tasks are interrupted, and it is reported as ``cancelled``.
    """
    context, order, guard = spark.sparkContext, [], threading.Lock()

    def one(name: str, work: Callable[[], object]) -> None:
        group, late, begun = f"{name}-{uuid.uuid4().hex}", threading.Event(), time.monotonic()
        context.setLocalProperty("spark.scheduler.pool", pool(name) if pool else name)
        context.setJobGroup(group, name, interruptOnCancel=True)

        def stop() -> None:
            late.set()
            context.cancelJobGroup(group)

        timer = threading.Timer(limit, stop) if limit else None
        if timer:
            timer.start()
        try:
            work()
            report = JobReport(name, "succeeded", time.monotonic() - begun)
        except Exception as e:  # noqa: BLE001  a job's failure is its report
            report = JobReport(name, "cancelled" if late.is_set() else "failed", time.monotonic() - begun, str(e)[:300])
        finally:
            if timer:
                timer.cancel()
            context.setLocalProperty("spark.scheduler.pool", None)
            context.setLocalProperty("spark.jobGroup.id", None)
        with guard:
            order.append(report)

    def worker() -> None:
        while True:
            with guard:
                if not waiting:
                    return
                name, work = waiting.pop(0)
            one(name, work)

    waiting = list(jobs.items())
    threads = [InheritableThread(target=worker, session=spark) for _ in range(min(workers, len(jobs)))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return order


def run_all(jobs: dict[str, Callable[[], object]], workers: int = 8) -> dict[str, str]:
    def one(item):
        try:
            item[1]()
            return item[0], "succeeded"
        except Exception as e:  # noqa: BLE001
            return item[0], f"failed: {e}"[:300]

    with ThreadPoolExecutor(workers) as pool:
        return dict(pool.map(one, jobs.items()))
