"""How many rows travel to Python at once, and what Python workers keep."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CACHES: dict[str, tuple[dict, ...]] = {}


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows where the session still has Spark's 10,000: a task holds a batch whole, in the JVM and in
    Python, and texts and sets are long. A session's own number stays."""
    if int(spark.conf.get(_SETTING)) == 10_000:
        spark.conf.set(_SETTING, 1_000)


def hand_back() -> None:
    """Gives memory that this process no longer uses back to the system; allocators would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def caches(owner: str, *kept: dict) -> None:
    """Names what an operator's tasks leave in their process for the next ones."""
    _CACHES[owner] = kept


def forget_others(owner: str) -> None:
    """Empties what other operators' tasks have left in this process."""
    for name, kept in _CACHES.items():
        if name != owner:
            for cache in kept:
                cache.clear()


def handing_back(run: Callable[[Iterator], Iterator], owner: str = "") -> Callable[[Iterator], Iterator]:
    """A function of batches that begins by ``forget_others`` and ends by ``hand_back``. Workers live on between tasks and
    stages, beside a JVM and other workers that need the memory."""

    def released(batches: Iterator) -> Iterator:
        try:
            forget_others(owner)
            yield from run(batches)
        finally:
            hand_back()

    return released
