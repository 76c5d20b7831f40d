"""Tables in hash buckets of their key: a write rewrites the buckets it touches, and readers follow one pointer file.

A version is a small file that names, for each bucket, the folder that holds its rows; folders are written once and never
changed. Publishing a version is one rename, so a reader has the version before it or the one after it, whole, and goes on
reading what it began. Untouched buckets keep their files. A write's guards (null keys, repeated keys, types) are counted
while its rows are dealt to buckets, in the one exchange and the one pass over the source that the write needs anyway; if
one fails, nothing is published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.sources.sinks import _fs

_BUCKET, _TURN, _NEW, _SPARE = "__bucket", "__turn", "__new", "__spare"
_WIDER = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


@dataclass
class Guards:
    """What must hold for the rows of a write. types: column to type, columns that must be there."""

    no_null_keys: bool = False
    types: dict[str, str] | None = None


def wider(old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both: equal ones, longer whole numbers, float to double; else an error."""
    a, b = old.simpleString(), new.simpleString()
    if a == b:
        return old
    if a in _WIDER and b in _WIDER:
        return old if _WIDER[a] > _WIDER[b] else new
    if {a, b} == {"float", "double"}:
        return T.DoubleType()
    raise TypeError(f"{a} and {b} have no common type here")


class BucketTable:
    """A table at ``path`` with ``keys``, in ``buckets`` hash buckets; both are fixed when it is made. A bucket is one task
    and one file at a write: choose a number that keeps a bucket near some 100 MB."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int = 64) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        state = self.manifest()
        if state is None and not keys:
            raise ValueError(f"{path} holds no table, and no keys are given to make one")
        if state is not None and keys and keys != state["keys"]:
            raise ValueError(f"{path} has the keys {state['keys']}")
        self.keys, self.buckets = (state["keys"], state["buckets"]) if state else (list(keys), buckets)

    # -- versions

    def _names(self) -> list[str]:
        fs, p = _fs(self.spark, f"{self.path}/_versions")
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names() if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict | None:
        """A version's contents, of the newest if none is named; None where there is no table."""
        have = self.versions()
        if version is None and not have:
            return None
        if version is not None and version not in have:
            raise ValueError(f"{self.path} has no version {version}, but {have}")
        fs, p = _fs(self.spark, f"{self.path}/_versions/{have[-1] if version is None else version:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, state: dict, before: dict | None) -> int:
        """Claims the next number, which only one writer can, writes the version aside and renames it into its place."""
        number = (before["version"] if before else 0) + 1
        name = f"{self.path}/_versions/{number:012d}"
        fs, claim = _fs(self.spark, f"{name}.claim")
        try:
            fs.create(claim, False).close()
        except Exception as e:
            raise RuntimeError(f"version {number} of {self.path} is another writer's; run again, or recover() after a broken one") from e
        aside = _fs(self.spark, f"{name}.{uuid.uuid4().hex}.tmp")[1]
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(state | {"version": number, "keys": self.keys, "buckets": self.buckets}).encode()))
        out.close()
        if not fs.rename(aside, _fs(self.spark, f"{name}.json")[1]):
            raise OSError(f"{name}.json could not be put in its place")
        return number

    def recover(self) -> list[str]:
        """Removes claims and parts of versions that were never published; only while no writer runs."""
        names = self._names()
        broken = [n for n in names if n.endswith(".tmp") or n.endswith(".claim") and f"{n[:12]}.json" not in names]
        for n in broken:
            fs, p = _fs(self.spark, f"{self.path}/_versions/{n}")
            fs.delete(p, False)
        return broken

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes versions but the last ``keep``, and folders that none of those names; only while no writer runs."""
        have = self.versions()
        for v in have[:-keep]:
            for kind in ("json", "claim"):
                fs, p = _fs(self.spark, f"{self.path}/_versions/{v:012d}.{kind}")
                fs.delete(p, False)
        named = {f.split("/")[1] for v in have[-keep:] for f in self.manifest(v)["files"].values()}
        fs, p = _fs(self.spark, f"{self.path}/data")
        gone = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName() not in named) if fs.exists(p) else []
        for n in gone:
            fs.delete(_fs(self.spark, f"{self.path}/data/{n}")[1], True)
        return gone

    # -- reading

    def read(self, version: int | None = None) -> DataFrame:
        state = self.manifest(version)
        if state is None:
            raise ValueError(f"{self.path} holds no table")
        return self._rows(state, state["files"])

    def _rows(self, state: dict, buckets: Iterable[str]) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        paths = sorted(f"{self.path}/{state['files'][b]}" for b in buckets)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- writing

    def upsert(self, source: DataFrame, guards: Guards | None = None, batch: tuple[str, int] | None = None, spare: DataFrame | None = None) -> int:
        """Source rows replace rows of equal keys (null parts are equal), others stay; returns the version. Only buckets of
        the source's keys are read and written. New source columns widen the table, columns that the source lacks become null
        in replaced rows, longer number types widen the column. No rows: no new version, unless columns are new. Repeated keys
        are an error. batch: a stream's name and its batch; one that the table has already changes nothing. spare:
        rows of the source's columns that come in only where neither source nor table has their key."""
        return self._change(source, guards, batch, spare, keep_old=True)

    def replace(self, source: DataFrame, guards: Guards | None = None, spare: DataFrame | None = None) -> int:
        """The source becomes the table; it may have been read from it."""
        return self._change(source, guards, None, spare, keep_old=False)

    def delete(self, keys: DataFrame) -> int:
        """Without the rows of these keys; buckets that get empty are left out."""
        before = self.manifest()
        if before is None:
            raise ValueError(f"{self.path} holds no table")
        schema = T.StructType.fromJson(before["schema"])
        gone = self._bucketed(keys.select(*self.keys).distinct(), schema)
        staged, touched = self._stage(gone, None)
        touched = [b for b in touched if b in before["files"]]
        if not touched:
            return before["version"]
        old = self._bucketed(self._rows(before, touched), schema).withColumn(_NEW, F.lit(0))
        rows = old.unionByName(self.spark.read.schema(gone.schema).parquet(staged).withColumn(_NEW, F.lit(1)), allowMissingColumns=True)
        made = self._merged(rows, len(touched)).where(f"{_NEW} = 0")
        written = self._write(made.drop(_NEW))
        return self._publish(before | {"files": {b: f for b, f in before["files"].items() if b not in touched} | written}, before)

    def retire(self, columns: list[str]) -> int:
        """Without these columns. Their buckets are written anew, so that a later column of such a name starts empty."""
        before = self.manifest()
        if set(columns) & set(self.keys):
            raise ValueError("keys can't be retired")
        if before is None or not set(columns) & {f["name"] for f in before["schema"]["fields"]}:
            return before["version"] if before else 0
        return self.replace(self.read().drop(*columns))

    def _change(self, source: DataFrame, guards: Guards | None, batch: tuple[str, int] | None, spare: DataFrame | None, keep_old: bool) -> int:
        before = self.manifest()
        done = (before or {}).get("batches", {})
        if batch and done.get(batch[0], -1) >= batch[1]:
            return before["version"]
        if missing := [k for k in self.keys if k not in source.columns]:
            raise ValueError(f"keys missing: {missing}")
        if strange := [c for c in source.columns if c.lower() in (_BUCKET, _TURN, _NEW, _SPARE)]:
            raise ValueError(f"reserved names: {strange}")
        if guards and guards.types is not None:
            have = dict(source.dtypes)
            if wrong := [f"{c}: {have.get(c, 'missing')} for {t}" for c, t in guards.types.items() if have.get(c) != t]:
                raise ValueError("columns differ: " + "; ".join(wrong))
        schema = self._schema(before if keep_old else None, source)
        narrow = T.StructType([f for f in schema if f.name in source.columns])
        staged, touched = self._stage(self._bucketed(source, narrow), guards, self._bucketed(spare.select(*source.columns), narrow) if spare is not None else None)
        same = before is not None and schema.jsonValue() == before["schema"]
        if not touched and same and keep_old and not batch:
            return before["version"]
        old = [b for b in touched if keep_old and before and b in before["files"]]
        files = dict(before["files"]) if keep_old and before else {}
        files |= {b: f"{staged.removeprefix(self.path + '/')}/{_BUCKET}={b}" for b in touched}  # new buckets are as they were staged
        if old:
            new = self.spark.read.schema(T.StructType([*narrow, T.StructField(_SPARE, T.BooleanType()), T.StructField(_BUCKET, T.IntegerType())])).parquet(staged).where(F.col(_BUCKET).isin([int(b) for b in old]))
            both = self._bucketed(self._rows(before, old), T.StructType.fromJson(before["schema"])).withColumn(_NEW, F.lit(0)).unionByName(new.withColumn(_NEW, F.when(F.col(_SPARE), -1).otherwise(1)).drop(_SPARE), allowMissingColumns=True)
            files |= self._write(self._merged(both.select(*schema.fieldNames(), _BUCKET, _NEW), len(old)).drop(_NEW))
        state = {"schema": schema.jsonValue(), "files": files, "batches": done | ({batch[0]: batch[1]} if batch else {})}
        return self._publish(state, before)

    def _schema(self, before: dict | None, source: DataFrame) -> T.StructType:
        found = {f.name: f for f in source.schema}
        out = []
        for f in T.StructType.fromJson(before["schema"]) if before else []:
            out.append(T.StructField(f.name, wider(f.dataType, found[f.name].dataType) if f.name in found else f.dataType))
            if f.name in self.keys and out[-1].dataType != f.dataType:
                raise TypeError(f"key {f.name} can't become {out[-1].dataType.simpleString()}: its buckets would change")
        names = {f.name.lower() for f in out}
        return T.StructType([*out, *[T.StructField(f.name, f.dataType) for f in source.schema if f.name.lower() not in names]])

    def _bucketed(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name in rows.columns])
        return typed.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _stage(self, rows: DataFrame, guards: Guards | None, spare: DataFrame | None = None) -> tuple[str, list[str]]:
        """Rows in folders by bucket, with the guards counted on the way; the folder, and the buckets that have rows. Spare
        rows give way to others of their key; they stay marked in these files, which no reader's schema asks for."""
        seen, folder = Observation(), f"{self.path}/data/{uuid.uuid4().hex}"
        rows = rows.withColumn(_SPARE, F.lit(False))
        rows = rows.unionByName(spare.withColumn(_SPARE, F.lit(True))) if spare is not None else rows
        turn = F.row_number().over(Window.partitionBy(_BUCKET, *self.keys).orderBy(_SPARE))
        null = F.greatest(*[F.col(k).isNull().cast("int") for k in self.keys], F.lit(0))
        key = F.to_json(F.struct(*self.keys))
        dealt = rows.repartition(self.buckets, _BUCKET).withColumn(_TURN, turn).where(~F.col(_SPARE) | (F.col(_TURN) == 1))
        counts = [F.count_if(F.col(_TURN) == 2).alias("repeated"), F.max(F.when(F.col(_TURN) > 1, key)).alias("key"), F.sum(null).alias("null"), F.collect_set(_BUCKET).alias("touched")]
        dealt.observe(seen, *counts).drop(_TURN).write.partitionBy(_BUCKET).parquet(folder)
        got = seen.get
        wrong = [f"repeated keys, {got['repeated']}, {got['key']} for one"] if got["repeated"] else []
        wrong += [f"null keys, {got['null']}"] if guards and guards.no_null_keys and got["null"] else []
        if wrong:
            fs, p = _fs(self.spark, folder)
            fs.delete(p, True)
            raise ValueError(f"{self.path}: " + "; ".join(wrong))
        return folder, sorted(map(str, got["touched"] or []), key=int)

    def _merged(self, rows: DataFrame, tasks: int) -> DataFrame:
        """One row a key, the new one where there is one: one exchange by bucket, which also is how rows are written."""
        first = F.row_number().over(Window.partitionBy(_BUCKET, *self.keys).orderBy(F.col(_NEW).desc()))
        return rows.repartition(tasks, _BUCKET).withColumn(_TURN, first).where(f"{_TURN} = 1").drop(_TURN)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        seen, folder = Observation(), f"data/{uuid.uuid4().hex}"
        rows.observe(seen, F.collect_set(_BUCKET).alias("b")).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        return {str(b): f"{folder}/{_BUCKET}={b}" for b in seen.get["b"] or []}
