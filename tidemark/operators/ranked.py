"""Lookups by several candidate keys in order of rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.work import Scratch


def resolve_ranked(fact: DataFrame, candidates: list[Column], dim: DataFrame, natural: str, columns: dict[str, str], rank: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """``fact`` with columns of the dimension row that the first of its candidate keys finds; null where none does.

    candidates: expressions over the fact, best first; null ones are skipped, and so are ones that the dimension lacks: the
    next one counts, unlike a COALESCE in the join, which stops at the first key that isn't null. columns: new name to the
    dimension's column; rank: a name for the found candidate's place, from 1. Of several dimension rows with one key, the
    smallest row counts, so a fact row never multiplies. Candidates are compared as text.

    Distinct candidate lists, not fact rows, are exploded: one row a rank, one equi join with the dimension, the best rank by
    ``min_by``. What is resolved is written, so the fact itself is exchanged once at most, in a join whose hot partitions
    Spark can split, and not at all where the resolved lists are small enough for Spark to broadcast.
    """
    names = [*columns, *([rank] if rank else [])]
    if clash := {n.lower() for n in names} & {c.lower() for c in fact.columns}:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    scratch = scratch or Scratch(fact.sparkSession)
    # null candidates leave the list's place empty; a list without any key is null and meets nothing
    keys = F.array(*[c.cast("string") for c in candidates])
    listed = fact.withColumn("_keys", F.when(F.exists(keys, lambda k: k.isNotNull()), keys))
    each = listed.where("_keys is not null").select("_keys").distinct().select("_keys", F.posexplode("_keys").alias("_rank", "_key")).where("_key is not null")
    known = dim.select(F.col(natural).cast("string").alias("_key"), F.struct(*[F.col(c).alias(n) for n, c in columns.items()]).alias("_row")).where("_key is not null")
    known = known.groupBy("_key").agg(F.min("_row").alias("_row"))
    best = each.join(known, "_key").groupBy("_keys").agg(F.min_by("_row", "_rank").alias("_row"), (F.min("_rank") + 1).alias("_rank"))
    found = listed.join(scratch.keep(best), "_keys", "left")
    return found.select(*[F.col(f"`{c}`") for c in fact.columns], *[F.col(f"_row.`{n}`").alias(n) for n in columns], *([F.col("_rank").alias(rank)] if rank else []))
