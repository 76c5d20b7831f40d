"""Sharding by histogram sort: rows ordered by a key go to shards of nearly equal bytes.

Every pass counts the exact rows and bytes between candidate boundaries of the key, on all partitions. Intervals that
a shard boundary crosses, or that hold too many rows for one task, get new probes inside them; the others are final.
When every boundary is within the tolerance, the rows are exchanged once, by interval. DataFrame operations only.

No interval, and so no task, keeps more than ``most_rows`` rows. The driver holds the intervals, a few for each ``most_rows``
rows and ``probes`` for each boundary. A key that holds a third of all rows is split by the later key parts and at last by
a row number, so no task gets it whole; a group of equal keys lies in one shard unless it outweighs the tolerance.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.work import Scratch
from .names import free_prefix

_LEAST = -(1 << 63)


def _parts(keys: list[Column]) -> list[Column]:
    """Each long as two ordered parts of 32 bits, so that differences and widths stay exact."""
    out = []
    for k in keys:
        out += [F.shiftright(k, 32).cast("long"), k.bitwiseAND(F.lit(0xFFFFFFFF)).cast("long")]
    return out


def histogram_shards(df: DataFrame, key: list[str], size: str, shards: int = 8, tolerance: float = 0.001, probes: int = 1024, most_rows: int = 4_000_000) -> DataFrame:
    """``df`` with ``shard`` int (0 to shards - 1) and ``slot`` long (gapless from 0 in each shard, in key order).

    key: long columns (null sorts first). size: a column of sizes, null counts as 0. Shards differ from the mean by
    ``tolerance`` of it, or by one row where a row is larger. Rows with equal keys lie together, and are split between
    shards only where they outweigh the tolerance. Repeated rows are kept, each with its own slot. No rows: no rows.
    """
    p = free_prefix(df)
    part, node, weight, of_at, first = (f"{p}{x}" for x in ("part", "node", "weight", "of", "first"))
    step_at, lo_at, width_at, base_at = (f"{p}{x}" for x in ("at", "lo", "width", "base"))
    spark, scratch = df.sparkSession, Scratch(df.sparkSession)
    keys = [F.coalesce(F.col(k).cast("long"), F.lit(_LEAST)) for k in key] + [F.monotonically_increasing_id()]
    rows = scratch.keep(df.select("*", F.array(*_parts(keys)).alias(part), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias(weight)))
    n_parts = 2 * len(keys)

    def counted(at: DataFrame) -> list:
        ends = [f(F.col(part)[i]).alias(f"{name}{i}") for i in range(n_parts) for f, name in ((F.min, "lo"), (F.max, "hi"))]
        return at.groupBy(node).agg(F.count("*").alias("n"), F.sum(weight).alias("b"), *ends).orderBy(node).collect()

    step = F.floor((F.element_at(part, F.col(step_at)) - F.col(lo_at)) / F.col(width_at)).cast("long")

    def refined(at: DataFrame, probe: DataFrame) -> DataFrame:
        return at.join(F.broadcast(probe), F.col(node) == F.col(of_at)).withColumn(node, F.col(base_at) + step).drop(of_at, step_at, lo_at, width_at, base_at)

    root = rows.withColumn(node, F.lit(0).cast("long"))
    leaves = counted(root)
    if not leaves:
        return rows.select(*df.columns, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    total, n_rows, goal = leaves[0]["b"], leaves[0]["n"], max(1.0, leaves[0]["b"] / shards)
    most, near, next_id, final, open_rows, levels = max(min(2 * n_rows // probes, most_rows), 64), tolerance * goal, 1, [], root, []
    while True:
        seen, probe, order = 0, [], []
        for x in leaves:
            crossed = int(seen // goal) != int(min(seen + x["b"], total - 1) // goal) and x["b"] > near
            at = next((i for i in range(n_parts) if x[f"lo{i}"] != x[f"hi{i}"]), None)
            if x["n"] > 1 and at is not None and (x["n"] > most or crossed):
                n_probes = probes if crossed or len(leaves) == 1 else min(probes, 2 + 4 * x["n"] // most)
                lo, width = x[f"lo{at}"], (x[f"hi{at}"] - x[f"lo{at}"]) // n_probes + 1
                probe.append((x[node], at + 1, lo, width, next_id))
                next_id += n_probes
                order.append((x[node], None))
            else:
                order.append((x[node], x))
            seen += x["b"]
        final = order
        if not probe:
            break
        frame = spark.createDataFrame(probe, f"{of_at} long, {step_at} int, {lo_at} long, {width_at} long, {base_at} long")
        levels.append(frame)
        open_rows = refined(open_rows, frame)
        children: dict[int, list] = {}
        bases = [(p[4], p[0]) for p in probe]
        for x in counted(open_rows):
            children.setdefault(bases[bisect.bisect_right(bases, (x[node], 1 << 62)) - 1][1], []).append(x)
        leaves = [y for of, x in order for y in ([x] if x is not None else children[of])]
    table, seen, slots = [], 0, [0] * shards
    for of, x in final:
        shard = min(shards - 1, int((seen + x["b"] / 2) // goal))
        table.append((of, shard, slots[shard]))
        slots[shard] += x["n"]
        seen += x["b"]
    placed = root
    for frame in levels:  # a row goes down until its interval is final
        placed = placed.join(F.broadcast(frame), F.col(node) == F.col(of_at), "left").withColumn(node, F.coalesce(F.col(base_at) + step, F.col(node))).drop(of_at, step_at, lo_at, width_at, base_at)
    placed = placed.join(F.broadcast(spark.createDataFrame(table, f"{node} long, shard int, {first} long")), node)
    rank = F.row_number().over(Window.partitionBy(node).orderBy(*[F.col(part)[i] for i in range(n_parts)]))
    return placed.select(*df.columns, "shard", (F.col(first) + rank - 1).cast("long").alias("slot"))


def text_shards(documents: DataFrame, shards: int = 8) -> DataFrame:
    """Documents in shards of near-equal bytes, ordered by a hash of the text and then doc_id: equal texts lie together.

    Size: UTF-8 bytes and 1 (null text: 1, checksum of the empty text). A null doc_id sorts first and stays null.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"), F.xxhash64("text").alias("text_hash"))
    out = histogram_shards(rows, ["text_hash", "doc_id"], "size", shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
