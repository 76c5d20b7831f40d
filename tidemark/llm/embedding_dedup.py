"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points (pivots), nearest first. Pivots come from a bounded sample, each
next one the sample row least similar to those chosen, so that a crowd of near copies gets one pivot and not many.
Inverted lists hold, for each label and pair of pivots, the vectors that have both among their nearest: vectors in a list
share at least two pivots. Pivots grow with the largest label, so lists stay short. A list is compared in numpy blocks of a
bounded size, by exact cosines in double precision; a pair that shares more pivots counts in one list only, that of its two
smallest shared pivots. Many short lists go to one task together. A block emits link counts and the links of a spanning
forest, never all pairs, and equal vectors are one row with a weight, so crowds stay small.

``exact`` loses nothing: blocks of a label hold vectors around one pivot, and two blocks are compared unless their pivots'
angle less both radii exceeds the angle of the threshold, where by the triangle inequality no pair can reach it.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from ..sources.work import Scratch


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Farthest-first rows of a sample of unit vectors."""
    chosen = [0]
    near = sample @ sample[0]
    while len(chosen) < min(pivots, len(sample)):
        at = int(near.argmin())
        if near[at] > 0.999:
            break
        chosen.append(at)
        near = np.maximum(near, sample @ sample[at])
    return sample[chosen]


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pivots_for(rows: int) -> tuple[int, int]:
    """How many pivots a label of so many vectors gets, and how many of them describe a vector: more pivots shorten the lists,
    more nearest ones keep near pairs together (of pairs with cosine 0.931 to 0.96 in 64 dimensions, 0.999 and more)."""
    for pivots, nearest, most in ((64, 6, 16_000), (128, 7, 64_000), (256, 8, 256_000), (512, 8, 1_000_000)):
        if rows <= most:
            return pivots, nearest
    return 1024, 9


def _cells(pdf: pd.DataFrame) -> Iterator[np.ndarray]:
    """Positions of each list's rows in a frame sorted by list."""
    keys = pdf[["label", "dim", "cell", "i", "j"]]
    starts = np.flatnonzero(np.r_[True, (keys.to_numpy()[1:] != keys.to_numpy()[:-1]).any(axis=1)]) if len(pdf) else []
    for at, end in itertools.pairwise([*starts, len(pdf)]):
        yield np.arange(at, end)


def _forest(ids: np.ndarray, left: np.ndarray, right: np.ndarray, near: np.ndarray) -> tuple[list, list]:
    """Links of a spanning forest of a block's links, as two lists of ids."""
    full, reached, a, b = np.zeros((len(ids), len(ids)), bool), np.zeros(len(ids), bool), [], []
    full[np.ix_(left, right)] = near
    full |= full.T
    for start in range(len(ids)):
        if not reached[start]:
            reached[start], stack = True, [start]
            while stack:
                at = stack.pop()
                new = np.flatnonzero(full[at] & ~reached)
                reached[new] = True
                a += [ids[at]] * len(new)
                b += ids[new].tolist()
                stack += new.tolist()
    return a, b


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, pivots: int | None = None, nearest: int | None = None, sample_rows: int = 4000, block: int = 1024, exact: bool = False, task_values: int = 2_000_000) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row; see the module.

    Only rows with equal labels are compared. Null labels and vectors that are null, empty, zero or hold null or non-finite
    components link with nothing. Vectors of different lengths are never compared. Repeated rows link with each other.
    A null vec_id stays null and is kept only if it links with nothing that has an id. No rows: no rows.
    pivots, nearest: see ``pivots_for``. exact: all pairs that reach the threshold, for more work. task_values: vector
    entries that a task compares at once, about.
    """
    spark, scratch = embeddings.sparkSession, Scratch(embeddings.sparkSession)
    v = F.col("embedding").cast("array<double>")
    fine = F.col("label").isNotNull() & F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0), F.lit(False))
    entry = "float" if embeddings.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast(f"array<{entry}>").alias("v"), fine.alias("fine"))
    rows = rows.withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.xxhash64("v", F.lit(17), "label"))
    classes = rows.where("fine").groupBy("h1", "h2").agg(F.min("vec_id").alias("lo"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = scratch.keep(classes.withColumn("id", F.monotonically_increasing_id()))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    pivots, nearest = pivots or pivots_for(largest)[0], nearest or pivots_for(largest)[1]
    sample = classes.orderBy(F.xxhash64("h1", "h2")).limit(sample_rows).select("v").toPandas()["v"]
    by_length: dict[int, list] = {}
    for x in sample:
        by_length.setdefault(len(x), []).append(x)
    index = {n: choose_pivots(_unit(x), pivots) for n, x in by_length.items()}

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, part in batch.groupby(batch["v"].map(len)):
                piv = index.get(n, np.zeros((0, n)))
                if len(piv) < 2:
                    tops, keys, angle = [[] for _ in range(len(part))], [[-1]] * len(part), np.pi
                else:
                    cosines = _unit(part["v"].tolist()) @ piv.T
                    tops = np.argsort(-cosines, axis=1, kind="stable")[:, :nearest]
                    keys = [[a * len(piv) + b for a, b in itertools.combinations(sorted(t), 2)] for t in tops.tolist()]
                    angle = np.arccos(np.clip(cosines.max(axis=1), -1, 1))
                yield part[["id", "label", "v", "copies"]].assign(dim=n, tops=list(tops), cells=keys, angle=angle)

    listed = scratch.keep(classes.mapInPandas(described, f"id long, label string, v array<{entry}>, copies long, dim int, tops array<int>, cells array<long>, angle double"))
    dealt = _near_blocks(listed, index, float(np.arccos(threshold)), block) if exact else _pivot_lists(listed, block)
    dealt = scratch.keep(dealt.select("label", "dim", "cell", "id", "copies", "tops", "mine", "i", "j"))
    tasks = max(1, -(-int(dealt.agg(F.sum(F.col("dim").cast("long"))).first()[0] or 0) // task_values))
    n_pivots = {n: len(p) for n, p in index.items()}

    def compared(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["label", "dim", "cell", "i", "j", "id"], ignore_index=True)
        out, pairs = [], ([], [])
        vectors, tops = pdf["v"].to_numpy(), pdf["tops"].to_numpy()
        every, mine, copies = pdf["id"].to_numpy(), pdf["mine"].to_numpy(), pdf["copies"].to_numpy()
        for at in _cells(pdf):
            first = pdf.iloc[at[0]]
            i, j, cell, m = first["i"], first["j"], int(first["cell"]), n_pivots.get(int(first["dim"]), 0)
            left, right = np.flatnonzero(mine[at] == i), np.flatnonzero(mine[at] == j)
            if not len(left) or not len(right):
                continue
            x = _unit(vectors[at].tolist())
            near = x[left] @ x[right].T >= threshold
            if i == j:
                np.fill_diagonal(near, False)
            if not near.any():
                continue
            counted = near
            if cell >= 0:
                has = np.zeros((len(at), m), np.float32)
                for r, t in enumerate(tops[at]):
                    has[r, t] = 1
                upto = has[:, : cell % m + 1]
                counted = near & (upto[left] @ upto[right].T < 2.5)  # the list's two pivots are the smallest shared ones
            ids, links = every[at], np.zeros(len(at), np.int64)
            np.add.at(links, left, counted @ copies[at][right])
            if i != j:
                np.add.at(links, right, counted.T @ copies[at][left])
            out.append(pd.DataFrame({"a": ids, "b": ids, "links": links})[links > 0])
            for all_ends, ends in zip(pairs, _forest(ids, left, right, near), strict=True):
                all_ends += ends
        out.append(pd.DataFrame({"a": np.array(pairs[0], np.int64), "b": np.array(pairs[1], np.int64), "links": 0}))
        return pd.concat(out).astype("int64")

    task = F.pmod(F.xxhash64("label", "dim", "cell", "i", "j"), F.lit(tasks))
    with_vectors = dealt.join(listed.select("id", "v"), "id").withColumn("task", task)
    found = scratch.keep(with_vectors.groupBy("task").applyInPandas(compared, "a long, b long, links long"))
    n_links = found.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    comp = components(found.where("a <> b").select("a", "b"), scratch).withColumnRenamed("node", "id")
    named = classes.select("h1", "h2", "id", "lo", "copies").join(n_links, "id", "left").join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = named.groupBy("comp").agg(F.min("lo").alias("component_id"))
    final = scratch.keep(named.join(least, "comp").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    out = rows.select("vec_id", "fine", "h1", "h2").join(final.withColumn("fine", F.lit(True)), ["fine", "h1", "h2"], "left")
    component = F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))


def _pivot_lists(listed: DataFrame, block: int) -> DataFrame:
    """Rows by list, a list of more than ``block`` rows dealt to pairs of blocks."""
    lists = listed.withColumn("cell", F.explode("cells")).drop("cells", "v")
    counts = lists.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / block).alias("blocks"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    dealt = lists.join(counts, ["label", "dim", "cell"]).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})


def _near_blocks(listed: DataFrame, index: dict[int, np.ndarray], most: float, block: int) -> DataFrame:
    """Rows by pairs of blocks that may hold vectors within the angle ``most``. A block: at most about ``block`` vectors of one
    label with the same nearest pivot, and the largest angle to it."""
    top = F.coalesce(F.try_element_at("tops", F.lit(1)), F.lit(-1))
    rows = listed.drop("cells", "v").withColumn("top", top)
    counts = rows.groupBy("label", "dim", "top").agg(F.ceil(F.count("*") / block).alias("blocks"))
    rows = rows.join(counts, ["label", "dim", "top"]).withColumn("mine", F.col("top") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), F.col("blocks")))
    balls = rows.groupBy("label", "dim", "top", "mine").agg(F.max("angle").alias("radius"))
    apart = [(n, a, b, float(x)) for n, p in index.items() for (a, b), x in np.ndenumerate(np.arccos(np.clip(p @ p.T, -1, 1)))] if index else []
    angles = listed.sparkSession.createDataFrame(apart, "dim int, top int, top2 int, apart double")
    other = balls.select("label", "dim", F.col("top").alias("top2"), F.col("mine").alias("other"), F.col("radius").alias("radius2"))
    pairs = balls.join(other, ["label", "dim"]).where("mine <= other").join(F.broadcast(angles), ["dim", "top", "top2"], "left")
    pairs = pairs.where(F.coalesce("apart", F.lit(0.0)) - F.col("radius") - F.col("radius2") <= most + 1e-7)
    ends = pairs.select("label", "dim", F.explode(F.array_distinct(F.array("mine", "other"))).alias("mine"), F.col("mine").alias("i"), F.col("other").alias("j"))
    return rows.join(ends, ["label", "dim", "mine"]).withColumn("cell", F.lit(-1).cast("long"))
