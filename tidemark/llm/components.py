"""Connected components of verified links, as DataFrame rounds with written tables between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.work import Scratch


def components(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """node, comp (smallest node reachable) of every node with a link. edges: a, b long, in either direction.

    Each round first links every node's larger neighbours to its smallest one, then all its neighbours to the smallest one
    below it (large-star and small-star); both keep connectivity and at most keep the number of links. The number of
    rounds grows with the logarithm of the longest path. Minima are pre-aggregated, so a node with very many links
    costs no task more than its share; the joins back may be split by adaptive execution.
    """
    low = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    for _ in range(most_rounds):
        both = low.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(low.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = scratch.keep(both.join(least, "u").where("v > u and m <> v").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct())
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        pulled = large.join(small, "hi").select("m", F.explode(F.array("lo", "hi")).alias("y"))
        new = scratch.keep(pulled.where("m <> y").select(F.col("m").alias("lo"), F.col("y").alias("hi")).distinct())
        # a star forest: every larger node has one link, and isn't a smallest one
        ends = new.select(F.col("hi").alias("u"), F.lit(1).alias("up")).unionAll(new.select(F.col("lo").alias("u"), F.lit(0).alias("up")))
        settled = ends.groupBy("u").agg(F.sum("up").alias("ups"), F.min("up").alias("lo")).where("ups > 1 or (ups = 1 and lo = 0)").isEmpty()
        low = new
        if settled:
            break
    else:
        raise ValueError(f"components have not settled after {most_rounds} rounds")
    return low.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).unionAll(low.select(F.col("lo").alias("node"), F.col("lo").alias("comp")).distinct())
