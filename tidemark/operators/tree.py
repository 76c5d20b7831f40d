"""Parent-child hierarchies: closure by pointer doubling, levels, sort paths, rollups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.keys import add_parent_key
from tidemark.operators.clean import assert_unique
from tidemark.sources.work import Scratch


def closure(df: DataFrame, node: str, parent: str, max_depth: int = 32) -> DataFrame:
    """node, ancestor, distance, each node its own ancestor at 0. Pass i joins pairs at distance 2^i, so depth d takes
    about log2(d) passes. Parents that are not nodes count as none; deeper than max_depth, or a cycle, is an error."""
    assert_unique(df, [node], "hierarchy")
    scratch = Scratch(df.sparkSession)
    rows = df.select(F.col(node).alias("node"), F.col(parent).alias("up"))
    pairs = scratch.keep(rows.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")))
    jump = scratch.keep(rows.join(rows.select(F.col("node").alias("up")), "up").select("node", "up"))
    step = 1
    while not jump.isEmpty():
        if step > max_depth:
            raise ValueError(f"the hierarchy is deeper than {max_depth}, or has a cycle")
        far = jump.join(pairs.select(F.col("node").alias("up"), "ancestor", "distance"), "up").select("node", "ancestor", (F.col("distance") + step).alias("distance"))
        pairs = scratch.keep(pairs.unionAll(far))
        jump = scratch.keep(jump.join(jump.select(F.col("node").alias("up"), F.col("up").alias("next")), "up").select("node", F.col("next").alias("up")))
        step *= 2
    if not pairs.where(F.col("distance") > max_depth).isEmpty():
        raise ValueError(f"the hierarchy is deeper than {max_depth}, or has a cycle")
    return pairs


def ascend(df: DataFrame, node: str, parent: str, own: Column, meet: Callable[[Column, Column], Column], max_depth: int | None = None) -> DataFrame:
    """``_node``, ``_state`` and ``_depth`` (roots 0) of the nodes that have children: ``own`` of the node and all its ancestors,
    by ``meet(upper, lower)``, which must be associative.

    Doubling without a closure: each pass joins a node's state with that of the node its pointer has come to, so rows stay one
    a node that has children, over log2(depth) passes, and leaves take part in none. Parents that are not nodes count as none;
    a node deeper than max_depth is an error, and so is a cycle. max_depth None: any depth.
    """
    assert_unique(df, [node], "hierarchy")
    scratch = Scratch(df.sparkSession)
    wrong = ValueError("the hierarchy has a cycle" if max_depth is None else f"the hierarchy is deeper than {max_depth}, or has a cycle")
    rows = df.select(F.col(node).alias("_node"), F.col(parent).alias("_up"), own.alias("_state"))
    ups = rows.where("_up is not null").select(F.col("_up").alias("_node")).distinct()
    inner = scratch.keep(rows.join(ups, "_node", "left_semi"))
    there = inner.select(F.col("_node").alias("_up"), F.lit(True).alias("_there"))
    least = F.lit(None).cast(inner.schema["_node"].dataType)
    at = scratch.keep(inner.join(there, "_up", "left").select("_node", F.when(F.col("_there"), F.col("_up")).alias("_up"), "_state", F.lit(0).alias("_depth"), least.alias("_least")))
    step = 1
    while not (todo := at.where("_up is not null")).isEmpty():
        if max_depth is not None and step > max_depth:
            raise wrong
        over = at.join(todo.select(F.col("_up").alias("_node")).distinct(), "_node", "left_semi")
        over = over.select(F.col("_node").alias("_up"), F.col("_up").alias("_next"), F.col("_state").alias("_over"), (F.col("_depth") + 1).alias("_above"), F.least("_node", "_least").alias("_low"))
        moves = F.col("_above").isNotNull()
        met = F.when(moves, meet(F.col("_over"), F.col("_state"))).otherwise(F.col("_state"))
        at = scratch.keep(at.join(over, "_up", "left").select("_node", F.col("_next").alias("_up"), met.alias("_state"), (F.col("_depth") + F.coalesce("_above", F.lit(0))).alias("_depth"), F.least("_least", "_low").alias("_least")))
        if not at.where("_least = _node").isEmpty():  # the smallest node of a cycle is the smallest of its own ancestors
            raise wrong
        step *= 2
    if max_depth is not None and not at.where(F.col("_depth") + 1 > max_depth).isEmpty():
        raise wrong
    return at.select("_node", "_state", "_depth")


def _with_state(df: DataFrame, node: str, parent: str, above: DataFrame) -> DataFrame:
    """df with ``_state`` and ``_depth`` of each row's parent; rows without a node have none."""
    return df.join(above, (F.col(parent) == F.col("_node")) & F.col(node).isNotNull(), "left").drop("_node")


def dense_levels(df: DataFrame, node: str, parent: str, code: str, max_depth: int = 10, any_depth: bool = False, filled: str | None = None) -> DataFrame:
    """df with level_1 (root) to level_max_depth (null below the node itself). Deeper nodes are an error, or with any_depth
    show their first max_depth levels. filled: a column for how many codes, of all levels, are neither null nor empty."""
    has = F.when(F.coalesce(F.col(code).cast("string"), F.lit("")) != "", 1).otherwise(0)
    own = F.struct(F.array(code).alias("a"), has.alias("n"))
    meet = lambda over, low: F.struct(F.slice(F.concat(over["a"], low["a"]), 1, max_depth).alias("a"), (over["n"] + low["n"]).alias("n"))
    out = _with_state(df, node, parent, ascend(df, node, parent, own, meet, None if any_depth else max_depth - 1))
    whole = F.when(F.col(node).isNotNull(), F.when(F.col("_state").isNull(), own).otherwise(meet(F.col("_state"), own)))
    out = out.withColumn("_a", whole)
    levels = [F.try_element_at("_a.a", F.lit(i)).alias(f"level_{i}") for i in range(1, max_depth + 1)]
    return out.select(*df.columns, *levels, *([F.coalesce("_a.n", F.lit(0)).alias(filled)] if filled else []))


def typed_levels(df: DataFrame, node: str, parent: str, code: str, rank: str, levels: dict[int, int], max_depth: int | None = 15) -> DataFrame:
    """Each ancestor in the level of its type; of several with a type the nearest; ancestors at or below the node's own
    level don't count. Ranks without a level, gaps and repeats in the levels are errors."""
    if sorted(levels.values()) != list(range(1, len(levels) + 1)):
        raise ValueError("levels must be 1 to their number, each once")
    strange = df.where(F.col(rank).isNotNull() & ~F.col(rank).isin(*levels)).select(rank).distinct().limit(10).collect()
    if strange:
        raise ValueError(f"ranks without a level: {[r[0] for r in strange]}")
    level = F.coalesce(*[F.when(F.col(rank) == r, F.lit(at)) for r, at in levels.items()])
    names = [f"level_{i}" for i in range(1, len(levels) + 1)]
    own = F.struct(*[F.when(level == i, F.struct(F.col(code).alias("c"))).alias(n) for i, n in enumerate(names, 1)])
    nearest = lambda over, low: F.struct(*[F.coalesce(low[n], over[n]).alias(n) for n in names])
    out = _with_state(df, node, parent, ascend(df, node, parent, own, nearest, max_depth))
    placed = [F.when(level == i, F.col(code)).when(level > i, F.col(f"_state.{n}.c")).alias(n) for i, n in enumerate(names, 1)]
    return out.select(*df.columns, *[F.when(F.col(node).isNotNull(), c).alias(n) for c, n in zip(placed, names, strict=True)])


def sort_paths(df: DataFrame, node: str, parent: str, rank: str, max_depth: int | None = 10, root_prefix: str | None = None) -> DataFrame:
    """df with ``sort_path`` (ranks from the root joined by ``!``) and ``depth`` (root 0). A null rank is the id; siblings
    with equal ranks get their id appended, so a path is one node's. A root prefix column leads; null: ``~``. max_depth None:
    any depth."""
    same = Window.partitionBy(parent, rank)
    own = F.when(F.col(rank).isNull(), F.col(node).cast("string")).when(F.count("*").over(same) > 1, F.concat(F.col(rank).cast("string"), F.lit("."), F.col(node).cast("string"))).otherwise(F.col(rank).cast("string"))
    rows = df.withColumn("_r", own)
    prefix = F.concat(F.coalesce(F.col(root_prefix).cast("string"), F.lit("~")), F.lit("!")) if root_prefix else F.lit("")
    own = F.struct(prefix.alias("p"), F.col("_r").alias("r"))
    meet = lambda over, low: F.struct(over["p"].alias("p"), F.concat(over["r"], F.lit("!"), low["r"]).alias("r"))
    out = _with_state(rows, node, parent, ascend(rows, node, parent, own, meet, None if max_depth is None else max_depth - 1))
    whole = F.when(F.col("_state").isNull(), own).otherwise(meet(F.col("_state"), own))
    out = out.withColumn("_path", F.when(F.col(node).isNotNull(), whole))
    depth = F.when(F.col(node).isNotNull(), F.coalesce(F.col("_depth") + 1, F.lit(0)))
    return out.select(*df.columns, F.concat("_path.p", "_path.r").alias("sort_path"), depth.alias("depth"))


def rollup_dates(df: DataFrame, node: str, parent: str, start: str, end: str, max_depth: int = 32) -> DataFrame:
    """df with rolled_start, rolled_end (own value, else least and greatest of all descendants) and has_own_dates."""
    dated = df.where(F.col(start).isNotNull() | F.col(end).isNotNull()).select(F.col(node).alias("_n"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    below = closure(df, node, parent, max_depth).join(dated, F.col("node") == F.col("_n")).groupBy(F.col("ancestor").alias("_node")).agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))
    return _rolled(df.join(below, F.col(node) == F.col("_node"), "left").drop("_node"), start, end)


def rollup_dates_by_path(df: DataFrame, path: str, start: str, end: str) -> DataFrame:
    """The same from sort paths alone: dated rows list the prefixes of their path, then one equi join."""
    dated = df.where(F.col(path).isNotNull() & (F.col(start).isNotNull() | F.col(end).isNotNull()))
    parts = F.split(path, "!")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "!"))
    below = dated.select(F.explode(prefixes).alias("_path"), F.col(start).alias("_s"), F.col(end).alias("_e")).groupBy("_path").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))
    return _rolled(df.join(below, F.col(path) == F.col("_path"), "left").drop("_path"), start, end)


def _rolled(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumns({"rolled_start": F.coalesce(start, "_s"), "rolled_end": F.coalesce(end, "_e"), "has_own_dates": F.col(start).isNotNull() | F.col(end).isNotNull()}).drop("_s", "_e")


def enrich(df: DataFrame, node: str, parent: str, code: str, rank: str, type_rank: str, levels: dict[int, int], tiers: dict[int, str], max_depth: int = 10, root_prefix: str | None = None, any_depth: bool = False) -> DataFrame:
    """Parent key, typed levels under their tier names, dense levels, populated depth and sort path; rank dropped. Nodes deeper
    than max_depth (typed levels: 15) are an error, or with any_depth show the first max_depth of their dense levels."""
    typed = typed_levels(add_parent_key(df, parent), node, parent, code, type_rank, levels, None if any_depth else 15)
    typed = typed.withColumnsRenamed({f"level_{i}": name for i, name in tiers.items()}).drop(*[f"level_{i}" for i in range(1, len(levels) + 1) if i not in tiers])
    dense = dense_levels(typed, node, parent, code, max_depth, any_depth, "_filled")
    paths = sort_paths(dense, node, parent, rank, None if any_depth else max_depth, root_prefix)
    return paths.withColumn("depth", F.col("_filled")).drop("_filled", rank)


def populated_depth(columns: list[str]) -> Column:
    return sum((F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0) for c in columns), F.lit(0))


def rebuild_tree(df: DataFrame, node: str, path: str) -> DataFrame:
    """parent_path, depth and first_child from ordered paths: the parent is the longest other path that is a prefix. Prefixes
    are listed once for all rows that share what their paths have before the last part."""
    cut = F.when(F.instr(path, "!") > 0, F.regexp_replace(path, "![^!]*$", ""))
    parts = F.split("_q", "!")
    heads = df.select(cut.alias("_q")).where("_q is not null").distinct()
    listed = heads.select("_q", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "!"))).alias("_p"))
    present = df.select(F.col(path).alias("_p")).where("_p is not null").distinct()
    found = listed.join(present, "_p").groupBy("_q").agg(F.max(F.length("_p")).alias("_long"), F.count("*").cast("int").alias("depth"))
    found = found.select(F.col("_q").alias("_head"), F.substr("_q", F.lit(1), F.col("_long")).alias("parent_path"), "depth")
    out = df.join(found, cut == F.col("_head"), "left").drop("_head").withColumn("depth", F.coalesce("depth", F.when(F.col(path).isNotNull(), 0)))
    first = F.row_number().over(Window.partitionBy("parent_path").orderBy(F.col(path).asc_nulls_last(), node))
    return out.withColumn("first_child", F.coalesce((first == 1) & F.col("parent_path").isNotNull(), F.lit(False)))


def timeline_extent(df: DataFrame, starts: list[str], ends: list[str]) -> DataFrame:
    low = F.least(*starts) if len(starts) > 1 else F.col(starts[0])
    high = F.greatest(*ends) if len(ends) > 1 else F.col(ends[0])
    return df.agg(F.min(low).alias("first_start"), F.max(high).alias("last_end"))
