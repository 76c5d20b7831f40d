"""Rollups and depths of hierarchies of any depth, by tree contraction.

First blocks of neighbouring keys are contracted in their tasks: of a block only nodes with parents or children outside stay,
and where the ways to those part. Where parents' keys lie near their children's, little is left; else nothing is lost but a
pass. Then go rounds over what stays. Each round rakes leaves, whose values join their parents', and splices out nodes with one child out of chains, which passes
their values on to the edge between child and parent. Coins decide which, so no two neighbours go at once; a constant share
of the nodes goes each round, and a chain is as fast as a bush. Then the rounds are walked back: what a spliced node has
below it is known from its child, depths and roots from the parents. Rows written over all rounds are linear in the nodes:
rounds shrink geometrically, and each round back reads only what went later.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clean import assert_unique
from tidemark.sources.work import Scratch

_JOIN = {"min": lambda a, b: F.least(a, b), "max": lambda a, b: F.greatest(a, b), "sum": lambda a, b: F.coalesce(a + b, a, b)}
_OVER = {"min": F.min, "max": F.max, "sum": F.sum}
_PLAIN = {"min": min, "max": max, "sum": lambda a, b: a + b}


#: Types that Python orders and adds as Spark does.
_EXACT = ("tinyint", "smallint", "int", "bigint", "date", "string")


def _contract_block(rows: dict[str, list], kinds: list[str]) -> dict[str, list]:
    """A block's rows, ``_stays`` or gone. Those that stay point at the nearest above that stays; their edge has what went
    between. Gone ones know the nearest above (up, len) and below (child) that stay, and what else is below them."""
    node, up, length = rows["node"], rows["up"], rows["len"]
    n, at = len(node), {v: i for i, v in enumerate(node)}
    parent = [-1 if u is None else at.get(u, -1) for u in up]
    below: list[list[int]] = [[] for _ in range(n)]
    for i, j in enumerate(parent):
        if j >= 0:
            below[j].append(i)
    order = [i for i in range(n) if parent[i] < 0]
    for i in order:  # grows while it is read; what no top reaches hangs on a cycle and stays as it is
        order += below[i]
    stays, lives, next_below = [True] * n, [True] * n, [-1] * n
    for i in reversed(order):
        ways = [c for c in below[i] if lives[c]]
        stays[i] = parent[i] < 0 or len(ways) > 1 or rows["_kids"][i] > len(below[i])
        lives[i] = stays[i] or bool(ways)
        if not stays[i] and ways:
            next_below[i] = ways[0] if stays[ways[0]] else next_below[ways[0]]
    above, away = list(parent), list(length)
    for i in order:
        j = parent[i]
        if j >= 0 and not stays[j]:
            above[i], away[i] = above[j], length[i] + away[j]
    out = {"_stays": stays, "node": node, "up": [u if above[i] < 0 or stays[i] and above[i] == parent[i] else node[above[i]] for i, u in enumerate(up)], "len": away, "child": [None if c < 0 else node[c] for c in next_below]}
    for k, kind in enumerate(kinds):
        plain = _PLAIN[kind]
        both = lambda a, b, plain=plain: b if a is None else a if b is None else plain(a, b)
        own, edge = list(rows[f"a{k}"]), rows[f"w{k}"]
        for i in reversed(order):  # nodes without a way down join their parents
            if not lives[i]:
                own[parent[i]] = both(own[parent[i]], both(own[i], edge[i]))
        between, total = list(edge), list(own)
        for i in order:
            j = parent[i]
            if j >= 0 and lives[i] and not stays[j]:
                between[i] = both(edge[i], both(own[j], between[j]))
        for i in reversed(order):
            if lives[i] and not stays[i]:
                c = next(c for c in below[i] if lives[c])
                total[i] = both(own[i], both(edge[c], None if stays[c] else total[c]))
        out[f"a{k}"], out[f"w{k}"] = total, [w if s else None for w, s in zip(between, stays, strict=True)]
    return out


class _Contraction:
    def __init__(self, df: DataFrame, node: str, parent: str, values: dict[str, tuple[str, str]], small: int, most_rounds: int, block_rows: int = 100_000) -> None:
        self.scratch, self.small, self.most, self.block_rows = Scratch(df.sparkSession), small, most_rounds, block_rows
        self.spark, self.kinds = df.sparkSession, [k for _, k in values.values()]
        rows = df.select(F.col(node).alias("node"), F.col(parent).alias("up"), *[F.col(c).alias(f"a{i}") for i, (c, _) in enumerate(values.values())])
        there = rows.select(F.col("node").alias("up"), F.lit(True).alias("_there"))
        started = rows.join(there, "up", "left").withColumn("up", F.when(F.col("_there"), F.col("up"))).drop("_there")
        self.fields = [f"a{i}" for i in range(len(self.kinds))]
        self.edge = [f"w{i}" for i in range(len(self.kinds))]
        self.alive = self.scratch.keep(started.select("node", "up", F.lit(1).cast("long").alias("len"), *self.fields, *[F.lit(None).cast(started.schema[a].dataType).alias(w) for a, w in zip(self.fields, self.edge, strict=True)]))
        self.steps: list[tuple[str, DataFrame]] = []
        self.tables = [self.alive]

    def both(self, a: Column, b: Column, i: int) -> Column:
        return _JOIN[self.kinds[i]](a, b)

    def keep(self, df: DataFrame) -> DataFrame:
        self.tables.append(self.scratch.keep(df))
        return self.tables[-1]

    def kids(self) -> DataFrame:
        return self.alive.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("kids"), F.min("node").alias("only"))

    def rake(self) -> None:
        """Nodes without children go; their values and their edges' join their parents'."""
        tagged = self.keep(self.alive.join(self.kids(), "node", "left"))
        leaves = tagged.where("kids is null")
        self.steps.append(("rake", leaves.select("node", "up", "len", *self.fields)))
        given = leaves.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("_raked"), *[_OVER[k](self.both(F.col(a), F.col(w), i)).alias(f"g{i}") for i, (k, a, w) in enumerate(zip(self.kinds, self.fields, self.edge, strict=True))])
        stay = tagged.where("kids is not null").join(given, "node", "left")
        self.alive = self.keep(stay.select("node", "up", "len", *[self.both(F.col(a), F.col(f"g{i}"), i).alias(a) for i, a in enumerate(self.fields)], *self.edge))

    def splice(self, turn: int) -> None:
        """Nodes with one child whose coin shows heads while their parent's shows tails go; the child moves up."""
        heads = lambda c: F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2)) == 1
        single = self.alive.join(self.kids(), "node").where((F.col("kids") == 1) & F.col("up").isNotNull() & (F.col("up") != F.col("node")) & heads(F.col("node")) & ~heads(F.col("up")))
        out = single.select("node", "up", "len", F.col("only").alias("child"), *self.fields, *self.edge)
        below = self.alive.select(F.col("node").alias("child"), *[F.col(w).alias(f"c{i}") for i, w in enumerate(self.edge)])
        gone = self.keep(out.join(below, "child"))
        self.steps.append(("splice", gone))
        moved = gone.select(F.col("child").alias("node"), F.col("up").alias("_up"), F.col("len").alias("_len"), *[self.both(F.col(a), F.col(w), i).alias(f"m{i}") for i, (a, w) in enumerate(zip(self.fields, self.edge, strict=True))])
        stay = self.alive.join(gone.select("node"), "node", "left_anti").join(moved, "node", "left")
        has = F.col("_len").isNotNull()
        self.alive = self.keep(stay.select("node", F.when(has, F.col("_up")).otherwise(F.col("up")).alias("up"), (F.col("len") + F.coalesce("_len", F.lit(0))).alias("len"), *self.fields, *[self.both(F.col(w), F.col(f"m{i}"), i).alias(w) for i, w in enumerate(self.edge)]))

    def blocks(self, n: int) -> None:
        """Ranges of keys, of about ``block_rows`` rows each, are contracted where they lie."""
        kinds = self.kinds

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not (got := list(batches)):
                return
            rows = pa.Table.from_batches(got)
            types = {f.name: f.type for f in rows.schema} | {"_stays": pa.bool_(), "child": rows.schema.field("node").type}
            made = _contract_block(rows.to_pydict(), kinds)
            yield from pa.table({c: pa.array(v, types[c]) for c, v in made.items()}).to_batches(10_000)

        t = self.alive.schema
        text = lambda c: f"{c} {t[c].dataType.simpleString()}"
        schema = ", ".join(["_stays boolean", text("node"), text("up"), "len long", f"child {t['node'].dataType.simpleString()}", *[text(x) for i in range(len(kinds)) for x in (f"a{i}", f"w{i}")]])
        tagged = self.alive.join(self.kids().select("node", F.col("kids").alias("_kids")), "node", "left").fillna(0, ["_kids"])
        cut = self.keep(tagged.repartitionByRange(-(-n // self.block_rows), "node").mapInArrow(run, schema))
        self.steps.append(("block", cut.where("not _stays").select("node", "up", "len", "child", *self.fields)))
        self.alive = cut.where("_stays").select("node", "up", "len", *self.fields, *self.edge)

    def members(self, seeds: DataFrame) -> list:
        """The nodes of cycles: those that the loops are left of, and those spliced out above a member."""
        found = seeds.select("node")
        for kind, rows in reversed(self.steps):
            if kind != "rake":
                found = self.scratch.keep(found.unionAll(rows.join(found.select(F.col("node").alias("child")), "child", "left_semi").select("node")))
        return sorted(r[0] for r in found.distinct().limit(10).collect())

    def run(self) -> DataFrame:
        n, turn = self.alive.count(), 0
        exact = all(self.alive.schema[c].dataType.simpleString() in _EXACT for c in ("node", "up", *self.fields)) and self.alive.schema["node"].dataType == self.alive.schema["up"].dataType
        before = 2 * n
        while exact and self.block_rows and n > self.small and 2 * n <= before:
            self.blocks(n)
            before, n = n, self.alive.count()
        while n > self.small:
            if turn >= self.most:
                raise ValueError(f"{n} nodes are left after {turn} rounds")
            self.rake()
            self.splice(turn)
            loops = self.alive.where("node = up")
            if not loops.isEmpty():
                raise ValueError(f"the hierarchy has a cycle, of {self.members(loops)}")
            n, turn = self.alive.count(), turn + 1
        later = self.keep(self._rest())
        done = [later]
        for kind, rows in reversed(self.steps):
            known = reduce(DataFrame.unionByName, done)
            above = known.select(F.col("node").alias("up"), F.col("depth").alias("_d"), F.col("root").alias("_r"))
            if kind == "splice":
                under = known.select(F.col("node").alias("child"), *[F.col(a).alias(f"f{i}") for i, a in enumerate(self.fields)])
                rows = rows.join(under, "child").select("node", "up", "len", *[self.both(self.both(F.col(a), F.col(f"c{i}"), i), F.col(f"f{i}"), i).alias(a) for i, a in enumerate(self.fields)])
            elif kind == "block":
                under = known.select(F.col("node").alias("child"), *[F.col(a).alias(f"f{i}") for i, a in enumerate(self.fields)])
                rows = rows.join(under, "child", "left").select("node", "up", "len", *[self.both(F.col(a), F.col(f"f{i}"), i).alias(a) for i, a in enumerate(self.fields)])
            placed = rows.join(above, "up", "left")
            done.append(self.keep(placed.select("node", *self.fields, F.coalesce(F.col("_d") + F.col("len"), F.lit(0)).alias("depth"), F.coalesce("_r", "node").alias("root"))))
        return reduce(DataFrame.unionByName, done)

    def _rest(self) -> DataFrame:
        """The last nodes, ``small`` at most, finished in the driver."""
        rows = {r["node"]: r for r in self.alive.collect()}
        below: dict = {}
        for r in rows.values():
            below.setdefault(r["up"], []).append(r["node"])
        order, todo = [], list(below.get(None, []))
        place = {v: (0, v) for v in todo}
        while todo:
            v = todo.pop()
            order.append(v)
            for c in below.get(v, []):
                place[c] = (place[v][0] + rows[c]["len"], place[v][1])
                todo.append(c)
        if len(order) < len(rows):
            loop = self.spark.createDataFrame([(v,) for v in self._looped(rows, place)], self.alive.select("node").schema)
            raise ValueError(f"the hierarchy has a cycle, of {self.members(loop)}")
        total = {v: [rows[v][a] for a in self.fields] for v in order}
        for v in reversed(order):
            up = rows[v]["up"]
            if up is not None:
                for i, w in enumerate(self.edge):
                    for x in (total[v][i], rows[v][w]):
                        if x is not None:
                            total[up][i] = x if total[up][i] is None else _PLAIN[self.kinds[i]](total[up][i], x)
        kinds = self.alive.schema
        schema = ", ".join([f"node {kinds['node'].dataType.simpleString()}", *[f"{a} {kinds[a].dataType.simpleString()}" for a in self.fields], "depth long", f"root {kinds['node'].dataType.simpleString()}"])
        return self.spark.createDataFrame([(v, *total[v], *place[v]) for v in order], schema)

    @staticmethod
    def _looped(rows: dict, place: dict) -> list:
        """Of the nodes that no root reaches, those on loops: the ones a walk upwards comes back to."""
        out: set = set()
        for v in rows:
            seen: list = []
            while v not in place and v not in seen and v not in out:
                seen.append(v)
                v = rows[v]["up"]
            if v in seen:
                out |= set(seen[seen.index(v) :])
        return sorted(out)


def deep_rollup(df: DataFrame, node: str, parent: str, values: dict[str, tuple[str, str]], small: int = 2_000, most_rounds: int = 200, block_rows: int = 100_000) -> DataFrame:
    """``df`` with, for each named value, (column, min, max or sum) over the node and all its descendants, and with ``depth``
    (roots 0) and ``root``. Null values count for nothing. Parents that are not nodes make roots; null nodes and repeated
    nodes are errors, and so are cycles, which are named by ten of their members at most.

    Sums are exact in their column's own type. No closure: work and rows written are linear in the nodes at any depth, over
    about 3.5 log(n) rounds of a chain, fewer of a bush, n being what blocks of ``block_rows`` neighbouring keys leave (0: no
    blocks; none of fractions and timestamps). The last ``small`` nodes are finished in the driver.
    """
    names = [*values, "depth", "root"]
    if clash := {c.lower() for c in df.columns} & {n.lower() for n in names}:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    if strange := {k for _, k in values.values()} - set(_JOIN):
        raise ValueError(f"unknown aggregates {sorted(strange)}")
    assert_unique(df, [node], "hierarchy")
    if not df.where(F.col(node).isNull()).isEmpty():
        raise ValueError("hierarchy: a null node")
    made = _Contraction(df, node, parent, values, small, most_rounds, block_rows).run()
    out = made.select(F.col("node").alias("_node"), *[F.col(f"a{i}").alias(n) for i, n in enumerate(values)], "depth", "root")
    return df.join(out, F.col(node) == F.col("_node"), "left").drop("_node")
