"""URL filters by a cascade of Bloom filters: exact membership in a list, for every key of the corpus, without joins.

Level 1 encodes the listed keys. The corpus's other keys that it wrongly accepts are encoded by level 2, the listed keys
that level 2 wrongly accepts by level 3, and so on until a level makes no mistake. A key's first rejecting level then
tells whether it is listed, with no error for any key of the universe. Level 1 is sized so that about as many keys
pass wrongly as are listed, so the whole cascade needs a few dozen bits a listed key, however large the corpus is.
DataFrame operations only; what reaches the driver is the filters' words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.work import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits)) for i in range(hashes)]


class BloomLevel:
    def __init__(self, words: list[int], bits: int, hashes: int, seed: int) -> None:
        self.words, self.bits, self.hashes, self.seed = words, bits, hashes, seed

    @classmethod
    def of(cls, keys: DataFrame, n: int, rate: float, seed: int) -> BloomLevel:
        """A filter of the n keys in column ``key`` that wrongly accepts ``rate`` of others."""
        bits = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2 / 64) * 64)
        hashes = max(1, round(math.log(1 / rate) / math.log(2)))
        at = F.explode(F.array(*_positions(F.col("key"), bits, hashes, seed)))
        set_bits = keys.select(at.alias("p")).groupBy(F.floor(F.col("p") / 64).cast("int").alias("w"))
        words = [0] * (bits // 64)
        for w, v in set_bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))"))).collect():
            words[w] = v
        return cls(words, bits, hashes, seed)

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        hit = [F.getbit(F.element_at(words, (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1 for p in _positions(key, self.bits, self.hashes, self.seed)]
        out = hit[0]
        for h in hit[1:]:
            out = out & h
        return out


class Cascade:
    """Exact membership in ``listed`` for the keys of a universe; a null key isn't listed."""

    def __init__(self, levels: list[BloomLevel]) -> None:
        self.levels = levels

    @classmethod
    def build(cls, listed: list[str], universe: DataFrame, universe_size: int, most_levels: int = 64) -> Cascade:
        """universe: distinct keys in column ``key``. listed may hold keys outside it."""
        listed = sorted({k for k in listed if k is not None})
        spark = universe.sparkSession
        if not listed:
            return cls([])
        inside = spark.createDataFrame([(k,) for k in listed], "key string")
        outside = universe.where(~F.col("key").isin(listed)) if len(listed) <= 1000 else universe.join(inside, "key", "left_anti")
        scratch, levels = Scratch(spark), []
        ours, theirs, n = inside, outside, len(listed)
        rate = min(0.5, max(1e-9, n / (math.sqrt(2) * max(1, universe_size))))
        while n:
            if len(levels) == most_levels:
                raise ValueError(f"the cascade has not ended after {most_levels} levels")
            levels.append(BloomLevel.of(ours, n, rate, seed=len(levels) + 1))
            wrong = scratch.keep(theirs.where(levels[-1].holds(F.col("key"))))
            ours, theirs, n, rate = wrong, ours, wrong.count(), 0.5
        return cls(levels)

    def holds(self, key: Column) -> Column:
        """Column: whether key is listed. An odd number of accepting levels before the first that rejects: listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(self.levels[i].holds(key), out).otherwise(F.lit(i % 2 == 1))
        return F.coalesce(key.isNotNull() & out, F.lit(False))


def url_parts(url: Column) -> tuple[Column, Column]:
    """host (A-Z lower-cased) and path; both empty for null and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _shape(rule: str) -> tuple[int, int]:
    host, _, path = rule.partition("/")
    return host.count(".") + 1, len(path) + 1


def judge_urls(pages: DataFrame, allow: list[str], block: list[str], blocked_hosts: list[str], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    A rule ``host/path`` fits its host and all subdomains where the url's path starts with the rule's. The longest
    fitting rule decides; without one, a host on ``blocked_hosts``, or under one, is blocked, and others get ``default``.
    Candidate keys of a url are its host suffixes joined to its path prefixes, of the lengths that rules have. Repeated
    pages give repeated rows; null urls have empty parts and the default verdict; no pages give no rows.
    """
    if set(allow) & set(block):
        raise ValueError(f"rules that both allow and block: {sorted(set(allow) & set(block))}")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("_url"))
    host, path = url_parts(F.col("_url"))
    base = base.select("page_id", host.alias("host"), path.alias("path"))
    labels = F.length("host") - F.length(F.replace("host", F.lit("."))) + 1

    def key(shape: tuple[int, int]) -> Column:
        n, m = shape
        return F.when((labels >= n) & (F.length("path") >= m), F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)))

    def suffix(n: int) -> Column:
        return F.when((labels >= n) & (F.col("host") != ""), F.concat(F.substring_index("host", ".", -n), F.lit("/")))

    shapes = sorted({_shape(r) for r in [*allow, *block]})
    depths = sorted({h.count(".") + 1 for h in blocked_hosts})
    hosts = [f"{h}/" for h in blocked_hosts]
    every = [key(s) for s in shapes] + [suffix(n) for n in depths]
    if not every:
        return base.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    universe = Scratch(pages.sparkSession).keep(base.select(F.explode(F.array(*every)).alias("key")).where("key is not null").distinct())
    size = universe.count()
    allowed, banned, listed = (Cascade.build(x, universe, size) for x in (allow, block, hosts))
    hits = []
    for s in shapes:
        k = key(s)
        ok, no = allowed.holds(k), banned.holds(k)
        hits.append(F.when(ok | no, F.struct(F.length(k).alias("size"), k.alias("rule"), F.when(ok, "allow").otherwise("block").alias("verdict"))))
    best = (F.greatest(*hits) if len(hits) > 1 else hits[0]) if hits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    bad = F.lit(False)
    for n in depths:
        bad = bad | listed.holds(suffix(n))
    out = base.withColumn("best", best).withColumn("bad", bad)
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.when(F.col("bad"), "block").otherwise(default)).alias("verdict"))
