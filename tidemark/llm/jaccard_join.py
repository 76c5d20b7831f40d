"""Exact similarity classes of documents by shingle sets: PartEnum signatures, then verification.

Sets of a size band can differ in at most k elements if their Jaccard similarity reaches the threshold. The domain of
shingles is partitioned by a hash into groups, each group into ``parts`` parts; a signature is a set's projection on a
subset of ``parts - spared`` parts of one group. If k differences fall on more groups than they can spoil, similar sets
share a signature. Spare groups let sets leave out the signatures of empty projections, which all sets would share. Larger sets get
one more group for each 16 needed. A group with j differences keeps at least spared + 1 - j signatures, so similar sets share
at least (spared + 1) x groups - differences: many, as most pairs are smaller than the largest of their band.

Copies (equal shingle sets) become one set first. Candidates are then verified exactly, in two steps that both lose no
class: sets that share a signature are chained in an order dealt by hash, a link a set and signature instead of all
pairs; then, only where a signature still joins several components, every set outside the signature's largest component
is compared with all sets of the others. Pairs inside one component need no comparison. There a set that shares t signatures
with any similar one leaves out its t - 1 most frequent: of t in common, the rarest is left out by neither. So signatures
that many unlike sets have by chance or by a common passage make no pairs.

Before shingles are fetched, pairs are screened by 1,024 parity bits of each set: two sets' bits differ in no more places
than the sets differ in elements, so a pair with more differing bits than its sizes allow is not similar. Large sets, whose
bits are all mixed, are screened by counts of 1,024 cells as well.

Signatures travel packed, 12 bytes each: a row holds all those of a batch of sets that fall into one bucket of hashes, each
as 32 more bits of its hash and its set. They are unpacked where their buckets meet, so every signature's sets meet without
a second exchange; of copies, a batch sends one. Signatures that agree in bucket and bits by chance only cost a screening.

Shingles are 64-bit hashes of words, and a set's name is a 64-bit hash of them. Texts are hashed in pieces of a bounded size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .batches import handing_back, short_batches
from .components import components
from .names import free_prefix
from ..sources.work import Scratch

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BYTES_AT_ONCE = 1_000_000
_SIGNATURES_AT_ONCE = 1_000_000
_FILTER_BITS = 1 << 25
_MORE = 16


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_TABLE = _mix((np.arange(64 * 256, dtype=np.uint64) + np.uint64(1)) * _GOLD)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Each text's set of distinct ``width``-word shingles as sorted hashes. Words: runs of bytes other than space and
    \\x09 to \\x0d, A-Z lower-cased. Fewer words: the whole sequence as one; no word: an empty set."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for t in texts:
        part.append((t or "").encode("utf-8", "surrogatepass").lower())
        size += len(part[-1])
        if size > _BYTES_AT_ONCE:
            out += _sets(part, width)
            part, size = [], 0
    return out + _sets(part, width)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of joined texts that end in a blank. A hash sums up what each byte has at its place."""
    starts, sums = [], []
    offset, tail = 0, 0  # bytes before the piece, bytes of a word that the piece before has cut
    for lo in range(0, len(data), _BYTES_AT_ONCE):
        piece = data[lo : lo + _BYTES_AT_ONCE]
        inside = (piece != 32) & ((piece < 9) | (piece > 13))
        first = np.flatnonzero(inside & ~np.concatenate([[tail > 0], inside[:-1]]))
        rest = tail > 0 and bool(inside[0])
        at = np.concatenate([[0], first]) if rest else first
        if len(at):
            position = np.arange(len(piece))
            position[at[0] :] -= np.repeat(at, np.diff(np.append(at, len(piece))))
            if rest:
                end = int(first[0]) if len(first) else len(piece)
                position[:end] += tail
            value = np.zeros(len(piece), np.uint64)
            near = inside & (position < 64)
            value[near] = _TABLE[(position[near] << 8) | piece[near]]
            far = inside & ~near
            if far.any():
                value[far] = _mix((((position[far].astype(np.uint64) << np.uint64(8)) | piece[far]) + np.uint64(1)) * _GOLD)
            total = np.add.reduceat(value, at)
            if rest:
                sums[-1][-1:] += total[:1]
            starts.append(first + offset)
            sums.append(total[1:] if rest else total)
            if rest and not len(first):
                starts.pop(), sums.pop()
        if inside[-1]:
            last = int(at[-1])
            tail = len(piece) - last + (tail if rest and last == 0 else 0)
        else:
            tail = 0
        offset += len(piece)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), _mix(np.concatenate(sums))


def byte_hashes(rows: np.ndarray, kind: int = 0) -> np.ndarray:
    """Hashes of the rows of a byte matrix; kind 0: as ``word_hashes`` has them."""
    value = np.zeros(len(rows), np.uint64)
    for i in range(rows.shape[1]):
        at = rows[:, i].astype(np.int64) | (i << 8)
        value += _TABLE[at] if i < 64 else _mix((at.astype(np.uint64) + np.uint64(1)) * _GOLD)
    return _mix(_mix(value) + np.array([kind], np.uint64) * _M1 if kind else value).view(np.int64)


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    if not texts:
        return []
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, words = word_hashes(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
    if not len(starts):
        return [np.zeros(0, np.int64) for _ in texts]
    n_words = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
    first = np.concatenate([[0], np.cumsum(n_words)])
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            rolled = _mix(rolled * _M2 + words[i : len(words) - width + 1 + i] + np.uint64(i + 1))
    out = []
    for lo, n in zip(first[:-1].tolist(), n_words.tolist(), strict=True):
        if n >= width:
            h = np.sort(rolled[lo : lo + n - width + 1].view(np.int64))
            out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
        elif n:
            x = np.array([n], np.uint64)
            for i in range(lo, lo + n):
                x = _mix(x * _M1 + words[i : i + 1])
            out.append(x.view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _digest(s: np.ndarray) -> int:
    """A set's name: equal sets have one, different ones differ but for chance of 1 in 2^64."""
    u = s.view(np.uint64)
    sums = np.array([[_mix(u + _GOLD).sum(dtype=np.uint64)], [_mix(u * _M2 + _M1).sum(dtype=np.uint64)]])
    return int(_mix(sums[0] * _M1 + sums[1]).view(np.int64)[0])


_LANES = 16
_SKETCH = [f"k{i}" for i in range(_LANES)]


def _parities(s: np.ndarray) -> np.ndarray:
    cells = (_mix(s.view(np.uint64) ^ _M2) >> np.uint64(54)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=64 * _LANES) & 1).astype(np.uint8), bitorder="little").view(np.int64)


_LONG = 2000


def _histogram(s: np.ndarray) -> np.ndarray | None:
    """Counts of a large set by 1,024 cells: two sets' counts differ in sum by no more than the sets differ in elements."""
    if len(s) <= _LONG:
        return None
    cells = (_mix(s.view(np.uint64) ^ _M2) >> np.uint64(54)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=1024), 32_767).astype(np.int16)


def _counts_allow(a: str, b: str, num: int, den: int):
    apart = F.aggregate(F.zip_with(f"{a}.counts", f"{b}.counts", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda t, x: t + x)
    return F.coalesce(F.lit(den + num) * apart <= F.lit(den - num) * (F.col(f"{a}.n") + F.col(f"{b}.n")), F.lit(True))


def _apart(a: str, b: str, lanes: list[str] = _SKETCH):
    return sum((F.bit_count(F.col(f"{a}.{k}").bitwiseXOR(F.col(f"{b}.{k}"))) for k in lanes), F.lit(0))


_FOLDED = [f"f{i}" for i in range(8)]


def _folded(i: int):
    """Parities of two lanes laid over each other: parities of fewer, larger cells, which screen as surely but less often."""
    out = F.col(_SKETCH[i])
    for k in _SKETCH[i + len(_FOLDED) :: len(_FOLDED)]:
        out = out.bitwiseXOR(F.col(k))
    return out.alias(_FOLDED[i])


def _may_be_similar(a: str, b: str, num: int, den: int, lanes: list[str] = _SKETCH):
    """Condition on the sizes and parity bits of two joined sketches."""
    sizes = (F.lit(den) * F.col(f"{a}.n") >= F.lit(num) * F.col(f"{b}.n")) & (F.lit(den) * F.col(f"{b}.n") >= F.lit(num) * F.col(f"{a}.n"))
    return sizes & (F.lit(den + num) * _apart(a, b, lanes) <= F.lit(den - num) * (F.col(f"{a}.n") + F.col(f"{b}.n")))


class PartEnum:
    """Signatures for Jaccard similarity num / den. Sizes fall into bands whose tops grow by ``growth``; a similar pair lies in
    one band or in two that touch, so a set signs for its own band, and for the next if a partner could lie there."""

    def __init__(self, num: int, den: int, parts: int = 3, spared: int = 1, growth: float = 1.25) -> None:
        if growth * num < den:
            raise ValueError("bands must be wider than similar sets' sizes can differ")
        self.num, self.den, self.parts, self.spared, self.growth = num, den, parts, spared, growth
        self.subsets = list(itertools.combinations(range(parts), parts - spared))
        self.tops = [1]

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            low = self.tops[-1] + 1
            self.tops.append(max(low, low * self.den // self.num, int(low * self.growth)))
        return int(np.searchsorted(self.tops, size))

    def groups(self, band: int) -> tuple[int, int]:
        """(groups, spare groups) for pairs whose larger set lies in this band."""
        self.band(self.tops[-1] + 1) if band >= len(self.tops) else None
        top = self.tops[band]
        most = (self.den - self.num) * 2 * top // (self.den + self.num)  # |r| + |s| <= 2 top bounds the differences
        need = most // (self.spared + 1) + 1
        mean = top / ((need + need // _MORE) * self.parts) * (self.parts - self.spared)
        spare = int(np.ceil(need * len(self.subsets) * np.exp(-mean) * 2)) + 1 if most else 0
        return need + need // _MORE + spare, spare

    def _kept(self, band: int) -> int:
        """Signatures of this band that two similar sets share, the larger of this band, and their differences, at least."""
        n, spare = self.groups(band)
        return 1 if (n, spare) == (1, 0) else (self.spared + 1) * (n - spare)

    def differences(self, total):
        """In how many elements similar sets differ at most, whose sizes sum up to this."""
        return (self.den - self.num) * total // (self.den + self.num)

    def shares(self, size: int) -> tuple[int, int]:
        """(``_kept`` of the set's own band, signatures that it shares with any similar set at least)."""
        band, largest = self.band(size), size * self.den // self.num
        kept = self._kept(band)
        least = kept - self.differences(size + min(self.tops[band], largest))
        if largest > self.tops[band]:
            least = min(least, self._kept(band + 1) - self.differences(size + largest))
        return kept, max(1, least)

    def least_shared(self, n):
        """Column: how many signatures two similar sets share at least, the larger of size n."""
        need = F.floor(F.floor(F.lit(2 * (self.den - self.num)) * n / F.lit(self.den + self.num)) / F.lit(self.spared + 1)) + 1
        return F.floor(need / F.lit(_MORE)) + 1

    def signatures(self, s: np.ndarray) -> np.ndarray:
        band = self.band(len(s))
        if len(s) * self.den // self.num <= self.tops[band]:
            return self._of(s, band)
        return np.concatenate([self._of(s, band), self._of(s, band + 1)])

    def _of(self, s: np.ndarray, band: int) -> np.ndarray:
        n, spare = self.groups(band)
        cells = n * self.parts
        if cells == self.parts and not spare:  # no difference allowed: the whole set
            return _mix(np.array([_digest(s)], np.int64).view(np.uint64) + np.uint64(band)).view(np.int64)
        u = s.view(np.uint64)
        cell = ((_mix(u ^ _GOLD) >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        total, filled = np.zeros(cells, np.uint64), np.zeros(cells, np.int64)
        np.add.at(total, cell, _mix(u + _M1))
        np.add.at(filled, cell, 1)
        total, filled = total.reshape(n, self.parts), filled.reshape(n, self.parts)
        made, some = [], []
        for i, subset in enumerate(self.subsets):
            x = np.arange(n, dtype=np.uint64) * np.uint64(len(self.subsets)) + np.uint64(i) + np.uint64(band << 40)
            for p in subset:
                x = _mix(x * _M2 + total[:, p])
            made.append(x)
            some.append(filled[:, list(subset)].sum(axis=1) > 0)
        made, some = np.stack(made), np.stack(some)
        if int((~some).any(axis=0).sum()) <= spare:
            return made[some].view(np.int64)
        return made.ravel().view(np.int64)


def _as_frame(rows: DataFrame, width: int, sign: PartEnum | None, wanted=None) -> DataFrame:
    """doc_id, n, rid (the set's name) and the signatures (or, without sign, the set itself, for doc_ids that the filter holds)."""
    column = "sigs" if sign else "hashes"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if wanted is not None:
                key = batch["doc_id"].fillna(-1).to_numpy(np.int64)
                batch = batch[wanted.value[_slots(key, len(wanted.value))]]
            for lo in range(0, len(batch), 500):
                part = batch.iloc[lo : lo + 500]
                sets = shingle_sets([t if isinstance(t, str) else None for t in part["text"]], width)
                out = pd.DataFrame({"doc_id": part["doc_id"].astype("Int64").array, "n": [len(s) for s in sets], "rid": [_digest(s) for s in sets], "text_key": part["text_key"].array, column: [(sign.signatures(s) if sign else s) if len(s) else s for s in sets]})
                if sign:
                    out[_SKETCH] = np.array([_parities(s) for s in sets])
                    out["counts"] = [_histogram(s) for s in sets]
                    out[["kept", "least"]] = np.array([sign.shares(len(s)) for s in sets])
                yield out

    lanes = "".join(f", {k} long" for k in _SKETCH) + ", counts array<short>, kept long, least long" if sign else ""
    return rows.mapInPandas(handing_back(run), f"doc_id long, n long, rid long, text_key long, {column} array<long>{lanes}")


def _slots(key: np.ndarray, size: int) -> np.ndarray:
    return (_mix(key.view(np.uint64) * _GOLD + _M1) % np.uint64(size)).astype(np.int64)


def _wanted(ids: DataFrame, size: int):
    """A broadcast mask of hashed doc_ids, of a fixed size: it lets some others pass, and an exact join follows."""
    spark = ids.sparkSession

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = _slots(batch["lo"].fillna(-1).to_numpy(np.int64), size)
            yield pd.DataFrame({"word": at >> 6, "bit": at & 63})

    words = ids.mapInPandas(handing_back(slots), "word long, bit int").groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("v")).toPandas()
    table = np.zeros(size // 64, np.uint64)
    table[words["word"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool))


def _packed(own: DataFrame, buckets: int) -> DataFrame:
    """bucket, sigs, rids: the signatures of many sets, by bucket, and the set of each."""

    def packed(names: list[np.ndarray], sigs: list[np.ndarray]) -> pd.DataFrame:
        rows, first = np.unique(np.concatenate(names), return_index=True)
        sigs = [sigs[i] for i in first]
        sig = _mix(np.concatenate(sigs).astype(np.int64).view(np.uint64) * _M2 + _GOLD)
        rid = np.repeat(rows, [len(x) for x in sigs])
        bucket = ((sig >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, bits = bucket[order], (sig[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        return pd.DataFrame({"bucket": bucket[cut], "sigs": np.split(bits, cut[1:]), "rids": np.split(rid[order], cut[1:])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: list[np.ndarray] = []
        sigs: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for lo in range(0, len(batch), 200):
                part = batch["sigs"].iloc[lo : lo + 200].tolist()
                names.append(batch["rid"].iloc[lo : lo + 200].to_numpy(np.int64))
                sigs += part
                size += sum(map(len, part))
                if size >= _SIGNATURES_AT_ONCE:
                    yield packed(names, sigs)
                    names, sigs, size = [], [], 0
        if sigs:
            yield packed(names, sigs)

    return own.mapInPandas(handing_back(run), "bucket long, sigs array<int>, rids array<long>")


def _between(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs that no component holds yet."""
    at = pairs.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left").join(comp.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
    return at.where("ca is null or cb is null or ca <> cb").select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, width: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. sets: rid and lo, a document that has the set."""
    pairs = scratch.keep(pairs)
    used = scratch.keep(sets.join(pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct(), "rid", "left_semi"))
    count = used.count()
    if not count:
        return pairs
    size = min(_FILTER_BITS, max(1 << 16, 1 << (16 * count).bit_length()))
    # both joins read one exchange of the sets, by name
    found = _as_frame(rows, width, None, _wanted(used, size)).select("rid", "hashes").dropDuplicates(["rid"])
    left = pairs.join(found.withColumnsRenamed({"rid": "a", "hashes": "ha"}), "a")
    both = left.join(found.withColumnsRenamed({"rid": "b", "hashes": "hb"}), "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    checked = both.select("a", "b", shared.alias("i"), (F.size("ha") + F.size("hb")).alias("s"))
    return scratch.keep(checked.where(F.lit(den).cast("long") * F.col("i") >= F.lit(num).cast("long") * (F.col("s") - F.col("i"))).select("a", "b"))


def _screened(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that all parity bits and counts allow, and in how many bits they differ."""
    narrow, wide = sketches.drop("counts"), sketches.where("counts is not null").select("rid", "n", "counts")
    at = pairs.join(narrow.alias("x"), F.col("a") == F.col("x.rid")).join(narrow.alias("y"), F.col("b") == F.col("y.rid")).where(_may_be_similar("x", "y", num, den))
    at = at.select("a", "b", _apart("x", "y").alias("apart"))
    at = at.join(wide.alias("x"), F.col("a") == F.col("x.rid"), "left").join(wide.alias("y"), F.col("b") == F.col("y.rid"), "left")
    return at.where(_counts_allow("x", "y", num, den)).select("a", "b", "apart")


def _signed(rows: DataFrame, width: int, sign: PartEnum, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """sets, sketches, every document's set, and the path of the signatures that two or more sets share. What is only needed
    on the way goes with this call: the signatures of all sets are its largest table and its largest exchange."""
    signed_path = scratch.write(_as_frame(rows, width, sign))
    signed = scratch.spark.read.parquet(signed_path)
    some = signed.where("n > 0")
    sets = scratch.keep(some.groupBy("rid").agg(F.min("doc_id").alias("lo")))
    sketches = scratch.keep(some.select("rid", "n", *_SKETCH, "counts", "kept", "least").dropDuplicates(["rid"]))
    every = scratch.keep(signed.select("doc_id", "n", "rid", "text_key"))
    partitions = 4 * int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    met = _packed(some.select("rid", "sigs"), 4 * partitions).repartition(partitions, "bucket").select("bucket", F.explode(F.arrays_zip("sigs", "rids")).alias("x"))
    shown = met.select("bucket", F.col("x.sigs").alias("bits"), F.col("x.rids").alias("rid"))
    order = Window.partitionBy("bucket", "bits").orderBy(F.xxhash64("bits", "rid"))
    chained = shown.withColumn("prev", F.lag("rid").over(order)).withColumn("next", F.lead("rid").over(order))
    sig = (F.shiftleft("bucket", 32) + F.col("bits").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("sig")
    shared_path = scratch.write(chained.where("prev <> rid or next <> rid").select(sig, "rid", "prev"))
    scratch.drop(signed_path)
    return sets, sketches, every, shared_path


def _across(shared_path: str, comp: DataFrame, short: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Pairs of sets that share enough signatures, may be similar and lie in different components: of each signature, all sets
    outside its largest component against the others. Each set leaves out its most frequent signatures, one fewer than it
    must share; a pair's common ones are then fewer by one less than the larger of both numbers at most."""
    shared = scratch.spark.read.parquet(shared_path)
    tagged_path = scratch.write(shared.join(comp.select(F.col("node").alias("rid"), "comp"), "rid", "left").select("sig", "rid", F.coalesce("comp", "rid").alias("comp")))
    tagged = scratch.spark.read.parquet(tagged_path)
    scratch.drop(shared_path)
    sizes = tagged.groupBy("sig", "comp").agg(F.count("*").alias("n"))
    main = sizes.groupBy("sig").agg(F.max(F.struct("n", "comp")).alias("m"), F.count("*").alias("c"), F.sum("n").alias("often")).where("c > 1").select("sig", F.col("m.comp").alias("main"), "often")
    mixed = tagged.join(main, "sig").select("sig", "rid", "comp", (F.col("comp") != F.col("main")).alias("few"), "often").dropDuplicates(["sig", "rid"])
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("often"), "sig"))
    mixed_path = scratch.write(mixed.withColumn("rank", rank).drop("often").join(short, "rid").where("rank >= least").drop("rank"))
    scratch.drop(tagged_path)
    mixed = scratch.spark.read.parquet(mixed_path)
    meet = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.comp") != F.col("y.comp")) & _may_be_similar("x", "y", num, den, _FOLDED)
    once = ~F.col("y.few") | (F.col("x.rid") < F.col("y.rid"))
    cross = mixed.where("few").alias("x").join(mixed.alias("y"), meet & once)
    cross = cross.select(F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b"), (F.col("x.n") + F.col("y.n")).alias("n"), F.greatest("x.kept", "y.kept").alias("kept"), F.greatest("x.least", "y.least").alias("least"))
    cross = cross.groupBy("a", "b", "n", "kept", "least").agg(F.count("*").alias("met"))
    enough = F.col("kept") - F.floor(F.lit(den - num) * F.col("n") / F.lit(den + num)) - F.col("least") + 1
    cross = scratch.keep(cross.where(F.col("met") >= enough).select("a", "b"))
    scratch.drop(mixed_path)
    return cross


def similar_documents(documents: DataFrame, width: int = 5, num: int = 80, den: int = 100, parts: int = 3, spared: int = 1, text_key: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when their sets' Jaccard similarity is at least num / den; component_id is the smallest doc_id reachable
    by links, the document itself included. Without words (null or blank text) a document is linked with nothing. Repeated
    rows are copies, each with its row. A null doc_id stays null and never names a component that has another id.
    """
    short_batches(documents.sparkSession)
    scratch = Scratch(documents.sparkSession)
    text = F.col("text").cast("string")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    sign = PartEnum(num, den, parts, spared)
    sets, sketches, every, shared_path = _signed(rows, width, sign, scratch)
    shared = documents.sparkSession.read.parquet(shared_path)
    ends = shared.where("prev <> rid").select(F.least("rid", "prev").alias("a"), F.greatest("rid", "prev").alias("b"))
    pairs = scratch.keep(ends.groupBy("a", "b").agg(F.count("*").alias("met")))
    short = sketches.select("rid", "n", "kept", "least", *[_folded(i) for i in range(len(_FOLDED))])
    near = pairs.join(short.alias("x"), F.col("a") == F.col("x.rid")).join(short.alias("y"), F.col("b") == F.col("y.rid"))
    # of large sets, pairs that are neighbours in few chains can wait for the second step
    near = near.where(_may_be_similar("x", "y", num, den, _FOLDED)).where(F.col("met") * 4 >= sign.least_shared(F.greatest("x.n", "y.n"))).select("a", "b")
    near = scratch.keep(_screened(near, sketches, num, den))
    # each set's nearest partner first; of the other pairs, those that still lie in different components
    ends = near.select(F.col("a").alias("me"), "a", "b", "apart").unionAll(near.select(F.col("b").alias("me"), "a", "b", "apart"))
    rank = F.row_number().over(Window.partitionBy("me").orderBy("apart", F.xxhash64("a", "b")))
    best = scratch.keep(ends.withColumn("rank", rank).where("rank = 1").select("a", "b").distinct())
    links = _verified(best, sets, rows, width, num, den, scratch)
    comp = scratch.keep(components(links, scratch))
    rest = _between(near.select("a", "b").join(best, ["a", "b"], "left_anti"), comp)
    more = _verified(rest, sets, rows, width, num, den, scratch)
    if not more.isEmpty():
        comp = scratch.keep(components(links.unionAll(more), scratch))
    cross = _across(shared_path, comp, short, num, den, scratch)
    cross = _screened(cross, sketches, num, den).select("a", "b")
    cross = cross.join(near.select("a", "b"), ["a", "b"], "left_anti")
    more = _verified(cross, sets, rows, width, num, den, scratch)
    if not more.isEmpty():
        ends = more.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left").join(comp.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
        joined = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), scratch)
        alone = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(comp, "node", "left_anti")
        named = comp.unionAll(alone.select("node", F.col("node").alias("comp")))
        comp = scratch.keep(named.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))
    named = sets.join(comp.select(F.col("node").alias("rid"), "comp"), "rid", "left").select("rid", "lo", F.coalesce("comp", "rid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("lo").alias("component_id"))
    final = named.join(least, "comp").select("rid", "component_id")
    result = scratch.last(every.join(final, "rid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *(["text_key"] if text_key else [])))
    return result


def one_per_class(documents: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``documents`` with one row of each class of similar texts: the one whose doc_id names the class.

    Of rows that share that doc_id, one text stays, and repeated rows (equal doc_id and text) are one. Texts without words
    stay, each doc_id once a text. A null doc_id names no class: such a row stays only where its class has no id at all.
    """
    classes = similar_documents(documents, width, num, den, text_key=True)
    named = classes.where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    alone = classes.where("n_shingles = 0 or (doc_id is null and component_id is null)").select("doc_id", "text_key")
    none, p = F.lit(-(1 << 63)), free_prefix(documents)
    names = [f"{p}id", f"{p}null", f"{p}text"]
    stay = named.unionAll(alone).select(F.coalesce("doc_id", none).alias(names[0]), F.coalesce(F.col("doc_id").isNull(), F.lit(True)).alias(names[1]), F.col("text_key").alias(names[2])).distinct()
    doc_id = F.col("doc_id").cast("long")
    own = documents.withColumns(dict(zip(names, (F.coalesce(doc_id, none), doc_id.isNull(), F.xxhash64(F.col("text").cast("string"))), strict=True)))
    return own.join(stay, names, "left_semi").dropDuplicates(names).select(*documents.columns)
