"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of labelled rows, so the index has a proven size and is sent to every task. Features are all
words and word beginnings of the sample, none dropped, known by 64-bit hashes: each has its idf over all documents, raised
by 1 + chi-square where toxic examples have it more often. Norms are those of whole examples. Postings lie in blocks of examples, and each common term
has its largest weight in every block; rare ones are summed up first. Blocks are visited by their upper bounds, and left
out for texts that can have no nearer example there, so the k nearest are exact. Their votes, weighted by cosine and
class, are turned into probabilities by an isotonic curve fitted on the examples, each held out in turn.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.work import Scratch
from .batches import hand_back, handing_back, short_batches
from .jaccard_join import byte_hashes, word_hashes
from .names import free_prefix

_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_STEMS = (5, 7)
_BATCH = 64
_BYTES_AT_ONCE = 1_000_000
_SLICE = 1 << 14


def _plain(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN)


def text_terms(text: str | None) -> dict[bytes, int]:
    """Counts of words, and of the first bytes of longer words (marked by a star)."""
    counts = Counter(_plain(text).split())
    out = dict(counts)
    for n in _STEMS:
        for w, c in counts.items():
            if len(w) > n:
                key = w[:n] + b"*"
                out[key] = out.get(key, 0) + c
    return out


def term_hashes(terms: list[bytes]) -> np.ndarray:
    """Hashes of terms as ``text_terms`` writes them."""
    out = []
    for t in terms:
        stem = t.endswith(b"*")
        raw = np.frombuffer(t[:-1] if stem else t, np.uint8)
        out.append(byte_hashes(raw[None, :], len(raw) if stem else 0)[0])
    return np.array(out, np.int64)


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every occurrence of a term."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts, words = word_hashes(data)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    owner, found = [text], [words.view(np.int64)]
    for n in _STEMS:
        within = np.minimum(starts + n, len(data) - 1)
        long = starts[(data[within] != 32) & (np.searchsorted(starts, within, side="right") == np.arange(1, len(starts) + 1))]
        owner.append(text[np.searchsorted(starts, long)])
        found.append(byte_hashes(data[long[:, None] + np.arange(n)], n))
    return np.concatenate(owner), np.concatenate(found)


def _batches(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    part: list[bytes] = []
    size = 0
    for t in texts:
        part.append(_plain(t if isinstance(t, str) else None))
        size += len(part[-1])
        if size > _BYTES_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def known_terms(texts: Iterable[str | None], terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the numbers and counts of the terms that ``terms`` (sorted hashes) holds, by number."""
    for part in _batches(texts):
        owner, found = _hashed(part)
        at = np.minimum(np.searchsorted(terms, found), max(0, len(terms) - 1))
        is_known = terms[at] == found if len(terms) else np.zeros(len(found), bool)
        key, counts = np.unique(owner[is_known] * len(terms) + at[is_known], return_counts=True)
        cuts = np.searchsorted(key, np.arange(1, len(part)) * len(terms))
        yield from zip(np.split((key % max(1, len(terms))).astype(np.int32), cuts), np.split(counts.astype(np.int32), cuts), strict=True)


class ToxicIndex:
    """Exact k nearest examples. terms: weight by term, or sorted hashes of terms and their weights; rows: (example id, label,
    counts of terms, or their numbers and counts)."""

    def __init__(self, terms: dict[bytes, float] | tuple[np.ndarray, np.ndarray], examples: list[tuple[int, int, dict[bytes, int] | tuple[np.ndarray, np.ndarray]]], class_rows: tuple[float, float], k: int = 15, block: int = 64) -> None:
        self.k, self.block = k, block
        if isinstance(terms, dict):
            hashes, weights = term_hashes(list(terms)), np.array(list(terms.values()), float)
            terms = np.sort(hashes), weights[np.argsort(hashes)]
        self.terms, self.idf = terms
        own = [sum(1 for x in examples if x[1] == c) for c in (0, 1)]
        self.scale = np.array([class_rows[c] / own[c] if own[c] else 0.0 for c in (0, 1)])
        rows = [(i, y, *self._numbered(counts)) for i, y, counts in sorted(examples, key=lambda x: x[0])]
        kept = self._grouped([x for x in rows if len(x[2])])
        self.ids = [x[0] for x in kept]
        self.labels = np.array([x[1] for x in kept], float)
        blank = [self.scale[x[1]] for x in rows if not len(x[2])]
        bad = [self.scale[1] for x in rows if x[1] and not len(x[2])]
        self.rest = (sum(bad) + 0.5 * self.scale[1]) / (sum(blank) + max(1.0, self.scale.sum())) if blank else 0.5
        self.rest = min(self.rest, 0.5)
        self._post(kept)
        self.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
        votes = [self._vote(near) for s in range(0, len(kept), _BATCH) for near in self._search([self.vector(x[2:]) for x in kept[s : s + _BATCH]], range(s, s + _BATCH))]
        self._calibrate(np.array([v for v, _ in votes]))

    def _grouped(self, kept: list, groups: int = 16, cells: int = 64) -> list:
        """Examples in an order that lays like ones together, so that blocks' largest weights are tight: k-means of their
        weights by hashed cells of terms."""
        if len(kept) <= groups * self.block:
            return kept
        x = np.stack([np.bincount(at * 40503 % 65521 % cells, self._weights(at, tf), cells) for _, _, at, tf in kept])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        centre = x[:1]
        while len(centre) < groups:
            centre = np.concatenate([centre, x[[(x @ centre.T).max(axis=1).argmin()]]])
        for _ in range(8):
            own = (x @ centre.T).argmax(axis=1)
            centre = np.stack([x[own == g].sum(axis=0) if (own == g).any() else centre[g] for g in range(groups)])
            centre /= np.linalg.norm(centre, axis=1, keepdims=True)
        return [kept[i] for i in np.argsort((x @ centre.T).argmax(axis=1), kind="stable")]

    def _post(self, kept: list) -> None:
        """Postings by term. Those of common terms are rows of a matrix, with their largest weight in each block."""
        self.n_blocks = max(1, -(-len(kept) // self.block))
        none = [np.zeros(0, np.int32)]
        term, tf = (np.concatenate([x[j] for x in kept] or none) for j in (2, 3))
        self.log = 1 + np.log(np.maximum(np.arange(tf.max(initial=1) + 1), 1))
        tf = tf.astype(np.min_scalar_type(int(tf.max(initial=1))))
        self.norm = np.ones(self.n_blocks * self.block)
        self.norm[: len(kept)] = [np.sqrt((self._weights(*x[2:]) ** 2).sum()) for x in kept]
        example = np.repeat(np.arange(len(kept), dtype=np.min_scalar_type(len(kept))), [len(x[2]) for x in kept])
        n = np.bincount(term, minlength=len(self.terms))
        common = np.flatnonzero(n > max(8, len(kept) // 16))
        self.row = np.full(len(self.terms), -1, np.int32)
        self.row[common] = np.arange(len(common))
        often = self.row[term] >= 0
        self.often = term[often], tf[often], example[often]
        order = np.argsort(term[~often], kind="stable")
        self.example, self.tf = example[~often][order], tf[~often][order]
        self.place = np.argsort(np.argsort([x[0] for x in kept], kind="stable"), kind="stable")
        self.start = np.concatenate([[0], np.cumsum(np.where(self.row >= 0, 0, n))])
        self._fill()

    def _fill(self) -> None:
        self.share = np.empty(len(self.tf))
        for t in range(0, len(self.terms), 20_000):  # or a worker holds several such arrays while it reads the index
            cut = self.start[t : t + 20_001]
            here = slice(int(cut[0]), int(cut[-1]))
            self.share[here] = self.log[self.tf[here]] * np.repeat(self.idf[t : t + 20_000], np.diff(cut)) / self.norm[self.example[here]]
        self.dense = np.zeros((int(self.row.max(initial=-1)) + 1, self.n_blocks * self.block))
        for s in range(0, len(self.often[0]), 100_000):
            term, tf, example = (x[s : s + 100_000] for x in self.often)
            self.dense[self.row[term], example] = self._weights(term, tf) / self.norm[example]
        self.most = self.dense.reshape(len(self.dense), self.n_blocks, self.block).max(axis=2)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("dense", "most", "share")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._fill()

    def _weights(self, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (1 + np.log(tf, dtype=float)) * self.idf[at]

    def _numbered(self, counts: dict[bytes, int] | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if not isinstance(counts, dict):
            return counts
        hashes, tf = term_hashes(list(counts)), np.array(list(counts.values()), np.int32)
        at = np.minimum(np.searchsorted(self.terms, hashes), max(0, len(self.terms) - 1)).astype(np.int32)
        known = np.flatnonzero(self.terms[at] == hashes) if len(self.terms) else np.zeros(0, np.int64)
        known = known[np.argsort(at[known], kind="stable")]
        return at[known], tf[known]

    def vector(self, counts: dict[bytes, int] | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and unit weights of the terms. Terms that no example has change all cosines of a text by one factor only,
        which neither order nor votes depend on."""
        at, tf = self._numbered(counts)
        w = self._weights(at, tf) if len(at) else np.zeros(0)
        return at, w / np.sqrt((w * w).sum()) if len(at) else w

    def _search(self, queries: list[tuple[np.ndarray, np.ndarray]], leave: Iterable[int] = ()) -> list[list[tuple[float, int]]]:
        """Of each query, (cosine, example) of the k nearest with a positive cosine, nearest first, equals by example."""
        width = self.n_blocks * self.block
        score = np.zeros((len(queries), width))
        often = np.zeros((len(queries), len(self.dense)))
        for q, (at, w) in enumerate(queries):
            row = self.row[at]
            often[q, row[row >= 0]] = w[row >= 0]
            rare, own = at[row < 0], w[row < 0]
            n = self.start[rare + 1] - self.start[rare]
            if total := int(n.sum()):
                pick = np.repeat(self.start[rare] - np.cumsum(n) + n, n) + np.arange(total)
                score[q] = np.bincount(self.example[pick], self.share[pick] * np.repeat(own, n), width)
        # rare terms are summed up; what common ones can add in a block is bounded by their largest weights there
        bound = often @ self.most + score.reshape(len(queries), self.n_blocks, self.block).max(axis=2)
        done, left = np.full((len(queries), width), -1.0), dict(enumerate(leave))
        least = np.zeros(len(queries))
        turn = np.argsort(-bound.max(axis=0), kind="stable")
        for i, blk in enumerate(turn.tolist()):
            here = slice(blk * self.block, (blk + 1) * self.block)
            if len(q := np.flatnonzero((bound[:, blk] > 0) & (bound[:, blk] >= least - 1e-12))):
                done[q, here] = score[q, here] + (often if len(q) == len(often) else often[q]) @ self.dense[:, here]
            if i in (0, 1, 3, 7, 15, 31, 63) and (i + 1) * self.block > self.k:  # one more than k, as a query's own row may be left out
                seen = (turn[: i + 1, None] * self.block + np.arange(self.block)).ravel()
                least = np.maximum(least, np.partition(done[:, seen], len(seen) - self.k - 1, axis=1)[:, len(seen) - self.k - 1])
        found = []
        for q, whole in enumerate(done):
            top = np.flatnonzero(whole >= max(least[q] - 1e-9, 1e-12))
            if q in left:
                top = top[top != left[q]]
            s = np.round(whole[top], 12)
            if len(s) > self.k:
                near = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
                top, s = top[near], s[near]
            top = top[np.lexsort((self.place[top], -s))][: self.k]
            found.append(list(zip(whole[top].tolist(), top.tolist(), strict=True)))
        return found

    def nearest(self, counts: dict[bytes, int]) -> list[tuple[float, int]]:
        return self._search([self.vector(counts)])[0]

    def _vote(self, near: list[tuple[float, int]]) -> tuple[float, list[tuple[float, int]]]:
        """Share of toxic votes, each weighted by its squared cosine and by its class's share of the corpus; -1: no vote."""
        if not near:
            return -1.0, near
        i = [x[1] for x in near]
        # rounded, as repeated rows in other batches differ in the last bits
        c = np.round([x[0] for x in near], 12) ** 2 * self.scale[self.labels[i].astype(int)]
        return float((c * self.labels[i]).sum() / c.sum()), near

    def _calibrate(self, votes: np.ndarray) -> None:
        use = votes >= 0
        if not use.any():
            return
        v, y, w = votes[use], self.labels[use], self.scale[self.labels[use].astype(int)]
        order = np.argsort(v, kind="stable")
        pools: list[list[float]] = []
        for x, label, weight in zip(v[order], y[order], w[order], strict=True):  # pool adjacent violators
            pools.append([x * weight, label * weight, weight])
            while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        prior = min(1.0, w.sum() / len(w))
        xs = np.array([p[0] / p[2] for p in pools])
        ys = np.array([(p[1] + 0.02 * prior) / (p[2] + 0.04 * prior) for p in pools])
        self.curve = (xs, ys)

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[int]]]:
        """(probability of toxic, ids of the nearest examples) of each text."""
        out: list = [None] * len(texts)
        queries = [self.vector(counts) for counts in known_terms(texts, self.terms)]
        # like texts together, so that they need the same blocks: by the common term of the largest weight
        common = [(at[row >= 0], w[row >= 0]) for at, w in queries for row in (self.row[at],)]
        order = sorted(range(len(texts)), key=lambda i: int(common[i][0][common[i][1].argmax()]) if len(common[i][0]) else -1)
        for s in range(0, len(order), _BATCH):
            part = order[s : s + _BATCH]
            for i, near in zip(part, self._search([queries[j] for j in part]), strict=True):
                v, _ = self._vote(near)
                out[i] = (float(np.interp(v, *self.curve)) if v >= 0 else self.rest, [self.ids[j] for _, j in near])
        return out


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from; a null doc_id has no label to learn from and counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_index(documents: DataFrame, labels: DataFrame, most_toxic: int = 3000, most_clean: int = 5000, k: int = 15, label_weight: float = 1.0) -> ToxicIndex:
    """Index of at most ``most_toxic`` + ``most_clean`` labelled rows that are not held out, chosen by a hash of doc_id.

    label_weight: 0 to 1, how much terms gain that toxic examples have more often: idf is multiplied by 1 + label_weight x the
    chi-square of term and label, which is at most the number of examples. At 0 cosines are those of plain TF-IDF.
    """
    if not 0 <= label_weight <= 1:
        raise ValueError(f"label_weight must be from 0 to 1: {label_weight}")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    totals = {int(r["_toxic"]): r["count"] for r in known.groupBy("_toxic").count().collect()}
    pick = lambda y, n: known.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = pick(1, most_toxic).unionAll(pick(0, most_clean))
    docs = documents.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))

    spark, classes = documents.sparkSession, (totals.get(0, 0), totals.get(1, 0))
    short_batches(spark)
    scratch = Scratch(spark)
    sample_path = scratch.write(docs.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]))
    sample = spark.read.parquet(sample_path)
    n = {int(r["_toxic"]): r["count"] for r in sample.groupBy("_toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return ToxicIndex({}, [(int(r["_id"]), int(r["_toxic"]), {}) for r in sample.select("_id", "_toxic").collect()], classes, k)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = {y: [np.zeros(0, np.int64)] for y in (0, 1)}
            for text, y in zip(batch["text"], batch["_toxic"], strict=True):
                rows[int(y)].append(np.unique(_hashed([_plain(text if isinstance(text, str) else None)])[1]))
            ends = {y: np.unique(np.concatenate(rows[y]), return_counts=True) for y in (0, 1)}
            yield pd.concat([pd.DataFrame({"term": ends[y][0], "t": ends[y][1] * y, "c": ends[y][1] * (1 - y)}) for y in (0, 1)])

    seen = sample.mapInPandas(handing_back(counted), "term long, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).toArrow()
    terms, t, c = (seen[x].to_numpy() for x in ("term", "t", "c"))
    order = np.argsort(terms)
    terms, t, c, total = terms[order], t[order].astype(float), c[order].astype(float), float(n[0] + n[1])
    # the 2 x 2 table's chi-square, of terms that toxic rows have more often; it adds weight and drops no term
    diff = np.maximum(t * (n[0] - c) - c * (n[1] - t), 0)
    chi = total * diff * diff / np.maximum(float(n[0]) * n[1] * (t + c) * (total - t - c), 1)
    shared = spark.sparkContext.broadcast(terms)

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often, rows = np.zeros(len(shared.value) + 1, "<i8"), 0
        for batch in batches:
            rows += len(batch)
            for at, _ in known_terms(batch["text"], shared.value):
                often[at] += 1
        often[-1] = rows
        yield pd.DataFrame([(i, zlib.compress(often[i * _SLICE : (i + 1) * _SLICE].tobytes(), 1)) for i in range(-(-len(often) // _SLICE))], columns=["slice", "counts"])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch["slice"], batch["counts"], strict=True):
                counts = np.frombuffer(zlib.decompress(packed), "<i8")
                sums[i] = sums[i] + counts if i in sums else counts
        yield pd.DataFrame([(i, v.tobytes()) for i, v in sums.items()], columns=["slice", "counts"])

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(known_terms(batch["text"], shared.value))
            yield pd.DataFrame({"_id": batch["_id"], "_toxic": batch["_toxic"], "at": [at.astype("<i4").tobytes() for at, _ in rows], "tf": [tf.astype("<i4").tobytes() for _, tf in rows]})

    # how many documents have each term: each task sends its counts, packed by slices of the terms, which are added up slice by slice
    parts = docs.select("text").mapInPandas(handing_back(met), "slice int, counts binary").repartition("slice").mapInPandas(handing_back(added), "slice int, counts binary").collect()
    df = np.concatenate([np.frombuffer(r["counts"], "<i8") for r in sorted(parts, key=lambda r: r["slice"])]) if parts else np.zeros(len(terms) + 1)
    weights = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * (1 + label_weight * chi)
    del seen, parts, df, t, c, diff, chi
    own = sample.mapInPandas(handing_back(numbered), "_id long, _toxic int, at binary, tf binary").toArrow()
    examples = [(i.as_py(), y.as_py(), (np.frombuffer(at.as_buffer(), "<i4"), np.frombuffer(tf.as_buffer(), "<i4"))) for i, y, at, tf in zip(own["_id"], own["_toxic"], own["at"], own["tf"], strict=True)]
    shared.destroy()
    scratch.drop(sample_path)
    del own
    hand_back()
    return ToxicIndex((terms, weights), examples, classes, k)


def toxicity(documents: DataFrame, index: ToxicIndex) -> DataFrame:
    """``documents`` with ``_toxicity`` (0 to 1) and ``_evidence_ids`` (nearest examples); whole texts, no shuffle. Where
    ``documents`` has such names, see ``free_prefix``. Long texts are searched like others. No documents: no rows.

    Null and empty texts, and texts without any term of an example, get the share of toxic rows among blank examples. Repeated rows
    get equal scores. Without labels of both classes every score is that share.
    """
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def of_batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            out = shared.value.scores([t if isinstance(t, str) else None for t in s])
            yield pd.DataFrame({"score": [x[0] for x in out], "ids": [x[1] for x in out]})

    @F.pandas_udf("struct<score:double,ids:array<long>>")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from handing_back(of_batches)(texts)

    scored = scored.asNondeterministic()  # or conditions on the score could evaluate it twice
    short_batches(documents.sparkSession)
    p = free_prefix(documents)
    out = documents.withColumn(f"{p}both", scored(F.col("text").cast("string")))
    return out.withColumns({f"{p}toxicity": F.col(f"{p}both.score"), f"{p}evidence_ids": F.col(f"{p}both.ids")}).drop(f"{p}both")
