"""Removal of long passages that earlier documents have, by a compacted De Bruijn graph of words.

Edges of the graph are windows of ``window`` words. Every window belongs to an anchor, its leftmost least ``core``-word
hash, so equal windows have equal anchors in all documents. Windows of one document that follow each other under one anchor
are a path without branches there, and travel as one edge: the anchor, a hash of all the words that the path covers, and the
coordinates (row, first window, windows). No window travels by itself at first, and texts not at all.

1. An aggregation finds anchors of two or more documents; a join keeps only their paths. All others have no repeated window.
2. An aggregation by (anchor, words) gives each compacted path its smallest document; one by anchor, how many paths branch
   from it. Where a path occurs in a later document, all its windows are repeated there.
3. Under an anchor with a single path there is nothing else to find. Where paths branch, those of each path's own first
   document are opened: by their coordinates they meet their text again, each window gets a 128-bit hash of its words, an
   aggregation finds its smallest document, and a join returns the windows that an earlier document has.
4. Spans, as (row, first word, end), meet the texts, and the words they cover go.

All of this is exact but for hashes: a path's name is its anchor's 64 bits and 64 more, a window's 128, of words known by 64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.work import Scratch
from .jaccard_join import _GOLD, _M1, _M2, _mix, word_hashes
from .names import free_prefix

WINDOW, CORE = 50, 20
_BYTES_AT_ONCE = 4_000_000
_BASE = np.uint64(0x9FB21C651E98DF25)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def rolled(words: np.ndarray, width: int, kind: int) -> np.ndarray:
    """Hashes of all runs of ``width`` word hashes, joined from runs of doubling lengths; another kind, other hashes."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    salt, mark = np.uint64(2 * kind + 1), np.uint64((2 * kind + 1) * int(_GOLD) & (1 << 64) - 1)
    have, size, at, out = words * _M1 + salt, 1, 0, None
    while True:
        if width & size:
            part = have[at : at + len(words) - width + 1]
            out = part if out is None else _mix(out * _M2 + (part ^ mark))
            at += size
        if 2 * size > width:
            return _mix(out + salt)
        have, size = _mix(have[:-size] * _M1 + (have[size:] ^ salt)), 2 * size


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where, in each run of ``width`` values, the least one is; of equal ones the first."""
    at, size = np.arange(len(values)), 1
    join = lambda left, right: np.where(values[left] <= values[right], left, right)
    while 2 * size <= width:
        at, size = join(at[:-size], at[size:]), 2 * size
    return join(at[: len(at) - (width - size)], at[width - size :]) if width > size else at


def _batches(columns: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut so that their texts stay below some megabytes, or are one text."""
    for batch in columns:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        lo, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > lo and total + n > _BYTES_AT_ONCE:
                part = batch.slice(lo, i - lo)
                yield part, _bytes(part.column(text))
                lo, total = i, 0
            total += n
        if batch.num_rows > lo:
            part = batch.slice(lo)
            yield part, _bytes(part.column(text))


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and each text's first one among them (and their number at the end)."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, words = word_hashes(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
    return words, np.concatenate([[0], np.searchsorted(starts, ends)])


def _paths(texts: list[bytes], window: int, core: int) -> dict[str, np.ndarray]:
    """The texts' compacted paths: text, anchor, hash of the words, first window, windows."""
    words, first = _words(texts)
    if len(words) < window:
        return {k: np.zeros(0, np.int64) for k in ("row", "anchor", "path", "start", "n")}
    cores = rolled(words, core, 0)
    at = leftmost_least(cores, window - core + 1)
    where = np.arange(len(at))
    row = np.searchsorted(first, where, "right") - 1
    inside = where + window <= first[row + 1]
    where, row, at = where[inside], row[inside], at[inside]
    if not len(where):
        return {k: np.zeros(0, np.int64) for k in ("row", "anchor", "path", "start", "n")}
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])])
    lo, row = where[new], row[new]
    n = np.diff(np.append(np.flatnonzero(new), len(where)))
    # a hash of words lo to lo + n + window - 2: differences of running sums, at place 0 by the base's inverse
    power = np.ones(len(words) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(words), _BASE), out=power[1:])
    back = np.ones(len(words) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(words), _INVERSE), out=back[1:])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(words + _GOLD) * power[:-1], dtype=np.uint64)])
    path = _mix((sums[lo + n + window - 1] - sums[lo]) * back[lo] + n.astype(np.uint64) * _M1)
    anchor = cores[at[new]]
    # a path that repeats right behind itself, as in one word many times, stays one row
    fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (path[1:] != path[:-1])])
    total = np.add.reduceat(n, np.flatnonzero(fresh))
    return {"row": row[fresh], "anchor": anchor[fresh].view(np.int64), "path": path[fresh].view(np.int64), "start": (lo - first[row])[fresh], "n": total}


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = WINDOW, core: int = CORE, scratch: Scratch | None = None) -> DataFrame:
    """Spans of words that windows with an earlier document's words cover: ``doc``, ``same`` (a hash of the text), ``spans``
    as an array of (start, end), in words from 0, unsorted, possibly overlapping. Documents without any have no row."""
    if not 1 <= core <= window:
        raise ValueError("a core has one word at least, and no more than a window")
    scratch = scratch or Scratch(docs.sparkSession)
    own = docs.select(F.col(id_column).alias("doc"), F.col(text).alias("text")).where(F.col("doc").isNotNull())
    kind = own.schema["doc"].dataType.simpleString()
    read = own.select("doc", _text_hash(F.col("text")).alias("same"), "text")

    def paths(batches: Iterator[pa.RecordBatch], every: bool) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches, 2):
            got = _paths(texts, window, core)
            if not every:  # each anchor once a text
                _, i = np.unique(np.stack([got["row"], got["anchor"]]), axis=1, return_index=True)
                got = {k: v[i] for k, v in got.items()}
            cols = [batch.column(0).take(pa.array(got["row"])), pa.array(got["anchor"], pa.int64())]
            if every:
                cols += [batch.column(1).take(pa.array(got["row"])), *[pa.array(got[k], pa.int64()) for k in ("path", "start", "n")]]
            yield pa.RecordBatch.from_arrays(cols, ["doc", "anchor", "same", "path", "start", "n"][: len(cols)])

    anchors = read.mapInArrow(lambda b: paths(b, False), f"doc {kind}, anchor long")
    # written, so that both sides of each join are plain exchanges, whose hot partitions Spark can split
    shared = scratch.keep(anchors.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("anchor"))
    found = read.mapInArrow(lambda b: paths(b, True), f"doc {kind}, anchor long, same long, path long, start long, n long")
    kept = scratch.keep(found.join(shared, "anchor", "left_semi"))

    edges = scratch.keep(kept.groupBy("anchor", "path").agg(F.min("doc").alias("first")))
    ways = scratch.keep(edges.groupBy("anchor").agg(F.count("*").alias("ways")))
    edges = scratch.keep(edges.join(ways, "anchor"))
    met = scratch.keep(kept.join(edges, ["anchor", "path"]).where("doc > first or ways > 1").select("doc", "same", "start", "n", (F.col("doc") > F.col("first")).alias("later")))
    whole = met.where("later").select("doc", "same", F.struct("start", (F.col("start") + F.col("n") + (window - 1)).alias("end")).alias("span"))

    opened = met.where("not later").groupBy("doc", "same").agg(F.collect_list(F.struct("start", "n")).alias("open"))
    # rows that repeat a document with its text repeat its windows, which changes neither their smallest document nor the spans
    texts = read.join(opened.hint("shuffle_hash"), ["doc", "same"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part in _batches(batches, 2):
            words, first = _words(part)
            one, two = (rolled(words, window, k).view(np.int64) for k in (1, 2))
            spans = batch.column(3)
            n = pa.compute.list_value_length(spans).to_numpy()
            flat = spans.flatten()
            lo, size = (flat.field(k).to_numpy() for k in (0, 1))
            row = np.repeat(np.arange(len(n)), n)
            row, lo = np.repeat(row, size), np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = first[row] + lo
            keys = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keys), batch.column(1).take(keys), pa.array(lo), pa.array(one[at]), pa.array(two[at])], ["doc", "same", "start", "one", "two"])

    each = scratch.keep(texts.mapInArrow(windows, f"doc {kind}, same long, start long, one long, two long"))
    least = scratch.keep(each.groupBy("one", "two").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("one", "two", "lo"))
    single = each.join(least, ["one", "two"]).where("doc > lo").select("doc", "same", F.struct("start", (F.col("start") + window).alias("end")).alias("span"))
    return whole.unionByName(single).groupBy("doc", "same").agg(F.collect_list("span").alias("spans"))


def remove_repeated(docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = WINDOW, core: int = CORE) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_removed`` and ``_kept``: the words that are left, joined by one space. A word goes if
    a window of ``window`` words covers it whose words also start in a document with a smaller id; windows are those of the
    input. Words: runs of bytes other than space and \\x09 to \\x0d, unchanged.

    A null text is empty, and so is what is kept of it. A null id is neither smaller nor larger than any: such rows lose
    nothing and cost others nothing. Rows with equal ids don't cost each other words; each is judged by its own text. Passages
    that repeat inside one document only stay. An empty table gives none. Columns that the table has already lead to names
    with more underscores. Texts of any length are read whole, one at a time where they are long.

    At scale: texts are read three times and shuffled twice; besides, a row of some 40 bytes for about 16 words is shuffled
    twice, and all later steps have only what is repeated. Hot passages are aggregated in part before they are shuffled, and
    the joins on them are ones whose large partitions Spark splits.
    """
    p = free_prefix(docs)
    spans = repeated_spans(docs, text, id_column, window, core).select(F.col("doc").alias(p + "doc"), F.col("same").alias(p + "same"), F.col("spans").alias(p + "spans"))
    hashed = docs.withColumn(p + "text", _text_hash(F.col(text)))
    joined = hashed.join(spans.hint("shuffle_hash"), (F.col(id_column) == F.col(p + "doc")) & (F.col(p + "text") == F.col(p + "same")), "left").drop(p + "doc", p + "same", p + "text")
    names, at = docs.columns, {c: i for i, c in enumerate(joined.columns)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches, at[text]):
            spans = batch.column(at[p + "spans"])
            flat, ends = spans.flatten(), np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(spans), 0).to_numpy())
            lo, hi = (flat.field(k).to_numpy() for k in (0, 1))
            total, gone, kept = [], [], []
            for i, t in enumerate(texts):
                words = t.split()
                a, b = (ends[i - 1] if i else 0), ends[i]
                left = words
                if b > a:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, lo[a:b], 1)
                    np.add.at(steps, hi[a:b], -1)
                    left = [words[j] for j in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
                total.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            made = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(at[c]) for c in names], *made], [*names, p + "n_words", p + "n_removed", p + "kept"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(cut, f"{fields}, {p}n_words long, {p}n_removed long, {p}kept string")
