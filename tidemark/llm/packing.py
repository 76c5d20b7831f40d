"""Packing documents into training sequences by the sum-of-squares rule.

Documents become token ids, each document ends with an end id, and is cut into pieces of at most one sequence. Pieces
are then placed one after another: among the levels that partly filled sequences have, and a new sequence, each piece
goes where the sum of squared counts of partly filled sequences by level becomes smallest. The counts are one array of
``capacity`` numbers, so a decision is a few vector operations. Full pieces fill a sequence alone.

Spark deals pieces to groups of about ``group_pieces`` by a hash of the piece, so no group grows with the input, a hot
document or source is spread, and only lengths are exchanged, never ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import caches, handing_back
from ..sources.work import Scratch

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Ids by key, of late and of before; keys are parts of plain words, and other words whole.
_KNOWN: dict[str, tuple[dict[str, bytes], dict[str, bytes]]] = {}
_TOKENIZERS: dict[str, object] = {}
_ENDS: dict[str, np.ndarray] = {}
caches("packing", _KNOWN, _TOKENIZERS, _ENDS)
#: Python's split() also takes these for white space; the tokenizer's pattern does not. Special strings span words.
_SEPARATORS, _SPECIAL = "\x1c\x1d\x1e\x1f", re.compile("<\\|startoftext\\|>|<\\|endoftext\\|>")
#: Texts of these characters alone are lower-cased and cut here as the vocabulary's own rule does; of others, words of them.
_PLAIN = re.compile("[\t-\r -~À-ÿ]*")
_CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-z0-9à-öø-ÿß \t-\r]+")
_CACHED, _LONGEST_CACHED, _TEXTS_AT_ONCE, _KEYS_AT_ONCE = 150_000, 64, 256, 64


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def _ids(tokenizer, texts: list[str]) -> list[bytes]:
    return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _ends(path: str) -> np.ndarray:
    """For each id of the vocabulary: whether it ends a part of a word."""
    if path not in _ENDS:
        vocabulary = _tokenizer(path).get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        _ENDS[path] = ends
    return _ENDS[path]


def _new_ids(keys: list[str], path: str) -> dict[str, bytes]:
    """Each distinct key's ids from the library; parts of plain words go there many in one text."""
    tokenizer = _tokenizer(path)
    parts, words = [], []
    for k in keys:
        (parts if _PLAIN.fullmatch(k) else words).append(k)
    texts = [" ".join(parts[i : i + _KEYS_AT_ONCE]) for i in range(0, len(parts), _KEYS_AT_ONCE)]
    data = b"".join(_ids(tokenizer, texts))
    stops = ((np.flatnonzero(_ends(path)[np.frombuffer(data, "<u4")]) + 1) * 4).tolist()
    out = {k: data[start:stop] for k, start, stop in zip(parts, [0, *stops[:-1]], stops, strict=True)} if parts else {}
    out.update(zip(words, _ids(tokenizer, words), strict=True))
    return out


def _keys(text: str, seen: dict[str, list[str]]) -> list[str]:
    """What the text is encoded by, in order. seen: the keys of words met before, for texts that aren't plain."""
    if _PLAIN.fullmatch(text):
        return _CUT.findall(text.lower())
    out: list[str] = []
    for w in text.split():
        if w not in seen:
            seen[w] = _CUT.findall(w.lower()) if _PLAIN.fullmatch(w) else [w]
        out += seen[w]
    return out


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit numbers, exactly as the library gives them.

    For a vocabulary that drops white space and never joins across it, a text's ids are its words' ids one after another,
    and a plain word's ids those of its parts; so each distinct part is encoded once and kept while it is in use: a full
    cache becomes the older one, from which only what is met again comes back. Texts with special strings go to the
    library whole.
    """
    tokenizer, (known, older) = _tokenizer(path), _KNOWN.setdefault(path, ({}, {}))
    out: list[bytes] = [b""] * len(texts)
    whole = [i for i, t in enumerate(texts) if any(c in t for c in _SEPARATORS) or ("<|" in t and _SPECIAL.search(t))]
    for i, ids in zip(whole, _ids(tokenizer, [texts[i] for i in whole]), strict=True):
        out[i] = ids
    skip, seen = set(whole), {}
    cut = [(i, _keys(t, seen)) for i, t in enumerate(texts) if i not in skip]
    new = set().union(*(k for _, k in cut)).difference(known)
    if len(known) + len(new) > _CACHED:
        known, older = _KNOWN[path] = {}, known
        new = set().union(*(k for _, k in cut))
    back = [k for k in new if k in older]
    known.update((k, older[k]) for k in back)
    new = list(new.difference(back))
    known.update(_new_ids(new, path))
    for i, keys in cut:
        out[i] = b"".join(map(known.__getitem__, keys))
    for k in new:
        if len(k) > _LONGEST_CACHED:
            del known[k]
    return out


def pieces(documents: DataFrame, path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece of a document's ids with the end id, at most ``capacity`` each. Null text: the end id alone."""
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), _TEXTS_AT_ONCE):
                part = batch.iloc[lo : lo + _TEXTS_AT_ONCE]
                rows = []
                for doc_id, ids in zip(part["doc_id"].array, encode_texts([t if isinstance(t, str) else "" for t in part["text"]], path), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        own = ids[4 * start : 4 * min(n, start + capacity)]
                        rows.append((doc_id, start, len(own) // 4, zlib.crc32(own), n))
                made = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                made["doc_id"] = made["doc_id"].astype("Int64")
                yield made

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(handing_back(cut, "packing"), PIECES)


def place(lengths: np.ndarray, capacity: int, levels: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, placed in the given order. counts[h]: open sequences at fill level h.

    Levels are steps of capacity / levels tokens, rounded up, so that groups of a few thousand pieces see each often.
    """
    step = max(1, capacity // levels)
    top = -(-capacity // step)
    counts = np.zeros(top + 1, dtype=np.int64)
    open_at: list[list[tuple[int, int]]] = [[] for _ in range(top + 1)]
    sequence, offset, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        units, level = -(-size // step), 0
        if units < top:
            # moving one sequence from h to h + units changes the sum of squares by 2 (counts[h + units] - counts[h] + 1);
            # a new one by 2 counts[units] + 1, and one that fills up leaves the sum
            change = 2 * (counts[units:] - counts[: top + 1 - units]) + 2
            change[0] = 2 * counts[units] + 1
            change[-1] = 1 - 2 * counts[top - units]
            change[1:][counts[1 : top + 1 - units] == 0] = np.iinfo(np.int64).max
            level = top - units - int(change[::-1].argmin())  # among equals the fullest sequence
        if level:
            counts[level] -= 1
            sequence[i], offset[i] = open_at[level].pop()
        else:
            sequence[i], made = made, made + 1
        fill = int(offset[i]) + size
        level = -(-fill // step)
        if level < top:
            counts[level] += 1
            open_at[level].append((int(sequence[i]), fill))
    return sequence, offset


def pack(documents: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, group_pieces: int = 8192) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id lies in one piece. Repeated rows are packed each; a null doc_id stays null; no documents give no rows.
    """
    made = Scratch(documents.sparkSession).keep(pieces(documents, path, capacity, end_id))
    groups = max(1, -(-made.count() // group_pieces))

    def placed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ids_crc32", "doc_id", "start"], kind="stable", ignore_index=True)
        pdf["sequence_id"], pdf["offset"] = place(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] += pdf.pop("_group").astype("int64") * (1 << 32)
        return pdf

    dealt = made.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("int"))
    return dealt.groupBy("_group").applyInPandas(placed, f"{PIECES}, sequence_id long, offset long")
