"""Media columns by signature sniffing: find magic bytes, confirm structure and lengths, correct types, carve media.

One Aho-Corasick automaton locates the first bytes of all known formats in a column of binary values. A format's validator
then walks the structure from there (chunk lengths, checksums, end marks); what it confirms is a media object with an
offset and a length, what it rejects is chance. A value's type is that of the object at offset 0, whatever was declared.
End marks that a validator needs are collected once a value, so repeated magic bytes without an end cost no rescans.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .names import free_prefix

# Magic bytes by type.
MAGIC = {"png": b"\x89PNG\r\n\x1a\n", "gif": b"GIF8", "jpeg": b"\xff\xd8\xff", "wav": b"RIFF", "bmp": b"BM", "pdf": b"%PDF-", "zip": b"PK\x03\x04"}
_UNIT = 192
_AUTOMATON: list = []


def _automaton():
    if not _AUTOMATON:
        import ahocorasick

        a = ahocorasick.Automaton()
        for kind, magic in MAGIC.items():
            a.add_word(magic.decode("latin-1"), (kind, len(magic)))
        a.make_automaton()
        _AUTOMATON.append(a)
    return _AUTOMATON[0]


def _png(b: bytes, at: int) -> int:
    pos = at + 8
    while pos + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, pos)
        end = pos + 12 + n
        if end > len(b) or zlib.crc32(b[pos + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0] or (pos == at + 8 and kind != b"IHDR"):
            return 0
        if kind == b"IEND":
            return end - at
        pos = end
    return 0


def _wav(b: bytes, at: int) -> int:
    if len(b) < at + 12 or b[at + 8 : at + 12] != b"WAVE":
        return 0
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    pos, kinds = at + 12, set()
    if end > len(b):
        return 0
    while pos + 8 <= end:
        kind, n = struct.unpack_from("<4sI", b, pos)
        kinds.add(kind)
        pos += 8 + n + n % 2
    return end - at if pos == end and {b"fmt ", b"data"} <= kinds else 0


def _bmp(b: bytes, at: int) -> int:
    if len(b) < at + 54:
        return 0
    size, reserved, start, header = struct.unpack_from("<IIII", b, at + 2)
    width, height, planes, bits = struct.unpack_from("<iiHH", b, at + 18)
    row = (abs(width) * bits + 31) // 32 * 4
    fits = reserved == 0 and header in (40, 108, 124) and planes == 1 and bits in (1, 4, 8, 16, 24, 32) and start >= 14 + header
    return size if fits and size == start + row * abs(height) and at + size <= len(b) else 0


def _gif(b: bytes, at: int) -> int:
    if b[at + 4 : at + 6] not in (b"7a", b"9a") or len(b) < at + 14:
        return 0
    pos = at + 13 + (3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 0x80 else 0)
    while pos < len(b):
        if b[pos] == 0x3B:
            return pos + 1 - at
        if b[pos] == 0x2C and pos + 11 < len(b):
            pos += 10 + (3 << ((b[pos + 9] & 7) + 1) if b[pos + 9] & 0x80 else 0) + 1
        elif b[pos] == 0x21:
            pos += 2
        else:
            return 0
        while pos < len(b) and b[pos]:
            pos += b[pos] + 1
        pos += 1
    return 0


def _jpeg(b: bytes, at: int, last_mark: int) -> int:
    pos = at + 2
    while pos + 4 <= len(b) and b[pos] == 0xFF:
        mark = b[pos + 1]
        if mark == 0xDA:
            return b.find(b"\xff\xd9", pos) + 2 - at if last_mark >= pos else 0
        if mark in (0x00, 0xD8, 0xD9):
            return 0
        pos += 2 + struct.unpack_from(">H", b, pos + 2)[0]
    return 0


def _pdf(b: bytes, at: int) -> int:
    """To the last end mark before another PDF begins: updates and linearised files have several. A PDF that holds another one
    as it is ends before that."""
    after = b.find(b"%PDF-", at + 5)
    end = b.rfind(b"%%EOF", at, after if after >= 0 else len(b))
    return end + 5 - at if end > 0 and b.find(b"startxref", at, end) > 0 and b[at + 5 : at + 6].isdigit() else 0


def _archives(b: bytes) -> dict[int, int]:
    """Ends of ZIP archives by their start, which an end record names by the sizes before it; of several, the last."""
    out, end = {}, b.find(b"PK\x05\x06")
    while end >= 0:
        if end + 22 <= len(b):
            size, start, note = struct.unpack_from("<IIH", b, end + 12)
            if end + 22 + note <= len(b):
                out[end - size - start] = end + 22 + note
        end = b.find(b"PK\x05\x06", end + 4)
    return out


VALIDATE = {"png": _png, "gif": _gif, "wav": _wav, "bmp": _bmp, "pdf": _pdf}
CONTAINERS = ("pdf", "zip")


def sniff_nested(value: bytes) -> list[tuple[str, int, int, int | None]]:
    """(type, offset, length, offset of the container) of confirmed media in order. Media stored as they are in a PDF or ZIP are
    found, too, and lie wholly in it; what looks like media within any other object is part of that one."""
    out, around, last_mark, archives = [], [], -2, None
    for end, (kind, n) in _automaton().iter(value.decode("latin-1")):
        at = end + 1 - n
        while around and at >= around[-1][1]:
            around.pop()
        if around and around[-1][2] not in CONTAINERS:
            continue
        if kind == "zip":
            archives = _archives(value) if archives is None else archives
            length = archives.get(at, at) - at
        elif kind == "jpeg":
            last_mark = value.rfind(b"\xff\xd9") if last_mark == -2 else last_mark
            length = _jpeg(value, at, last_mark)
        else:
            length = VALIDATE[kind](value, at)
        if length > 0 and (not around or at + length <= around[-1][1]):
            out.append((kind, at, length, around[-1][0] if around else None))
            around.append((at, at + length, kind))
    return out


def sniff_bytes(value: bytes) -> list[tuple[str, int, int]]:
    """(type, offset, length) of confirmed media in order that lie in no other."""
    return [x[:3] for x in sniff_nested(value) if x[3] is None]


def sniff(df: DataFrame, value: str, declared: str) -> DataFrame:
    """``df`` with ``media_type`` (of the object at offset 0, else null), ``type_corrected`` (it differs from the declared
    one) and ``media`` (array of type, offset, length and ``within``, the offset of the container, null outside of one).

    If ``df`` has one of these names, in any case, all three begin with ``free_prefix``. A null or empty value has no media and
    no type; long values are searched whole; repeated rows get a row each; an empty table stays empty.
    """
    p = free_prefix(df) if {c.lower() for c in df.columns} & {"media", "media_type", "type_corrected"} else ""

    @F.pandas_udf("array<struct<type:string,offset:long,length:long,within:long>>")
    def found(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in values:
            yield pd.Series([[{"type": k, "offset": o, "length": n, "within": w} for k, o, n, w in sniff_nested(bytes(v))] if v is not None else [] for v in s], dtype=object)

    first = F.try_element_at(f"{p}media", F.lit(1))
    kind = F.when(first["offset"] == 0, first["type"])
    out = df.withColumn(f"{p}media", found(F.col(value))).withColumn(f"{p}media_type", kind)
    return out.withColumn(f"{p}type_corrected", F.coalesce(F.col(f"{p}media_type") != F.coalesce(F.col(declared), F.lit("")), F.lit(False)))


def to_wav(payload: bytes, rate: int = 8000) -> bytes:
    """8-bit mono samples as a WAV file."""
    pad = len(payload) % 2
    head = b"RIFF" + struct.pack("<I", 36 + len(payload) + pad) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8)
    return head + b"data" + struct.pack("<I", len(payload)) + payload + b"\0" * pad


def wav_samples(stored: bytes) -> bytes:
    pos = 12
    while True:
        kind, n = struct.unpack_from("<4sI", stored, pos)
        if kind == b"data":
            return stored[pos + 8 : pos + 8 + n]
        pos += 8 + n + n % 2


def text_media(documents: DataFrame) -> DataFrame:
    """doc_id, text bytes, the text stored as 8-bit samples, and a declared type that is right for some texts only."""

    @F.pandas_udf("binary")
    def stored(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            b = (t or "").encode("utf-8", "surrogatepass")
            out.append(to_wav(b + b" " * (-len(b) % _UNIT if b else _UNIT)))
        return pd.Series(out)

    text = F.col("text").cast("string")
    names = F.array(*[F.lit(x) for x in ("wav", "png", "jpeg")])
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), stored(text).alias("stored"), F.element_at(names, (F.pmod(F.crc32(F.coalesce(text, F.lit(""))), F.lit(3)) + 1).cast("int")).alias("declared"))


def media_digest(media: DataFrame) -> DataFrame:
    """What a reader gets from the stored bytes: the carved object's samples, checksums and features.

    Equal texts give equal values. Null text: empty, so one unit of spaces. Long texts: whole. Repeated rows: a row each. No
    rows: none. Of the caller's columns only those named are read, so clashing names don't matter.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, n, stored, declared in zip(batch["doc_id"].array, batch["n_bytes"], batch["stored"], batch["declared"], strict=True):
                objects = sniff_bytes(stored)
                kind, at, length = objects[0]
                own = stored[at : at + length]
                back = wav_samples(own)
                x = np.frombuffer(back, np.uint8)
                signed = x.astype(np.int16) - 128
                crossings = int(np.count_nonzero(np.diff(signed >= 0)))
                note = f"type={kind};declared={declared};corrected={int(kind != declared)};objects={len(objects)};samples={len(x)};mean={x.mean():.4f};peak={int(np.abs(signed).max())};crossings={crossings}"
                rows.append((doc_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), length, hashlib.sha256(own).hexdigest(), note))
            out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return media.mapInPandas(read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
