"""Token counts by compiled finite-state transducers.

Two deterministic transducers run one after the other over a batch of texts.

* Words: 13 states read character classes and say where a pre-token begins, with a delay of one character. A text is
  one or more chunks; each chunk gives a map from every entry state to its exit state, maps are composed by a parallel
  prefix scan, and then each chunk runs once more from its true entry state. A chunk may start anywhere.
* Tokens: bytes of a pre-token go through a transducer whose transitions carry the change in the number of tokens that
  byte-pair merging gives the bytes so far. The state keeps what later merges can still see: for each place at which a
  vocabulary entry may still be open, the last token of the encoding up to there and the count relative to now. States
  and transitions are compiled when first met and kept by the Python worker, up to ``_MOST_STATES``; then it starts anew.

All chunks of a batch advance together, a column at a time, in numpy. Texts stay in their partition: no shuffle.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pre-tokenizer's pattern takes 's 't 're 've 'm 'll 'd, runs of letters, of numbers, of others (each
# with one space before), and white space.
_CLASSES = ["letter", "number", "other", "apostrophe", "space", "white", "stmd", "r", "v", "l", "e", "end"]
_LETTER, _NUMBER, _OTHER, _APOSTROPHE, _SPACE, _WHITE, _STMD, _R, _V, _L, _E, _END = range(12)
_STATES = ["start", "letters", "numbers", "others", "apostrophe", "r", "v", "l", "closed", "space", "white", "spaces", "whites"]
_START, _LETTERS, _NUMBERS, _OTHERS, _OPEN, _OPEN_R, _OPEN_V, _OPEN_L, _CLOSED, _ONE_SPACE, _ONE_WHITE, _SPACES, _WHITES = range(13)
_HERE, _BEFORE = 1, 2
# Unicode's White_Space
_WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CHUNK, _CHARS_AT_ONCE, _MOST_STATES = 1024, 2_000_000, 180_000


def _word_transducer() -> tuple[np.ndarray, np.ndarray]:
    """next[state, class], emit[state, class]: bit 1, a pre-token begins here; bit 2, one begins at the character before."""
    to = np.zeros((13, 12), np.uint8)
    emit = np.zeros((13, 12), np.uint8)
    letters = (_LETTER, _STMD, _R, _V, _L, _E)
    kind = {c: _LETTERS for c in letters} | {_NUMBER: _NUMBERS, _OTHER: _OTHERS, _APOSTROPHE: _OTHERS}
    for state in range(13):
        for c in range(12):
            e = 0
            if c in (_SPACE, _WHITE):
                white = state in (_ONE_SPACE, _ONE_WHITE, _SPACES, _WHITES)
                s = (_SPACES if c == _SPACE else _WHITES) if white else (_ONE_SPACE if c == _SPACE else _ONE_WHITE)
                e = 0 if white else _HERE
            elif c == _END:
                s, e = _START, 0
            else:
                s = kind[c]
                if state in (_START, _CLOSED, _ONE_WHITE):
                    e = _HERE
                elif state == _ONE_SPACE:
                    e = 0
                elif state == _SPACES:
                    e = _BEFORE
                elif state == _WHITES:
                    e = _HERE | _BEFORE
                elif state == _OPEN:
                    e = 0 if s == _OTHERS else _HERE
                else:
                    e = 0 if s == (_LETTERS if state in (_OPEN_R, _OPEN_V, _OPEN_L) else state) else _HERE
                begins = bool(e & _HERE)
                if c == _APOSTROPHE and begins:
                    s = _OPEN
            if state == _OPEN and c in (_STMD, _R, _V, _L):
                s, e = {_STMD: _CLOSED, _R: _OPEN_R, _V: _OPEN_V, _L: _OPEN_L}[c], 0
            elif (state in (_OPEN_R, _OPEN_V) and c == _E) or (state == _OPEN_L and c == _L):
                s, e = _CLOSED, 0
            elif state in (_OPEN_R, _OPEN_V, _OPEN_L):
                e |= _BEFORE  # no contraction: the apostrophe stands alone and the letters after it are a word
            to[state, c], emit[state, c] = s, e
    return to, emit


_TO, _EMIT = _word_transducer()
_CLASS_OF: list[np.ndarray] = []


def _class_of() -> np.ndarray:
    if not _CLASS_OF:
        try:
            import regex

            every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
            found = {name: [ord(x) for x in regex.findall(p, every)] for name, p in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"))}
        except ImportError:
            found = {_LETTER: [], _NUMBER: []}
            for x in range(0x110000):
                c = unicodedata.category(chr(x))[0]
                if c in "LN":
                    found[_LETTER if c == "L" else _NUMBER].append(x)
        table = np.full(0x110001, _OTHER, np.uint8)
        table[found[_LETTER]], table[found[_NUMBER]], table[_WHITE_SPACE] = _LETTER, _NUMBER, _WHITE
        for c, chars in ((_SPACE, " "), (_APOSTROPHE, "'"), (_STMD, "stmd"), (_R, "r"), (_V, "v"), (_L, "l"), (_E, "e")):
            table[[ord(x) for x in chars]] = c
        table[0x110000] = _END
        _CLASS_OF.append(table)
    return _CLASS_OF[0]


def scan_states(classes: np.ndarray, chunk: int = _CHUNK) -> np.ndarray:
    """The word transducer's state before each character of one long row of classes, by chunk maps and a prefix scan."""
    n = len(classes)
    rows = max(1, -(-n // chunk))
    padded = np.full(rows * chunk, _END, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(rows, chunk).T)
    flat = _TO.ravel()
    maps = np.repeat(np.arange(13, dtype=np.uint16)[:, None], rows, axis=1)
    for j in range(chunk):
        maps = flat[maps * np.uint16(12) + columns[j]].astype(np.uint16)
        if j % 64 == 63 and (maps == maps[0]).all():  # every entry state has led to the same one: the rest is one run
            one = maps[0]
            for i in range(j + 1, chunk):
                one = flat[one * np.uint16(12) + columns[i]].astype(np.uint16)
            maps = np.repeat(one[None], 13, axis=0)
            break
    step = 1
    while step < rows:  # inclusive prefix scan of composed maps
        later = maps[:, step:]
        maps = np.concatenate([maps[:, :step], np.take_along_axis(later, maps[:, :-step].astype(np.int64), axis=0)], axis=1)
        step *= 2
    state = np.concatenate([np.array([_START], np.uint16), maps[_START, :-1]])
    before = np.empty((chunk, rows), np.uint8)
    for j in range(chunk):
        before[j] = state
        state = flat[state * np.uint16(12) + columns[j]].astype(np.uint16)
    return np.ascontiguousarray(before.T).ravel()[:n]


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Mask of the characters at which a pre-token begins. Texts follow one another, an end class after each."""
    emit = _EMIT.ravel()[scan_states(classes).astype(np.uint16) * np.uint16(12) + classes]
    out = (emit & _HERE).astype(bool)
    out[:-1] |= (emit[1:] & _BEFORE).astype(bool)
    return out


class TokenTransducer:
    """Byte-pair merging as a lazily compiled transducer over the bytes of a pre-token."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, printable = spec["model"], {}
        extra = 0
        for b in range(256):  # byte-level vocabularies write each byte as a printable character
            if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
                printable[chr(b)] = b
            else:
                printable[chr(256 + extra)] = b
                extra += 1
        raw = lambda s: bytes(printable[c] for c in s)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.special = [x["content"] for x in spec["added_tokens"]]
        tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in self.rank}
        self.tokens = {t for t in tokens if self.merged(t) == (t,)}
        self.open = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.longest = max(map(len, self.tokens))
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.restart()

    def restart(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.to = np.full((1024, 256), -1, np.int32)
        self.emit = np.zeros((1024, 256), np.int8)
        self.state((b"", True, (b"",), (0,)))

    def state(self, key: tuple) -> int:
        if (i := self.ids.get(key)) is None:
            i = self.ids[key] = len(self.states)
            self.states.append(key)
            if i == len(self.to):
                more = min(i, 32_768)
                self.to = np.concatenate([self.to, np.full((more, 256), -1, np.int32)])
                self.emit = np.concatenate([self.emit, np.zeros((more, 256), np.int8)])
        return i

    def merged(self, data: bytes) -> tuple[bytes, ...]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.rank.get((parts[i], parts[i + 1]), 1 << 60), i))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return tuple(parts)

    def fit(self, left: bytes, right: bytes) -> bool:
        """Two tokens may follow one another in an encoding just when merging their bytes gives them back."""
        if (known := self.fits.get((left, right))) is None:
            known = self.fits[left, right] = self.merged(left + right) == (left, right)
        return known

    def compile(self, state: int, byte: int) -> None:
        """A state: the open bytes s, whether the pre-token began with them, and for each place from the start of s to now
        the last token of the encoding up to there and its count less the count now."""
        s, first, last, count = self.states[state]
        s += bytes([byte])
        for i in range(len(s)):  # the longest token whose left neighbour allows it; exactly one does
            t = s[i:]
            if t in self.tokens and ((first and i == 0) or (last[i] and self.fit(last[i], t))):
                break
        else:
            raise ValueError(f"no encoding of {s!r}")
        change = count[i] + 1
        last, count = (*last, t), (*(c - change for c in count), 0)
        keep = 0  # from here on s may be the beginning of a token
        while keep < len(s) and s[keep:] not in self.open:
            keep += 1
        s, first, last, count = s[keep:], first and keep == 0, last[keep:], count[keep:]
        seen = [i == len(s) or s[i:] in self.open for i in range(len(s) + 1)]  # elsewhere no later token can begin
        last = tuple(t if x else b"" for t, x in zip(last, seen, strict=True))
        count = tuple(c if x else 0 for c, x in zip(count, seen, strict=True))
        to = self.state((s, first, last, count))
        self.to[state, byte], self.emit[state, byte] = to, change

    def count(self, data: np.ndarray, starts: np.ndarray, lanes: int = 4096) -> np.ndarray:
        """Emitted tokens at each byte, cumulated over all bytes: total[i] counts what the first i bytes emit, exact at every
        pre-token's end. starts: mask of first bytes, true at 0. Lanes begin at starts, so their maps need no entry state."""
        n = len(data)
        if len(self.states) > _MOST_STATES:
            self.restart()
        at = np.flatnonzero(starts)
        cuts = at[np.unique(np.searchsorted(at, np.arange(0, n, max(64, n // lanes)), side="right") - 1)]
        length = np.diff(np.append(cuts, n))
        order = np.argsort(-length, kind="stable")
        begin, length = cuts[order], length[order]
        emitted = np.zeros(n, np.int8)
        state = np.zeros(len(begin), np.int64)
        alive = len(begin)
        for j in range(int(length[0]) if n else 0):
            while length[alive - 1] <= j:
                alive -= 1
            i = begin[:alive] + j
            b = data[i]
            now = np.where(starts[i], 0, state[:alive])
            to = self.to[now, b]
            if (missing := to < 0).any():
                for x in np.unique(now[missing] * 256 + b[missing]).tolist():
                    if self.to[x >> 8, x & 255] < 0:
                        self.compile(x >> 8, x & 255)
                to = self.to[now, b]
            emitted[i] = self.emit[now, b]
            state[:alive] = to
        return np.concatenate([np.zeros(1, np.int64), np.cumsum(emitted, dtype=np.int64)])


_COMPILED: dict[str, TokenTransducer] = {}


def transducer(path: str) -> TokenTransducer:
    if path not in _COMPILED:
        _COMPILED[path] = TokenTransducer(path)
    return _COMPILED[path]


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Tokens of each text as the library counts them; special strings inside a text are one token each."""
    machine = transducer(path)
    parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        own = [t]
        for mark in machine.special:
            if mark in t:
                split = [p.split(mark) for p in own]
                extra[i] += sum(len(p) - 1 for p in split)
                own = [x for p in split for x in p]
        parts += own
        owner += [i] * len(own)
    if not parts:
        return []
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths)
    classes = np.full(len(code) + len(parts), _END, np.uint8)
    place = np.ones(len(classes), bool)
    place[ends + np.arange(len(parts))] = False  # each text is followed by an end
    classes[place] = _class_of()[code]
    starts = word_starts(classes)[place]
    wide = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    offset = np.concatenate([np.zeros(1, np.int64), np.cumsum(wide)])
    data = np.frombuffer("".join(parts).encode("utf-8", "surrogatepass"), np.uint8)
    mask = np.zeros(len(data), bool)
    mask[offset[:-1][starts]] = True
    total = machine.count(data, mask)
    bounds = total[offset[np.concatenate([np.zeros(1, np.int64), ends])]]
    np.add.at(extra, owner, np.diff(bounds))
    return extra.tolist()


def token_counts(documents: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row. Null text: empty; no token.

    Repeated rows are counted each; a null doc_id stays null; a text of any length is read whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            counts, part, chars = [], [], 0
            for t in texts:
                if part and chars + len(t) > _CHARS_AT_ONCE:
                    counts += count_tokens(part, path)
                    part, chars = [], 0
                part.append(t)
                chars += len(t)
            counts += count_tokens(part, path)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts], "n_tokens": counts, "over_limit": [c > limit for c in counts]})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
