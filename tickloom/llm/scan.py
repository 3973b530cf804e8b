"""Whole texts as NumPy arrays inside tasks: words, lines and word windows of an Arrow string column.

Texts are read as UTF-8 bytes. One batch is cut into blocks of whole texts of about BLOCK_BYTES (a longer text is a
block of its own), so memory is bounded by the longest text. Words get 64-bit polynomial hashes over a random byte
table, windows get 64-bit hashes of their words' hashes. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_U = np.uint64
_RNG = np.random.default_rng(0x5EED)
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_P = _U(0x9E3779B97F4A7C15)
_P_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = _U(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[65:91] += 32

#: Bytes of a word by white space: [^\x20\x09-\x0D]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of a word by letters and digits, after lower-casing: [^\x00-\x2F\x3A-\x60\x7B-\x7F]
LETTERS = np.ones(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    LETTERS[_a : _b + 1] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        out = []
        for base in (_P, _P_INV):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        if size > 4 * BLOCK_BYTES:  # one very long text: not kept
            return out[0], out[1]
        _powers["p"], _powers["i"] = out
    return _powers["p"], _powers["i"]


class Block:
    """Some whole texts: bytes, and where each text starts (offs has one more entry than there are texts)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, first: int):
        self.raw, self.offs, self.first, self.n = data, offs, first, len(offs) - 1
        self._sums: tuple[int, np.ndarray] | None = None

    def text(self, i: int) -> str:
        return self.raw[self.offs[i] : self.offs[i + 1]].tobytes().decode("utf-8", "replace")

    def sums(self, fold: np.ndarray = IDENTITY) -> np.ndarray:
        """Prefix sums from which hashes() takes the hash of any byte range."""
        if self._sums is None or self._sums[0] != id(fold):
            p, _ = _power(len(self.raw) + 1)
            out = np.zeros(len(self.raw) + 1, np.uint64)
            np.cumsum(_TABLE[fold][self.raw] * p[: len(self.raw)], out=out[1:])
            self._sums = (id(fold), out)
        return self._sums[1]

    def hashes(self, s: np.ndarray, e: np.ndarray, fold: np.ndarray = IDENTITY) -> np.ndarray:
        c = self.sums(fold)
        _, inv = _power(len(self.raw) + 1)
        return mix((c[e] - c[s]) * inv[s] + (e - s).astype(np.uint64) * _Q)

    def words(self, kind: np.ndarray, fold: np.ndarray = IDENTITY) -> "Words":
        """kind: table of the bytes that belong to words, asked after fold."""
        inside = kind[fold][self.raw]
        edge = np.zeros(len(self.raw) + 1, bool)
        edge[self.offs] = True  # a word ends where its text ends
        before = np.empty(len(inside), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        s = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(len(inside), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        e = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return Words(self, s, e, fold)


class Words:
    """Words of a block in order: byte ranges s, e; text number doc; word range of text i: at[i] to at[i + 1]."""

    def __init__(self, block: Block, s: np.ndarray, e: np.ndarray, fold: np.ndarray):
        self.block, self.s, self.e, self.fold = block, s, e, fold
        self.at = np.searchsorted(s, block.offs)
        self.count = np.diff(self.at)
        self.doc = np.repeat(np.arange(block.n), self.count)
        self._h: np.ndarray | None = None

    @property
    def h(self) -> np.ndarray:
        if self._h is None:
            self._h = self.block.hashes(self.s, self.e, self.fold)
        return self._h

    def windows(self, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every k consecutive words of one text; short: the whole of a text of fewer words,
        but not none, counts as one window."""
        h, n = self.h, len(self.s)
        left = self.at[self.doc + 1] - np.arange(n)  # words of the text from here on
        first = np.flatnonzero(left >= k)
        out = np.full(len(first), k, np.uint64)
        for j in range(k):
            out = (out ^ h[first + j]) * _Q
            out ^= out >> _U(29)
        if short and len(few := np.flatnonzero((self.count > 0) & (self.count < k))):
            more = np.empty(len(few), np.uint64)
            for i, d in enumerate(few):
                x = _U(self.count[d])
                with np.errstate(over="ignore"):
                    for y in h[self.at[d] : self.at[d + 1]]:
                        x = (x ^ y) * _Q
                        x ^= x >> _U(29)
                more[i] = x
            first, out = np.concatenate([first, self.at[few]]), np.concatenate([out, more])
            order = np.argsort(first, kind="stable")
            first, out = first[order], out[order]
        return first, mix(out)


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of the texts of one Arrow column, in order; first: the row of a block's first text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offs = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1))
        yield Block(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i], i)
        i = j


def per_text(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by text number, as int64."""
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64) if len(doc) else np.zeros(n, np.int64)


def word_hash(word: str) -> int:
    """The hash that Words.h has for this word."""
    b = word.encode()
    block = Block(np.frombuffer(b, np.uint8), np.array([0, len(b)]), 0)
    return int(block.hashes(np.array([0]), np.array([len(b)]))[0])
