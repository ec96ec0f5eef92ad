"""Vectorised text kernels over Arrow string buffers (numpy only, no per-word Python)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POW = [np.ones(1, U64), np.ones(1, U64)]
#: Bytes of text worked on at a time; a longer document is worked on alone.
SLICE = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2^64, at least n + 1 of each."""
    if len(_POW[0]) <= n:
        size = max(n + 1, 1 << 18)
        for k, b in enumerate((_BASE, _INV)):
            x = np.full(size, b, U64)
            x[0] = 1
            _POW[k] = np.cumprod(x, dtype=U64)
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as the empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    kind = np.dtype(np.int64 if wide else np.int32)
    _, offs, data = arr.buffers()
    if len(arr) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    off = np.frombuffer(offs, kind, len(arr) + 1, arr.offset * kind.itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most limit bytes together, one document at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some documents, as byte spans with 64-bit hashes."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        n = len(data)
        space = SPACE[data]
        inner = np.concatenate([[True], space]) if n else np.ones(1, bool)
        inner[off[:-1]] = True  # a document's first byte follows a break
        start = inner[:n] & ~space
        after = np.concatenate([space, [True]]) if n else np.ones(1, bool)
        after[off] = True
        end = after[1:] & ~space
        self.s, self.e = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.s, off)  # of each document, the index of its first word
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.n)
        pw, _ = powers(n)
        self.prefix = np.zeros(n + 1, U64)
        if n:
            np.cumsum(_BYTE[data] * pw[:n], out=self.prefix[1:])
        self.space = space

    def spans(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Hashes of byte spans."""
        _, inv = powers(len(self.data))
        return mix((self.prefix[e] - self.prefix[s]) * inv[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self.spans(self.s, self.e)

    def sums(self, flag: np.ndarray) -> np.ndarray:
        """Per document, how many bytes are flagged."""
        c = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=c[1:])
        return c[self.off[1:]] - c[self.off[:-1]]


def rolling(h: np.ndarray) -> np.ndarray:
    """Prefix sums from which range_hash takes the hash of any range of items."""
    pw, _ = powers(len(h))
    out = np.zeros(len(h) + 1, U64)
    np.cumsum(h * pw[: len(h)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    _, inv = powers(len(prefix))
    return mix((prefix[e] - prefix[s]) * inv[s] + (e - s).astype(U64))


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more; does an equal one come earlier."""
    if not len(key):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def cover(starts: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places are covered by the ranges."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + length, -1)
    return np.cumsum(d[:-1]) > 0


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
