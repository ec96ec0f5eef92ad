"""All keys of a dictionary in one compact file, which every Python worker maps into memory.

Spark hashes, sorts and packs the keys in parts; the driver appends one packed part after the
other to a file and hands it out with ``addFile``, so it never holds a dictionary, executors get
the file once each, and the workers of a machine share its pages. There is no limit on the number
of keys, and a text is read once whatever their number.

The file has the sorted hashes of all keys with their texts and concepts, and the sorted hashes of
the first two pieces of keys that have several, each with a mask of how many pieces those keys
have. A piece ends before a character that is no letter, digit or underscore (in Chinese, after
every character), so a key of n pieces found in a text has n pieces there. A bitmap for each of
the two lists rules most of a text's spans out by one look.
"""

from __future__ import annotations

import functools
import json
import os
import shutil
import tempfile
import unicodedata
import uuid
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)
#: Code points from here on are neither letters nor digits, and fold to themselves.
PLANES = 0x40000
#: Bits of a bitmap for each entry; entries of a packed part.
BITS, PART = 16, 1 << 16
#: So many parts whatever their size, and one more for each million keys, as each is a job of its own.
PARTS = 256
#: Keys of so many pieces or more share a bit of a mask.
MANY = 63
ARRAYS = {"hash": np.int64, "key_end": np.int64, "keys": np.uint8, "who_end": np.int64, "who": np.uint8, "seen": np.uint8, "head": np.int64, "mask": np.int64, "most": np.int32, "head_seen": np.uint8}


@functools.cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it belongs to a word, and the length of its folding."""
    word, size = np.zeros(PLANES + 1, bool), np.ones(PLANES + 1, np.uint8)
    for k in range(PLANES):
        c = chr(k)
        word[k] = c == "_" or unicodedata.category(c)[0] in "LN"
        size[k] = len(c.casefold())
    return word, size


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def in_words(points: np.ndarray) -> np.ndarray:
    return characters()[0][np.minimum(points, PLANES)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) <= n:
        for k, b in enumerate((_ODD, _BACK)):
            x = np.full(max(n + 1, 1 << 18), b, U)
            x[0] = 1
            _POWERS[k] = np.cumprod(x, dtype=U)
    return _POWERS


@functools.cache
def language_seed(lang: str, salt: int) -> int:
    return int.from_bytes(blake2b(f"{salt}:{lang}".encode(), digest_size=8).digest(), "little")


class SpanHashes:
    """63-bit hashes of any spans of a string of code points, from running sums."""

    def __init__(self, points: np.ndarray):
        power, self.back = _powers(len(points))
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(_mix(points.astype(U) + U(_ODD)) * power[: len(points)], dtype=U)])

    def of(self, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
        return (_mix((self.sums[end] - self.sums[start]) * self.back[start] ^ seed) >> U(1)).astype(np.int64)


def piece_ends(points: np.ndarray, first: np.ndarray, every: np.ndarray) -> np.ndarray:
    """Whether a piece ends after each code point of strings that begin at first; of those in every, after all."""
    cut = np.ones(len(points), bool)
    cut[:-1] = ~in_words(points[1:])
    cut[first[1:][first[1:] > 0] - 1] = True
    return cut | every


def key_hashes(langs: list[str], keys: list[str], salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of pieces, hash of the first two pieces) of keys, none of them empty."""
    points = code_points("".join(keys))
    first = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    zh = np.repeat(np.array([x == "zh" for x in langs], bool), np.diff(first))
    ends = np.flatnonzero(piece_ends(points, first, zh)) + 1
    at = np.searchsorted(ends, first, "right")
    pieces = np.diff(at)
    h = SpanHashes(points)
    seed = np.array([language_seed(x, salt) for x in langs], U)
    second = ends[np.minimum(at[:-1] + 1, len(ends) - 1)]
    head = h.of(first[:-1], np.where(pieces > 1, second, first[1:]), ~seed)
    return h.of(first[:-1], first[1:], seed), pieces, head


class Index:
    """The arrays, in memory or mapped."""

    def __init__(self, arrays: dict[str, np.ndarray], salt: int):
        self.salt = salt
        self.__dict__.update(arrays)
        self.most_pieces = int(self.most.max()) if len(self.most) else 1
        self.texts: dict[int, tuple[str, tuple[str, ...]]] = {}

    def entry(self, k: int) -> tuple[str, tuple[str, ...]]:
        """The text and the concepts of a key."""
        found = self.texts.get(k)
        if found is None:
            a, b = (int(self.key_end[k - 1]), int(self.who_end[k - 1])) if k else (0, 0)
            text, who = self.keys[a : self.key_end[k]].tobytes().decode(), self.who[b : self.who_end[k]].tobytes().decode()
            if len(self.texts) > 1 << 17:
                self.texts.clear()
            found = self.texts[k] = (text, tuple(json.loads(who)))
        return found

    @staticmethod
    def _find(sought: np.ndarray, listed: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the sought hashes are listed, and where."""
        if not len(listed):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bit = sought >> (63 - int(len(seen) * 8 - 1).bit_length())
        some = np.flatnonzero((seen[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
        at = np.minimum(np.searchsorted(listed, sought[some]), len(listed) - 1)
        same = listed[at] == sought[some]
        return some[same], at[same]

    def find(self, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._find(sought, self.hash, self.seen)

    def has(self, lang: str, key: str) -> bool:
        """Whether a key is there."""
        some, at = self.find(key_hashes([lang], [key], self.salt)[0])
        return bool(len(some)) and self.entry(int(at[0]))[0] == key

    def find_head(self, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._find(sought, self.head, self.head_seen)


class Collision(Exception):
    """Two keys have one hash: another salt is needed."""


class _Writer:
    """Arrays that grow by parts, each in a file."""

    def __init__(self, folder: str, keys: int, heads: int):
        self.files = {n: open(os.path.join(folder, n), "wb") for n in ARRAYS if not n.endswith("seen")}
        self.bitmaps = {n: np.zeros(max(128, 1 << (BITS * m - 1).bit_length()) // 8 if m else 16, np.uint8) for n, m in (("seen", keys), ("head_seen", heads))}
        self.ends = {"key_end": 0, "who_end": 0}
        self.last = {"hash": -1, "head": -1}

    def _hashes(self, name: str, raw: bytes, bitmap: str) -> None:
        h = np.frombuffer(raw, np.int64)
        if (np.diff(h) == 0).any() or h[0] == self.last[name]:
            raise Collision
        self.last[name] = h[-1]
        bits = self.bitmaps[bitmap]
        at = h >> (63 - int(len(bits) * 8 - 1).bit_length())
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        self.files[name].write(raw)

    def keys(self, r) -> None:
        self._hashes("hash", r["hash"], "seen")
        for end, data in (("key_end", "keys"), ("who_end", "who")):
            ends = self.ends[end] + np.cumsum(np.frombuffer(r[end], np.int64))
            self.ends[end] = int(ends[-1])
            self.files[end].write(ends.tobytes())
            self.files[data].write(r[data])

    def heads(self, r) -> None:
        self._hashes("head", r["head"], "head_seen")
        self.files["mask"].write(r["mask"])
        self.files["most"].write(r["most"])

    def close(self, path: str, folder: str, salt: int) -> None:
        """All arrays one after the other, with a header that says where."""
        for f in self.files.values():
            f.close()
        for n, bits in self.bitmaps.items():
            bits.tofile(os.path.join(folder, n))
        at, where = 4096, {}
        for n in ARRAYS:
            size = os.path.getsize(os.path.join(folder, n))
            where[n] = [at, size]
            at += -(-size // 64) * 64
        with open(path, "wb") as out:
            out.write(json.dumps({"salt": salt, "arrays": where}).encode().ljust(4096))
            for n in ARRAYS:
                out.seek(where[n][0])
                with open(os.path.join(folder, n), "rb") as f:
                    shutil.copyfileobj(f, out)
            out.truncate(at)


def _pack_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (hash, key, who) as rows of packed arrays."""
    for b in batches:
        for a in range(0, b.num_rows, PART):
            c = b.slice(a, PART)
            row = {"hash": c.column("hash").to_numpy().astype(np.int64).tobytes()}
            for end, data in (("key_end", "keys"), ("who_end", "who")):
                raw = [x.encode() for x in c.column(data).to_pylist()]
                row |= {end: np.array([len(x) for x in raw], np.int64).tobytes(), data: b"".join(raw)}
            yield pa.RecordBatch.from_pylist([row])


def _pack_heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_pylist([{n: b.column(n).to_numpy().astype(ARRAYS[n]).tobytes() for n in ("head", "mask", "most")}])


def _hashed(rows: DataFrame, salt: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                h, n, head = key_hashes(b.column(0).to_pylist(), b.column(1).to_pylist(), salt)
                yield pa.RecordBatch.from_arrays([pa.array(h), b.column(1), b.column(2), pa.array(n, pa.int32()), pa.array(head)], names=["hash", "keys", "who", "pieces", "head"])

    return rows.mapInArrow(run, "hash long, keys string, who string, pieces int, head long")


def part_count(keys: int, part_keys: int) -> int:
    return 1 + min(keys // max(1, part_keys), PARTS + (keys >> 20))


def _write(keyed: DataFrame, path: str, folder: str, part_keys: int, salt: int) -> None:
    n, several = keyed.agg(F.count("*"), F.count_distinct(F.when(F.col("pieces") > 1, F.col("head")))).first()
    parts = part_count(n, part_keys)
    w = _Writer(folder, n, several)
    if n:
        spread = keyed.select("hash", "keys", "who").repartitionByRange(parts, "hash").sortWithinPartitions("hash")
        for r in spread.mapInArrow(_pack_keys, "hash binary, key_end binary, keys binary, who_end binary, who binary").toLocalIterator():
            w.keys(r)
    if several:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.least("pieces", F.lit(MANY)))
        heads = keyed.where("pieces > 1").groupBy("head").agg(F.bit_or(bit).alias("mask"), F.max("pieces").alias("most"))
        spread = heads.repartitionByRange(parts, "head").sortWithinPartitions("head")
        for r in spread.mapInArrow(_pack_heads, "head binary, mask binary, most binary").toLocalIterator():
            w.heads(r)
    w.close(path, folder, salt)


def publish(dictionary: DataFrame, part_keys: int = 1 << 20) -> str:
    """The name under which the index of a dictionary (lang, key, chebi_id, reg_order) is among the application's files."""
    spark = dictionary.sparkSession
    ship(spark)
    who = F.transform(F.sort_array(F.collect_list(F.struct("reg_order", "chebi_id"))), lambda s: s["chebi_id"])
    rows = dictionary.where("lang is not null and length(key) > 0").groupBy("lang", "key").agg(F.to_json(who).alias("who"))
    name = f"polylex-keys-{uuid.uuid4().hex}"
    for salt in range(8):
        keyed = _hashed(rows, salt).persist()
        try:
            path = os.path.join(tempfile.mkdtemp(prefix="polylex-keys-"), name)
            with tempfile.TemporaryDirectory(prefix="polylex-keys-") as folder:
                _write(keyed, path, folder, part_keys, salt)
            break
        except Collision:
            continue
        finally:
            keyed.unpersist()
    else:
        raise RuntimeError("keys collide under every salt")
    spark.sparkContext.addFile(path)
    return name


def read(path: str) -> Index:
    with open(path, "rb") as f:
        header = json.loads(f.read(4096))
    whole = np.memmap(path, np.uint8, "r")
    return Index({n: whole[a : a + size].view(ARRAYS[n]) for n, (a, size) in header["arrays"].items()}, header["salt"])


@functools.lru_cache(maxsize=4)
def opened(name: str) -> Index:
    """The index among the application's files, once for each worker."""
    return read(SparkFiles.get(name))


def of_rows(rows: Iterable[tuple[str, str, str]], salt: int = 0) -> Index:
    """An index in memory of (lang, key, concept), a key's concepts in their order."""
    known: dict[tuple[str, str], list[str]] = {}
    for lang, key, concept in rows:
        if key:
            known.setdefault((lang, key), []).append(concept)
    with tempfile.TemporaryDirectory(prefix="polylex-keys-") as folder:
        names = list(known)
        h, n, head = key_hashes([x for x, _ in names], [k for _, k in names], salt) if names else (np.zeros(0, np.int64),) * 3
        order = np.argsort(h)
        heads = sorted(set(head[n > 1].tolist()))
        w = _Writer(folder, len(names), len(heads))
        if names:
            listed = [names[k] for k in order]
            batch = pa.RecordBatch.from_arrays([pa.array(h[order]), pa.array([k for _, k in listed]), pa.array([json.dumps(known[x]) for x in listed])], names=["hash", "keys", "who"])
            for b in _pack_keys([batch]):
                w.keys(b.to_pylist()[0])
        if heads:
            own = [n[(head == x) & (n > 1)].tolist() for x in heads]
            masks = [functools.reduce(lambda a, b: a | 1 << min(b, MANY), x, 0) for x in own]
            batch = pa.RecordBatch.from_arrays([pa.array(heads), pa.array(np.array(masks, np.uint64).view(np.int64)), pa.array([max(x) for x in own], pa.int32())], names=["head", "mask", "most"])
            for b in _pack_heads([batch]):
                w.heads(b.to_pylist()[0])
        path = os.path.join(folder, "index")
        w.close(path, folder, salt)
        with open(path, "rb") as f:
            header, raw = json.loads(f.read(4096)), np.fromfile(path, np.uint8)
    return Index({k: raw[a : a + size].view(ARRAYS[k]) for k, (a, size) in header["arrays"].items()}, salt)
