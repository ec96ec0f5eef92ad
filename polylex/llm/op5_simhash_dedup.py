"""SimHash fingerprints, compared through vertical bit planes, and their components.

A fingerprint has a bit where over half of the shingles' XXH64 values (seed 42) have it.
Equal fingerprints are one node. Two fingerprints within RADIUS bits agree on at least two
of the ``RADIUS + 2`` blocks into which the 64 bits are cut, so they meet in the bucket of
one of the block pairs: no link is lost. Rows of a bucket are stored as 64 bit planes of
64-lane words. A fingerprint is compared with 64 others at a time: each plane, flipped
where its own bit is set, goes into carry-save counters, and a word is abandoned as soon as
every lane has passed the radius. A bucket of many rows is cut into cells (components.deal).
Cells give only links that connect, not all pairs.

Defined cases: null or empty text has fingerprint zero and links like any other; a text of
fewer words than a shingle is one shingle. Rows that share an id are rows of their own, each
with its own fingerprint's links. A row with a null id gets the component of its fingerprint's least other id, or null, and
never links. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import cells, deal, edges_of, hot_limit, labels, roots, spread_join
from .kernels import U64, Words, slices, text_buffer
from .scratch import Scratch

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Rows of one bucket that are compared in one cell.
CELL = 8192
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Each value of a byte with its bits spread over eight bytes.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def shingle_spans(w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each shingle; a shorter document's only one is all its words."""
    last = w.first[1:][w.doc]
    at = np.arange(len(w.s))
    full = at[at + shingle <= last]
    short = w.first[:-1][(w.n > 0) & (w.n < shingle)]
    lo = np.sort(np.concatenate([full, short]))
    return lo, np.minimum(lo + shingle, last[lo] if len(lo) else lo)


def single_spaced(w: Words) -> tuple[bytes, np.ndarray]:
    """The words joined by a space, and where each begins."""
    lens = w.e - w.s
    pos = np.concatenate([[0], np.cumsum(lens + 1)])
    flat = np.full(int(pos[-1]), 32, np.uint8)
    flat[np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)] = w.data[~w.space]
    return flat.tobytes(), pos


def shingle_hashes(w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle of lower-cased words, and its document."""
    flat, pos = single_spaced(w)
    lo, hi = shingle_spans(w, shingle)
    take = xxhash.xxh64_digest
    raw = b"".join([take(flat[x:y], SEED) for x, y in zip(pos[lo].tolist(), (pos[hi] - 1).tolist(), strict=True)])
    return np.frombuffer(raw, ">u8").astype("<u8"), w.doc[lo]


def majority(h: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Each document's bits that over half of its hashes have; zero without hashes."""
    out = np.zeros(docs, U64)
    if not len(h):
        return out
    spread = _SPREAD[h.view(np.uint8).reshape(-1, 8)]
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    n = np.diff(np.append(first, len(doc)))
    per = -(-n // 255)  # a byte counts to 255
    seg_doc = np.repeat(np.arange(len(n)), per)
    seg = first[seg_doc] + 255 * (np.arange(len(seg_doc)) - np.repeat(np.cumsum(per) - per, per))
    counts = np.add.reduceat(np.add.reduceat(spread, seg, axis=0).view(np.uint8).astype(np.int64), np.cumsum(per) - per, axis=0)
    out[doc[first]] = np.packbits(2 * counts > n[:, None], axis=1, bitorder="little").view(U64).ravel()
    return out


def _fingerprint(data: np.ndarray, off: np.ndarray, shingle: int) -> np.ndarray:
    return majority(*shingle_hashes(Words(_LOWER[data], off), shingle), len(off) - 1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc, fp) of docs (doc, text): one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(1))
            parts = [_fingerprint(data[off[i] : off[j]], off[i : j + 1] - off[i], shingle) for i, j in slices(off)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(parts).view(np.int64) if parts else [], pa.int64())], names=["doc", "fp"])

    return docs.mapInArrow(run, "doc long, fp long")


class Planes:
    """Bit planes of sorted cells: a cell takes whole 64-lane words. fp: a row of 64-bit integers for each fingerprint."""

    def __init__(self, fp: np.ndarray, edge: np.ndarray):
        size = np.diff(edge)
        words = -(-size // 64)
        self.first = np.concatenate([[0], np.cumsum(words)])  # of each cell
        cell = np.repeat(np.arange(len(size)), size)
        self.slot = self.first[cell] * 64 + np.arange(len(fp)) - edge[cell]
        self.cell, self.fp, total = cell, fp, int(self.first[-1])
        self.row = np.full(total * 64, -1)
        self.row[self.slot] = np.arange(len(fp))
        flat = np.zeros((fp.shape[1], total * 64), U64)
        flat[:, self.slot] = fp.T
        self.plane = [np.packbits(((x >> U64(k)) & U64(1)).astype(np.uint8), bitorder="little").view(U64) for x in flat for k in range(BITS)]
        self.valid = np.packbits(self.row >= 0, bitorder="little").view(U64)

    def near(self, q: np.ndarray, w: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, row) of q with the lanes of word w, of fewer than 2 ** levels differing bits."""
        mine, idx = self.fp[q], np.arange(len(q))
        count = [np.zeros(len(q), U64) for _ in range(levels)]
        over = ~self.valid[w]
        for k, plane in enumerate(self.plane):
            carry = plane[w] ^ (U64(0) - ((mine[:, k // BITS] >> U64(k % BITS)) & U64(1)))
            for c in count:
                c ^= carry
                carry &= ~c  # it was set and is now clear
            over |= carry
            if k % 8 == 7 and (live := over != U64(0xFFFFFFFFFFFFFFFF)).mean() < 0.8:
                idx, w, mine, over = idx[live], w[live], mine[live], over[live]
                count = [c[live] for c in count]
                if not len(idx):
                    break
        at, lane = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")) if len(idx) else (idx, idx)
        return q[idx[at]], self.row[w[at] * 64 + lane]


def near_pairs(fp: np.ndarray, edge: np.ndarray, levels: int, chunk: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same cell within the radius, some words at a time."""
    p = Planes(fp, edge)
    todo = p.first[p.cell + 1] - p.slot // 64  # words from the row's own on
    ends = np.cumsum(todo)
    a = 0
    while a < len(fp):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + chunk, "right")))
        q = np.repeat(np.arange(a, z), todo[a:z])
        w = p.slot[q] // 64 + np.arange(len(q)) - np.repeat(np.cumsum(todo[a:z]) - todo[a:z], todo[a:z])
        i, j = p.near(q, w, levels)
        yield i[i < j], j[i < j]
        a = z


def _block_keys(bits: int, tables: list[tuple[int, ...]], blocks: list[tuple[int, int]]) -> list:
    """A key for each table: its number, and the bits of its blocks."""
    out = []
    for t, table in enumerate(tables):
        key = F.lit(t).cast("long")
        for b in table:
            lo, width = blocks[b]
            part = F.call_function("shiftrightunsigned", F.col("fp"), F.lit(lo)).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.call_function("shiftleft", key, F.lit(width)).bitwiseOR(part)
        out.append(key)
    return out


def _links(nodes: DataFrame, keys: list, levels: int, cell: int) -> DataFrame:
    """(a, b): links that connect the fingerprints that are near in any bucket; nodes (fp)."""
    rows = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    dealt = deal(rows, "key", "fp", cell).select("key", "one", "two", "part", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches, ("key", "one", "two"), 1 << 16):
            key, one, two, part, fp = (t.column(c).to_numpy(zero_copy_only=False) for c in t.schema.names)
            edge = edges_of(key, one, two)
            many = np.repeat(np.diff(edge) > 1, np.diff(edge))
            if not many.any():
                continue
            one, two, part, fp = one[many], two[many], part[many], fp[many]
            edge = edges_of(key[many], one, two)
            found = [np.zeros((2, 0), np.int64)]
            for i, j in near_pairs(fp.view(U64)[:, None], edge, levels):
                meant = (one[i] == two[i]) | (part[i] != part[j])
                i, j = i[meant], j[meant]
                root = roots(len(fp), i, j)
                tied = np.unique(np.concatenate([i, j]))
                found.append(np.stack([tied, root[tied]]))
            i, j = np.concatenate(found, axis=1)
            root = roots(len(fp), i, j)
            tied = np.flatnonzero(root != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[tied]), pa.array(fp[root[tied]])], names=["a", "b"])

    return dealt.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two").mapInArrow(run, "a long, b long")


def near_links(nodes: DataFrame, cell: int = CELL) -> DataFrame:
    """(a, b): links that connect the fingerprints of nodes (fp, each once) that differ in RADIUS or fewer bits; nodes are read twice."""
    cuts = [BITS * k // (RADIUS + 2) for k in range(RADIUS + 3)]
    blocks = [(a, b - a) for a, b in itertools.pairwise(cuts)]
    keys = _block_keys(BITS, list(itertools.combinations(range(len(blocks)), 2)), blocks)
    return _links(nodes, keys, (RADIUS + 1).bit_length() - 1, cell)


def simhash_groups(df: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = SHINGLE, scratch: Scratch | None = None, cell: int = CELL) -> DataFrame:
    """(doc, fp, component) of every row, linking at RADIUS or fewer differing bits."""
    scratch = scratch or Scratch(df.sparkSession, "op5")
    docs = df.select(F.col(doc).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    fps = scratch.settle(fingerprints(docs, shingle), "fingerprints")
    nodes = scratch.settle(fps.where("doc is not null").groupBy("fp").agg(F.min("doc").alias("own"), F.count("*").alias("n")), "nodes")
    known = labels(nodes.withColumnRenamed("fp", "node"), near_links(nodes, cell), scratch).select(F.col("node").alias("fp"), "n", "component")
    return spread_join(fps, known, "fp", "doc", hot_limit(fps.count()), "left").select("doc", "fp", "component")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
