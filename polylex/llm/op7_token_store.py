"""Token ids in checksummed blocks, coded by an adaptive context-mixing range coder.

Documents, in ascending id order, are encoded and cut into blocks of whole documents. Every
block starts from a reset model and can be read alone. A block's ids are the leaves of a tree
with ``WAYS`` branches at a node (a Huffman code of the block's own counts, so a frequent id is
near the root), and coding an id is coding the branch at each node on its way. A branch is
predicted by three adaptive tables of frequencies: of the node alone (order 0), of the node
after the id before (order 1), and of the node after the two ids before (order 2; contexts by
hash). Their distributions are mixed by weights that adapt too, kept for each level of the
tree's depth, up to ``LEVELS``, and each state of how often the two longer contexts have been
seen. The range coder codes the branch by the mixture. In a block of fewer than ``SHORT`` ids the
code of its counts can cost more than it saves; there the tree of all ids at one depth is tried
too, which needs no table, and the smaller block is kept.

A block is coded in lanes, each a stretch of its ids with a coder of its own, all in step and
sharing the model: what step t of all lanes teaches is known at step t + 1. So coder and model
work on vectors. Frequencies are whole numbers below 2 ** 24 in single precision and all other
arithmetic on them is elementwise or sums in a fixed order, so both sides compute the same.

Block layout, little-endian: ``PLX3``, ids, documents, lanes, vocabulary, bytes of the packed
tables, crc32 of what follows (six unsigned 32-bit integers), then 64-bit document ids (null as
the least one), 32-bit token counts, the tables (by zlib: 32-bit lengths of the lanes' streams,
and the code lengths of the whole vocabulary as bytes, or none for the tree of one depth), and
the streams as 16-bit units. Files are Parquet with a row for each block, written and read by
Spark only, in the shared folder; (part, block) is their order, and a row says how many ids of
its part come before it. A part has ``PART_BYTES`` of text at least where the input has, so a
small table isn't cut into short blocks; ids that many rows share are cut between texts.

Defined cases: null and empty texts have the end id alone; a null id sorts first and reads
back as null; rows of one id follow each other in the order of their texts; an empty table
gives no blocks and an empty result. A document of any length is in one block.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .units import library_codec, text_slices

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
IDS = 50257
#: Ids after which a block ends with the document; lanes of a full block, and the least ids of a lane in a smaller one.
BLOCK, LANES, STEPS = 1 << 20, 4096, 256
#: Ids of a block below which the tree without a table is tried; bytes of text that a part has at least, some 700,000 ids.
SHORT, PART_BYTES = 1 << 16, 2 << 20
#: Weights and large totals are seen to in every so many steps.
SETTLE = 4
#: Branches at a node, and levels of the tree whose weights are kept apart.
WAYS, LEVELS = 16, 4
_MAGIC, _HEAD = b"PLX3", struct.Struct("<6I")
_F, _U = np.float32, np.uint64
#: Of the three tables: what a branch's frequency grows by, and the total beyond which a node's are halved.
_STEP = (_F(8), _F(16), _F(24))
_MOST = (_F(1 << 18), _F(1 << 14), _F(1 << 12))
_STATES = 8  # of how often a context has been seen
_HEAVY = 4096.0
_ONE = 1 << 16  # what the branches' widths add up to
_ROOM = _ONE - 2 * WAYS - 4  # of it, what the mixture deals out
_FULL = (1 << 48) - 1
_HALF, _TOP, _LOW = _U(16), _U(32), _U((1 << 32) - 1)
_SUM, _BELOW = np.ones(WAYS, _F), np.triu(np.ones((WAYS, WAYS), _F))


def code_lengths(count: np.ndarray) -> np.ndarray:
    """For each id, the depth of its leaf in the Huffman tree of these counts; 0 where the count is."""
    ids, out = np.flatnonzero(count), np.zeros(len(count), np.uint8)
    if len(ids) < 2:
        out[ids] = 1
        return out
    heap = [(int(c), k) for k, c in enumerate(count[ids])]
    heap += [(0, len(ids) + k) for k in range(-(len(ids) - 1) % (WAYS - 1))]  # leaves of no id fill the deepest node
    parent, leaves = [0] * len(heap), len(ids)
    heapq.heapify(heap)
    while len(heap) > 1:
        some = [heapq.heappop(heap) for _ in range(WAYS)]
        for _, k in some:
            parent[k] = len(parent)
        heapq.heappush(heap, (sum(c for c, _ in some), len(parent)))
        parent.append(0)
    depth = [0] * len(parent)
    for k in range(len(parent) - 2, -1, -1):
        depth[k] = depth[parent[k]] + 1
    out[ids] = depth[:leaves]
    return out


def even_lengths(vocabulary: int) -> np.ndarray:
    """All ids at one depth, whatever their counts."""
    depth = 1
    while WAYS**depth < vocabulary:
        depth += 1
    return np.full(vocabulary, depth, np.uint8)


class Tree:
    """The canonical code of some lengths: nodes and branches of each id by depth, and where branches lead."""

    def __init__(self, length: np.ndarray):
        ids = np.lexsort((np.arange(len(length)), length))
        ids = ids[length[ids] > 0]
        of = length[ids].astype(np.int64)
        self.length, self.depth = length, int(of.max(initial=0))
        code, first, at = np.zeros(len(ids), np.int64), 0, 0
        for d in range(1, self.depth + 1):
            n = int((of == d).sum())
            code[at : at + n] = first + np.arange(n)
            first, at = (first + n) * WAYS, at + n
        self.node = np.zeros((self.depth, len(length)), np.int64)
        self.way = np.zeros((self.depth, len(length)), np.int64)
        self.nodes = 0
        for d in range(self.depth):
            live = of > d
            rest = code[live] // WAYS ** (of[live] - d - 1)
            kinds, which = np.unique(rest // WAYS, return_inverse=True)
            self.node[d, ids[live]], self.way[d, ids[live]] = self.nodes + which, rest % WAYS
            self.nodes += len(kinds)
        self.next = np.full(self.nodes * WAYS, -1)  # a node, or -1 - id
        for d in range(self.depth):
            live = ids[of > d]
            last = self.length[live] == d + 1
            self.next[self.node[d, live] * WAYS + self.way[d, live]] = np.where(last, -1 - live, self.node[min(d + 1, self.depth - 1), live])


class Mixer:
    """The three tables of a block, and the weights of their predictions."""

    def __init__(self, nodes: int, ids: int):
        n = ids.bit_length()
        self.bits = (min(16, max(8, n - 4)), min(17, max(8, n - 3)))
        self.table = [np.ones((nodes, WAYS), _F), *(np.zeros((1 << b, WAYS), _F) for b in self.bits)]
        self.flat = [t.reshape(-1) for t in self.table]
        self.weight = np.full((LEVELS, 3, _STATES * _STATES), 2.0)
        self.share = [self._share(w) for w in self.weight]

    @staticmethod
    def _share(weight: np.ndarray) -> np.ndarray:
        return (weight * (_ROOM / (weight[0] + weight[1] + weight[2]))).astype(_F)

    def predict(self, level: int, node: np.ndarray, key1: np.ndarray, key2: np.ndarray) -> np.ndarray:
        """Upper ends of the branches' intervals of _ONE, a row for each lane."""
        step = node * 0x2545F4914F6CDD1D
        at = [(k + step) * 0x9E3779B97F4A7C1 >> (62 - b) & ((1 << b) - 1) for k, b in zip((key1, key2), self.bits, strict=True)]
        self.level, self.row = min(level, LEVELS - 1), (node, *at)
        self.held = [t.take(k, axis=0) for t, k in zip(self.table, self.row, strict=True)]
        self.total = [h @ _SUM for h in self.held]
        one, two = (np.minimum(np.maximum(np.frexp(t)[1], 4) - 4, _STATES - 1) for t in self.total[1:])
        self.state = one * _STATES + two
        self.each = [s.take(self.state) / np.maximum(t, _F(1)) for s, t in zip(self.share[self.level], self.total, strict=True)]
        width = self.held[0] * self.each[0][:, None]
        for h, e in zip(self.held[1:], self.each[1:], strict=True):
            width += h * e[:, None]
        np.floor(width, out=width)
        width += _F(1)
        below = width @ _BELOW
        below[:, -1] = _ONE
        return below

    def learn(self, way: np.ndarray, at: np.ndarray, settle: bool) -> None:
        """The branches taken; at: their places in the last prediction, as one row. settle: weights and large totals too."""
        if settle:
            part = [h.reshape(-1).take(at) * e for h, e in zip(self.held, self.each, strict=True)]
            whole = part[0] + part[1] + part[2] + _F(1e-6)
            w = self.weight[self.level]
            for k in range(3):
                w[k] += np.bincount(self.state, part[k] / whole, _STATES * _STATES)
            w[:, w[0] + w[1] + w[2] > _HEAVY] *= 0.5
            self.share[self.level] = self._share(w)
            for t, row, total, most in zip(self.table, self.row, self.total, _MOST, strict=True):
                big = row[total > most]
                if len(big):
                    t[big] = np.ceil(t.take(big, axis=0) * _F(0.5))
        for flat, row, step in zip(self.flat, self.row, _STEP, strict=True):
            np.add.at(flat, row * WAYS + way, step)


class Encoder:
    """Range coders of all lanes. Carries stay in the units, which have room, and are settled at the end."""

    def __init__(self, lanes: int, steps: int):
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, _FULL, _U)
        self.out, self.n = np.zeros((steps + 4, lanes), np.uint32), np.zeros(lanes, np.int64)

    def put(self, lane: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        rng = self.range.take(lane) >> _HALF
        low = self.low.take(lane) + start * rng
        rng *= width
        few = np.flatnonzero(rng <= _LOW)
        if len(few):
            low[few] = self._emit(lane[few], low[few])
            rng[few] <<= _HALF
        self.low[lane], self.range[lane] = low, rng

    def _emit(self, lane: np.ndarray, low: np.ndarray) -> np.ndarray:
        n = self.n[lane]
        if int(n.max()) >= len(self.out):
            self.out = np.concatenate([self.out, np.zeros_like(self.out)])
        self.out[n, lane] = low >> _TOP
        self.n[lane] = n + 1
        return (low & _LOW) << _HALF

    def end(self) -> tuple[np.ndarray, bytes]:
        """Units of each lane, and all of them, lane by lane."""
        every = np.arange(len(self.low))
        self.low += _U((1 << 16) - 1)  # every range is 2 ** 32 at least: two units name a place in it, whatever follows
        for _ in range(2):
            self.low = self._emit(every, self.low)
        for k in range(len(self.out) - 1, 0, -1):
            self.out[k - 1] += self.out[k] >> 16
        used = np.arange(len(self.out)) < self.n[:, None]
        return self.n.astype("<u4"), self.out.astype("<u2").T[used].tobytes()


class Decoder:
    def __init__(self, sizes: np.ndarray, units: np.ndarray):
        self.units = np.append(units, np.zeros(4, units.dtype)).astype(_U)
        self.at = np.cumsum(sizes) - sizes
        self.range, self.code = np.full(len(sizes), _FULL, _U), np.zeros(len(sizes), _U)
        for _ in range(3):
            self.code = (self.code << _HALF) | self.units[self.at]
            self.at += 1

    def get(self, lane: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Branches taken, and their places in below as one row."""
        rng, code = self.range.take(lane) >> _HALF, self.code.take(lane)
        v = np.minimum(code // rng, _U(_ONE - 1)).astype(_F)
        way = np.bitwise_count(np.packbits(below <= v[:, None]).view(np.uint16)).astype(np.int64)
        at = np.arange(len(lane)) * WAYS + way
        start, width = _interval(below, way, at)
        code -= start * rng
        rng *= width
        few = np.flatnonzero(rng <= _LOW)
        if len(few):
            who = lane[few]
            place = self.at[who]
            code[few] = (code[few] << _HALF) | self.units[place]
            self.at[who] = place + 1
            rng[few] <<= _HALF
        self.code[lane], self.range[lane] = code, rng
        return way, at


def _interval(below: np.ndarray, way: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flat = below.reshape(-1)
    start = np.where(way > 0, flat.take(at - (way > 0)), _F(0))
    return start.astype(_U), (flat.take(at) - start).astype(_U)


def _shape(n: int) -> tuple[int, int]:
    """(lanes, steps) for so many ids. A short block has fewer lanes, as each costs some bytes and learns apart."""
    steps = max(min(STEPS if n >= SHORT else 4 * STEPS, n), -(-n // LANES))
    return -(-n // steps), steps


def _keys(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the contexts of one id and of two."""
    k = one * 0x1F83D9ABFB41BD6B
    return k, two * 0x5BE0CD19137E2179 + 7 * k + 1


def encode_block(ids: np.ndarray, docs: np.ndarray, counts: np.ndarray, vocabulary: int = IDS) -> bytes:
    own = code_lengths(np.bincount(ids, minlength=vocabulary))
    packed, streams = _coded(ids, own, own.tobytes(), vocabulary)
    if len(ids) < SHORT:
        packed, streams = min((packed, streams), _coded(ids, even_lengths(vocabulary), b"", vocabulary), key=lambda x: len(x[0]) + len(x[1]))
    body = docs.astype("<i8").tobytes() + counts.astype("<u4").tobytes() + packed + streams
    return _MAGIC + _HEAD.pack(len(ids), len(docs), _shape(len(ids))[0], vocabulary, len(packed), zlib.crc32(body)) + body


def _coded(ids: np.ndarray, lengths: np.ndarray, table: bytes, vocabulary: int) -> tuple[bytes, bytes]:
    """Packed tables and streams of ids, coded by the tree of these lengths."""
    lanes, steps = _shape(len(ids))
    tree = Tree(lengths)
    mixer, coder = Mixer(tree.nodes, len(ids)), Encoder(lanes, steps)
    grid = np.full(lanes * steps, vocabulary)  # that number stands for no id
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    none, every = np.full(lanes, vocabulary), np.arange(lanes)
    for t in range(steps):
        n = -(-(len(ids) - t) // steps)
        x, lane = grid[t, :n], every[:n]
        key1, key2 = _keys((grid[t - 1] if t else none)[:n], (grid[t - 2] if t > 1 else none)[:n])
        for d in range(tree.depth):
            if d:
                more = np.flatnonzero(tree.length.take(x) > d)
                if not len(more):
                    break
                x, lane, key1, key2 = (v.take(more) for v in (x, lane, key1, key2))
            way = tree.way[d].take(x)
            below, at = mixer.predict(d, tree.node[d].take(x), key1, key2), np.arange(len(x)) * WAYS + way
            coder.put(lane, *_interval(below, way, at))
            mixer.learn(way, at, t % SETTLE == 0)
    sizes, streams = coder.end()
    return zlib.compress(sizes.tobytes() + table, 9), streams


def decode_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, documents, token counts) of a block; an error where its checksum doesn't hold."""
    at = len(_MAGIC) + _HEAD.size
    if block[: len(_MAGIC)] != _MAGIC or len(block) < at:
        raise ValueError("not a token block")
    n_ids, n_docs, lanes, vocabulary, packed, crc = _HEAD.unpack_from(block, len(_MAGIC))
    if zlib.crc32(memoryview(block)[at:]) != crc:
        raise ValueError("a token block is damaged")
    docs = np.frombuffer(block, "<i8", n_docs, at)
    counts = np.frombuffer(block, "<u4", n_docs, at + 8 * n_docs)
    at += 12 * n_docs
    tables = zlib.decompress(block[at : at + packed])
    sizes, own = np.frombuffer(tables, "<u4", lanes).astype(np.int64), np.frombuffer(tables, np.uint8, -1, 4 * lanes)
    tree = Tree(own if len(own) else even_lengths(vocabulary))
    coder, steps = Decoder(sizes, np.frombuffer(block, "<u2", -1, at + packed)), _shape(n_ids)[1]
    mixer, grid = Mixer(tree.nodes, n_ids), np.full((steps, lanes), vocabulary)
    none, every = np.full(lanes, vocabulary), np.arange(lanes)
    for t in range(steps):
        n, d = -(-(n_ids - t) // steps), 0
        key1, key2 = _keys((grid[t - 1] if t else none)[:n], (grid[t - 2] if t > 1 else none)[:n])
        lane, node = every[:n], np.zeros(n, np.int64)
        while len(lane):
            way, at = coder.get(lane, mixer.predict(d, node, key1, key2))
            mixer.learn(way, at, t % SETTLE == 0)
            to = tree.next.take(node * WAYS + way)
            leaf = to < 0
            grid[t, lane[leaf]] = -1 - to[leaf]
            more = np.flatnonzero(~leaf)
            lane, node, key1, key2, d = lane.take(more), to.take(more), key1.take(more), key2.take(more), d + 1
    return grid.T.ravel()[:n_ids], docs, counts


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(id, token ids with the end id) of rows (doc, text)."""
    codec, end = library_codec(path), np.array([END_ID], "<u4")
    for b in batches:
        ids = b.column(0).fill_null(-(1 << 63)).to_numpy()
        for a, texts in text_slices(b.column(1)):
            for k, raw in enumerate(codec.texts(texts)):
                yield int(ids[a + k]), np.concatenate([np.frombuffer(raw, "<u4"), end])


def write_tokens(docs: DataFrame, path: str, vocabulary: str, parts: int | None = None, block: int = BLOCK) -> None:
    """Blocks of docs (doc, text) in ascending order, as the Parquet files of the folder path.

    Unless given, parts are as many as have PART_BYTES of text each, four times the session's shuffle partitions at most.
    """
    if parts is None:
        size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
        parts = min(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(1, size // PART_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        size = number = before = 0

        def out() -> pa.RecordBatch:
            data = encode_block(np.concatenate([x for _, x in held]).astype(np.int64), np.array([d for d, _ in held]), np.array([len(x) for _, x in held]))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())], names=["block", "before", "n_ids", "data"])

        for row in _encoded(batches, vocabulary):
            held.append(row)
            size += len(row[1])
            if size >= block:
                yield out()
                held, size, number, before = [], 0, number + 1, before + size
        if held:
            yield out()

    ordered = docs.repartitionByRange(parts, "doc", F.substring("text", 1, 64)).sortWithinPartitions("doc", "text")  # beginnings order as texts do
    blocks = ordered.mapInArrow(run, "block int, before long, n_ids long, data binary").withColumn("part", F.spark_partition_id())
    blocks.write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc, start, n_tokens, ids) of the files in the folder path; ids are little-endian unsigned 32-bit integers."""
    files = spark.read.schema("block int, before long, n_ids long, data binary, part int").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, before, data in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                ids, docs, counts = decode_block(data)
                ends = np.cumsum(counts.astype(np.int64))
                raw = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                doc = pa.array(docs, mask=docs == -(1 << 63))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), part, np.int32)), doc, pa.array(before + ends - counts), pa.array(counts.astype(np.int64)), raw], names=["part", "doc", "inner", "n_tokens", "ids"])

    rows = files.select("part", "before", "data").mapInArrow(run, "part int, doc long, inner long, n_tokens long, ids binary")
    whole = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    shift = whole.withColumn("shift", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "shift")
    at = F.broadcast(shift)  # a row for each of write_tokens' parts, a number that is set there
    return rows.join(at, "part").select("doc", (F.col("inner") + F.col("shift")).alias("start"), "n_tokens", "ids")


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op7")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    write_tokens(docs, scratch.path("tokens"), public_tokenizers.path(VOCABULARY))
    return read_tokens(spark, scratch.path("tokens")).select(F.col("doc").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
