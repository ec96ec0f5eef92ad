"""Packing of token sequences by linear grouping, and best fit for what is small.

Only how many pieces have each length matters to a plan, and there are at most CAPACITY
lengths, so the plan is made on the driver from a table of that many counts, whatever the
number of documents.

1. Large lengths are put into groups of equal cardinality and rounded up to their group's
   greatest. With so few sizes, all maximal configurations of a bin can be listed, and
   column generation over them solves the fractional problem (``configurations``).
2. Whole multiples of each configuration are opened, and the actual pieces of a group take
   the places of its rounded size, longest first.
3. What is left over of the large pieces, and then the small ones, longest first, go each
   where the least room that suffices is left (best fit), or into a new bin.

Several bounds and numbers of groups (``TRIALS``) are tried and the plan of fewest bins is kept. Bins of one kind are
a run in the plan, so its size follows the number of lengths and configurations. Every piece
has a rank among those of its length (counted in partitions, then shifted) and the plan says
which bin and offset the rank has.

Defined cases: null and empty texts are one piece, the end id alone; a document above
CAPACITY ids is cut into full pieces and a rest; rows with equal ids are packed row by row;
an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .units import library_codec, text_slices

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
#: Tried in turn: the part of CAPACITY above which a piece is large, and the number of groups. More groups round
#: up less; with a higher bound a bin has few large pieces, so that there can be many groups.
TRIALS = (*((1 / 5, g) for g in range(5, 25)), *((1 / 3, g) for g in (32, 64, 128)), (1 / 2, 16), (1 / 2, 64))


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """(doc, piece, start, length, crc[, ids]) of docs (doc, text)."""
    names = ["doc", "piece", "start", "length", "crc", *["ids"] * ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = library_codec(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            for a, texts in text_slices(b.column(1)):
                raw = [x + end for x in codec.texts(texts)]
                cut = [(k, i, x[4 * capacity * i : 4 * capacity * (i + 1)]) for k, x in enumerate(raw) for i in range(-(-len(x) // (4 * capacity)))]
                k, i = (np.array([c[j] for c in cut], np.int64) for j in (0, 1))
                cols = [b.column(0).take(pa.array(a + k)), pa.array(i, pa.int32()), pa.array(i * capacity), pa.array([len(c[2]) // 4 for c in cut], pa.int64()), pa.array([zlib.crc32(c[2]) for c in cut], pa.int64())]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array([c[2] for c in cut], pa.binary())] * ids], names=names)

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, piece int, start long, length long, crc long" + ", ids binary" * ids)


def configurations(sizes: list[int], need: list[int], capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """Configurations (how many of each size) and how often each is used in a least fractional cover."""
    every = np.array(_maximal(sizes, capacity), float)
    g = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])  # a column is a configuration
    goal = np.array(need, float)
    for _ in range(40 * g):
        price = np.linalg.solve(basis.T, np.ones(g))
        gain = every @ price
        best = int(np.argmax(gain))
        if gain[best] <= 1 + 1e-9:
            break
        use, step = np.linalg.solve(basis, goal), np.linalg.solve(basis, every[best])
        with np.errstate(divide="ignore", invalid="ignore"):
            room = np.where(step > 1e-9, np.maximum(use, 0) / step, np.inf)
        basis[:, int(np.argmin(room))] = every[best]
    use = np.maximum(np.linalg.solve(basis, goal), 0)
    return [(tuple(int(x) for x in basis[:, k]), float(use[k])) for k in range(g)]


def _maximal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Ways to fill a bin to which no further size can be added; sizes descend."""
    out: list[list[int]] = []
    todo = [([], capacity)]
    while todo:
        have, room = todo.pop()
        k = len(have)
        if k == len(sizes):
            if room < sizes[-1]:
                out.append(have)
        elif k == len(sizes) - 1:
            todo.append(([*have, room // sizes[k]], room % sizes[k]))
        else:
            todo += [([*have, n], room - n * sizes[k]) for n in range(room // sizes[k] + 1)]
    return out


class Plan:
    """Runs of equal bins: (number of bins, contents as (length, times) in order)."""

    def __init__(self, counts: dict[int, int], capacity: int, groups: int, large: float):
        self.capacity, self.left = capacity, dict(counts)
        self.open: dict[int, list[tuple[int, tuple]]] = {}  # by room left
        if capacity in self.left:
            self._close(self.left.pop(capacity), ((capacity, 1),))
        self._large([x for x in sorted(self.left, reverse=True) if x > large * capacity], groups)
        for x in sorted(self.left, reverse=True):
            self._best_fit(x, self.left.pop(x))
        self.runs = [r for room in sorted(self.open) for r in self.open[room]]
        self.bins = sum(n for n, _ in self.runs)

    def _close(self, n: int, held: tuple) -> None:
        if n:
            room = self.capacity - sum(x * k for x, k in held)
            self.open.setdefault(room, []).append((n, held))

    def _large(self, lengths: list[int], groups: int) -> None:
        total = sum(self.left[x] for x in lengths)
        if not total:
            return
        share, group, size = -(-total // groups), [], 0
        members: list[list[list[int]]] = []  # of each group, [length, count] from the longest
        for x in lengths:
            n = self.left[x]
            while n:
                take = min(n, share - size)
                group.append([x, take])
                size, n = size + take, n - take
                if size == share:
                    members.append(group)
                    group, size = [], 0
        if group:
            members.append(group)
        by_size: dict[int, list[list[int]]] = {}
        for m in members:  # groups with one greatest length are one
            by_size.setdefault(m[0][0], []).extend(m)
        sizes = list(by_size)
        for config, use in configurations(sizes, [sum(n for _, n in by_size[s]) for s in sizes], self.capacity):
            use_of = {s: k for s, k in zip(sizes, config, strict=True) if k}
            todo = int(use + 1e-6)
            for s, k in use_of.items():  # rounding must not ask for more than there is
                todo = min(todo, sum(n for _, n in by_size[s]) // k)
            while todo > 0:
                n = max(1, min(todo, *(by_size[s][0][1] // k for s, k in use_of.items())))  # bins of the same lengths
                held = []
                for s in [s for s, k in use_of.items() for _ in range(k)]:
                    queue = by_size[s]
                    x = queue[0][0]
                    held.append((x, 1))
                    queue[0][1] -= n
                    self.left[x] -= n
                    if not queue[0][1]:
                        queue.pop(0)
                self._close(n, tuple(held))
                todo -= n
        self.left = {x: n for x, n in self.left.items() if n}

    def _best_fit(self, x: int, n: int) -> None:
        while n:
            room = min((r for r in self.open if r >= x and self.open[r]), default=None)
            if room is None:
                fit = self.capacity // x
                self._close(n // fit, ((x, fit),))
                self._close(1 if n % fit else 0, ((x, n % fit),))
                return
            fit = room // x
            have, held = self.open[room].pop()
            bins = min(have, n // fit)
            if bins:
                self._close(bins, (*held, (x, fit)))
                n -= bins * fit
                self._keep(room, have - bins, held)
            else:
                self._close(1, (*held, (x, n)))
                self._keep(room, have - 1, held)
                n = 0

    def _keep(self, room: int, n: int, held: tuple) -> None:
        if n:
            self.open[room].append((n, held))

    def tables(self) -> tuple[np.ndarray, ...]:
        """Sorted by (length, first rank): length, first rank, first bin, pieces to a bin, offset."""
        used: dict[int, int] = {}
        rows, first = [], 0
        for n, held in self.runs:
            offset = 0
            for x, k in held:
                rows.append((x, used.get(x, 0), first, k, offset))
                used[x] = used.get(x, 0) + n * k
                offset += x * k
            first += n
        return tuple(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) if rows else (np.zeros(0, np.int64),) * 5


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    return min((Plan(counts, capacity, g, large) for large, g in TRIALS), key=lambda p: p.bins)


def place(found: DataFrame, plan: Plan) -> DataFrame:
    """found (…, length, rank) with (sequence, offset)."""
    shared = found.sparkSession.sparkContext.broadcast(plan.tables())  # bounded by lengths and configurations
    schema = found.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    names = found.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, lo, first, times, offset = shared.value
        key = (length << 44) + lo
        for b in batches:
            x, r = b.column("length").to_numpy(), b.column("rank").to_numpy()
            k = np.searchsorted(key, (x << 44) + r, "right") - 1
            inner = r - lo[k]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first[k] + inner // times[k]), pa.array(offset[k] + inner % times[k] * x)], names=[*names, "sequence", "offset"])

    return found.mapInArrow(run, f"{schema}, sequence long, offset long")


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, capacity: int = CAPACITY, scratch: Scratch | None = None, ids: bool = False) -> DataFrame:
    """(doc, piece, start, length, crc[, ids], sequence, offset): every piece of every row, placed."""
    scratch = scratch or Scratch(df.sparkSession, "op8")
    docs = df.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text"))
    cut = pieces(docs, vocabulary or public_tokenizers.path(VOCABULARY), capacity, ids)
    cut = scratch.settle(cut.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "pieces")
    per = scratch.settle(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    counts = {r.length: r.n for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    # it has up to a row for each part and length, so it is never broadcast; both sides are dealt by (part, length)
    shift = per.withColumn("shift", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    rank = F.row_number().over(Window.partitionBy("part", "length").orderBy("row")) - 1
    ranked = cut.withColumn("rank", rank).join(shift.hint("merge"), ["part", "length"]).withColumn("rank", (F.col("rank") + F.col("shift")).cast("long"))
    names = ["doc", "piece", "start", "length", "crc", *["ids"] * ids]
    return place(ranked.select(*names, "rank"), best_plan(counts, capacity)).drop("rank")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("doc").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), F.col("sequence").alias("sequence_id"), "offset")
