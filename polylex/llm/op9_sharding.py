"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts lie side by side and a group of
copies that is larger than a shard is cut between its ids. The splitters between shards are
found without sorting: each round counts the exact bytes below a set of candidate keys, in
every partition and then added up, and narrows each splitter's interval to the two
candidates that enclose its target. A splitter is settled when it is within the tolerance,
or when one row or none is left between its candidates. Only then are the rows exchanged,
once, with their texts. A round reads 24 bytes a row and sends back one count for each
candidate, so nothing on the driver grows with the rows.

The exchange deals each shard over bins of about ``BIN`` bytes, by a hash of the same keys, so
that no task grows with a shard. A shard's slots are numbered in each bin from where the bin
before ends; the bins' counts are known before, from the keys.

Defined cases: null text has size ``OVERHEAD`` and the empty text's checksum; a null id
sorts before all others; rows equal in text and id cannot be told apart, so they share a
shard and a bin; an empty table gives an empty result. Extra columns are carried unless their names
begin with ``__``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

SHARDS = 40
OVERHEAD = 16
#: Of a shard's mean size.
TOLERANCE = 0.001
#: Bytes of a shard that a task numbers.
BIN = 128 << 20
PROBES = 63


def _key_bytes(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Keys whose order as byte strings is that of (h, d)."""
    both = np.stack([h, d], axis=1).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(both.astype(">u8")).view("S16").ravel()


def _as_int(h: int, d: int) -> int:
    return ((h + (1 << 63)) << 64) | (d + (1 << 63))


def _as_pair(k: int) -> tuple[int, int]:
    return (k >> 64) - (1 << 63), (k & ((1 << 64) - 1)) - (1 << 63)


def bytes_below(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """For each ascending probe: bytes and rows with a smaller key. keys: (h, d, size)."""
    pairs = np.array([_as_pair(p) for p in probes], np.int64).reshape(-1, 2)
    at = _key_bytes(pairs[:, 0], pairs[:, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
        for b in batches:
            h, d, s = (b.column(k).to_numpy() for k in range(3))
            slot = np.searchsorted(at, _key_bytes(h, d), "right")
            np.add.at(size, slot, s)
            rows += np.bincount(slot, minlength=len(at) + 1)
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(size[full]), pa.array(rows[full])], names=["slot", "size", "n"])

    found = keys.mapInArrow(run, "slot long, size long, n long").groupBy("slot").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    size, rows = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
    for r in found:
        size[r.slot], rows[r.slot] = r.size, r.n
    return list(zip(np.cumsum(size)[:-1].tolist(), np.cumsum(rows)[:-1].tolist(), strict=True))


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[int]:
    """shards - 1 ascending keys; shard k has the keys from splitter k - 1 up to below splitter k."""
    total, count, lo, hi = keys.agg(F.sum("size"), F.count("*"), F.min("h"), F.max("h")).first()
    if not count:
        return []
    ends = (_as_int(lo, -(1 << 63)), _as_int(hi, (1 << 63) - 1) + 1)
    goal = [total * k / shards for k in range(1, shards)]
    least = tolerance * total / shards
    state = [[(ends[0], 0, 0), (ends[1], total, count)] for _ in goal]  # (key, bytes below, rows below) that enclose the goal
    done: dict[int, int] = {}
    while len(done) < len(goal):
        ask: set[int] = set()
        for k, (a, b) in enumerate(state):
            if k in done:
                continue
            near = min((a, b), key=lambda x, t=goal[k]: abs(x[1] - t))
            if abs(near[1] - goal[k]) <= least or b[2] - a[2] <= 1 or b[0] - a[0] <= 1:
                done[k] = near[0]
            else:
                ask |= {a[0] + (b[0] - a[0]) * i // (probes + 1) for i in range(1, probes + 1)} - {a[0], b[0]}
        if not ask:
            continue
        at = sorted(ask)
        known = [(p, *c) for p, c in zip(at, bytes_below(keys, at), strict=True)]
        sizes = [x[1] for x in known]
        for k, (a, b) in enumerate(state):
            if k not in done:
                i = int(np.searchsorted(sizes, goal[k], "right"))
                below = [x for x in known[max(0, i - 1) : i] if x[0] > a[0]]
                above = [x for x in known[i : i + 1] if x[0] < b[0]]
                state[k] = [below[0] if below else a, above[0] if above else b]
    return [done[k] for k in range(len(goal))]


def _shard_of(cuts: list[int], h: Column, d: Column, first: int = 0) -> Column:
    """Binary search as nested conditions: as many comparisons as the logarithm of the shards."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    ch, cd = _as_pair(min(cuts[mid], (1 << 128) - 1))
    below = (h < ch) | ((h == ch) & (d < cd))
    if cuts[mid] >= 1 << 128:  # beyond every key
        below = F.lit(True)
    return F.when(below, _shard_of(cuts[:mid], h, d, first)).otherwise(_shard_of(cuts[mid + 1 :], h, d, first + mid + 1))


def histogram_shards(df: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None, room: int = BIN) -> DataFrame:
    """df with __size, __shard and __slot: exchanged once, in bins of about room bytes."""
    scratch = scratch or Scratch(df.sparkSession, "op9")
    words = F.coalesce(F.col(text).cast("string"), F.lit(""))
    x = df.withColumns({"__h": F.xxhash64(words), "__d": F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))), "__size": (F.octet_length(words) + OVERHEAD).cast("long")})
    keys = scratch.settle(x.select(F.col("__h").alias("h"), F.col("__d").alias("d"), F.col("__size").alias("size")), "keys")
    cuts = splitters(keys, shards)
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bins = -(-total // (shards * room)) or 1
    place = lambda h, d: {"__shard": _shard_of(cuts, F.col(h), F.col(d)), "__bin": F.pmod(F.xxhash64(d, h), F.lit(bins)).cast("int")}
    held = keys.withColumns(place("h", "d")).groupBy("__shard", "__bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("__shard").orderBy("__bin")) - F.col("n")  # a row for each bin
    first = scratch.settle(held.select("__shard", "__bin", before.alias("__first")), "bins")
    slot = F.row_number().over(Window.partitionBy("__shard", "__bin").orderBy("__h", "__d")) - 1
    x = x.withColumns(place("__h", "__d")).withColumn("__slot", slot).join(first, ["__shard", "__bin"])
    return x.withColumn("__slot", (F.col("__slot") + F.col("__first")).cast("long")).select(*df.columns, "__size", "__shard", "__slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = histogram_shards(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select(
        "doc_id", F.col("__size").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
