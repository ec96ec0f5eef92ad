"""Near-duplicate embeddings: random-hyperplane signatures, exact cosines, components.

Equal vectors are one node with a weight. A node is put into a bucket for each of several
tables, by the signs of its products with that table's random hyperplanes. All pairs of a
bucket are compared by their exact cosine in double precision; a pair that an earlier table
has already brought together is not counted again, which the signatures carried along tell.
The tables are as many as a pair at the threshold needs to meet with probability RECALL, and
the signature's length grows with the logarithm of the number of nodes, so that buckets stay
of about BUCKET rows. A larger bucket is cut into cells (components.deal). Only counts and
connecting links leave a cell, never its pairs.

Defined cases: a vector that is null, empty, zero, or has a null or non-finite component
links with nothing, and is its own component; a null id likewise, with a null component, and
is kept. Vectors of different lengths never link. Repeated rows are vectors of their own:
each counts the others; rows that share an id but not their vector have each their own links. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import cells, deal, edges_of, hot_limit, labels, roots, spread_join
from .scratch import Scratch

THRESHOLD = 0.9
RECALL = 0.998
BUCKET = 256
CELL = 8192
SEED = 10


def table_shape(nodes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for so many nodes: a pair at the threshold meets with probability recall."""
    bits = min(30, max(8, math.ceil(math.log2(max(1, nodes) / BUCKET))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def usable(vec: Column) -> Column:
    """No null, no non-finite component, not empty, not zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vec, bad) & F.exists(vec, lambda x: x != 0), F.lit(False))


def _signatures(m: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A signature for each row and table."""
    planes = np.random.default_rng([SEED, m.shape[1]]).standard_normal((m.shape[1], bits * tables))
    sign = (m @ planes > 0).reshape(len(m), tables, bits)
    return (sign * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def _matrix(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat components and each vector's offset."""
    off = col.offsets.to_numpy()
    return col.values.to_numpy(zero_copy_only=False), off


def _signed(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """nodes (node, own, weight, vec) with sig, a signature for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, off = _matrix(b.column(3))
            sig = np.zeros((b.num_rows, tables), np.int32)
            for dim in np.unique(np.diff(off)):
                rows = np.flatnonzero(np.diff(off) == dim)
                for r in np.array_split(rows, -(-len(rows) // 2048)):
                    m = flat[off[r][:, None] + np.arange(dim)].astype(np.float64)
                    m /= np.abs(m).max(axis=1, keepdims=True)
                    sig[r] = _signatures(m, bits, tables)
            lists = pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * tables, pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=["node", "own", "weight", "vec", "sig"])

    kind = nodes.schema["vec"].dataType.simpleString()
    return nodes.select("node", "own", "weight", "vec").mapInArrow(run, f"node long, own long, weight long, vec {kind}, sig array<int>")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key, node, weight, sig, vec): a row for each node and table."""
    rows = nodes.select("node", "weight", "sig", "vec", F.posexplode("sig").alias("table", "place"))
    key = F.call_function("shiftleft", F.size("vec").cast("long"), F.lit(40)) + F.call_function("shiftleft", F.col("table").cast("long"), F.lit(30)) + F.col("place")
    return rows.select(key.alias("key"), "node", "weight", "sig", "vec")


def _compare(dealt: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): what node a links with in a cell: how many vectors, and one node b that it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in cells(batches, ("key", "one", "two"), 4096):
            key, one, two, part, node, weight = (t.column(c).to_numpy(zero_copy_only=False) for c in ("key", "one", "two", "part", "node", "weight"))
            flat, off = _matrix(t.column("vec"))
            signs, at = _matrix(t.column("sig"))
            edge = edges_of(key, one, two)
            out = []
            for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if z - a < 2:
                    continue
                m = flat[off[a] : off[z]].reshape(z - a, -1).astype(np.float64)
                m /= np.abs(m).max(axis=1, keepdims=True)  # no square overflows
                m /= np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
                sig = signs[at[a] : at[z]].reshape(z - a, -1)
                table = (key[a] >> 30) & 1023
                n, root = np.zeros(z - a, np.int64), np.arange(z - a)
                for x in range(0, z - a, 512):
                    cos = m[x : x + 512] @ m[x:].T
                    i, j = np.nonzero(cos >= threshold)
                    i, j = i + x, j + x
                    keep = i < j
                    if one[a] != two[a]:
                        keep &= part[a:z][i] != part[a:z][j]
                    i, j = i[keep], j[keep]
                    new = ~(sig[i, :table] == sig[j, :table]).any(axis=1)
                    n += np.bincount(i[new], weight[a:z][j[new]], z - a).astype(np.int64) + np.bincount(j[new], weight[a:z][i[new]], z - a).astype(np.int64)
                    tied = np.flatnonzero(root != np.arange(z - a))
                    root = roots(z - a, np.concatenate([i, tied]), np.concatenate([j, root[tied]]))
                hit = np.flatnonzero((n > 0) | (root != np.arange(z - a)))
                out.append((node[a:z][hit], node[a:z][root[hit]], n[hit]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "n"])

    return dealt.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two").mapInArrow(run, "a long, b long, n long")


def cosine_groups(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, scratch: Scratch | None = None, cell: int = CELL) -> DataFrame:
    """(id, n_links, component) of every row of df."""
    scratch = scratch or Scratch(df.sparkSession, "op10")
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"))
    good = F.col("id").isNotNull() & usable(F.col("vec"))
    nodes = rows.where(good).groupBy("vec").agg(F.min("id").alias("own"), F.count("*").alias("weight"))
    nodes = scratch.settle(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # an id need not be unique, so nodes have numbers
    signed = scratch.settle(_signed(nodes, *table_shape(nodes.count(), threshold)), "signed")
    dealt = deal(_buckets(signed), "key", "node", cell)
    found = scratch.settle(_compare(dealt.select("key", "one", "two", "part", "node", "weight", "sig", "vec"), threshold), "found")
    count = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    known = labels(nodes.select("node", "own", "weight"), found.select("a", "b"), scratch).join(count, "node", "left")
    known = known.select("node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.col("component").alias("c"))
    known = nodes.select("node", "vec", F.col("weight").alias("n")).join(known, "node").drop("node")
    linked = spread_join(rows.where(good), known, "vec", "id", hot_limit(rows.count())).select("id", "n_links", F.col("c").alias("component"))
    alone = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cosine_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))
