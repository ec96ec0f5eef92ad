"""Connected components of a link table, and helpers for comparing rows of one bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Tasks over which the rows of a hot key are spread; a key is hot with more than one in HOT of all rows.
SALTS, HOT = 64, 2000
#: Links of so many or fewer (16 MB) are settled by one task; a larger table takes rounds of joins.
FEW = 1 << 20


def spread_join(rows: DataFrame, ends: DataFrame, key: str, other: str, limit: int, how: str = "inner") -> DataFrame:
    """rows joined with ends (key, n, ...), which has one row for each key and says how many rows it has.

    Keys of more than limit rows are spread over SALTS tasks by a hash of the column other. They
    are broadcast, so limit must be a part of the number of rows: fewer keys than its inverse are hot.
    """
    many = F.col("n") > limit
    hot = ends.where(many).select(key, F.lit(True).alias("__hot"))
    salts = F.explode(F.sequence(F.lit(0), F.when(many, SALTS - 1).otherwise(0)))
    right = ends.withColumn("__salt", salts).drop("n")
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(other), F.lit(SALTS))).otherwise(0).cast("int")
    left = rows.join(F.broadcast(hot), key, "left").withColumn("__salt", salt).drop("__hot")
    return left.join(right, [key, "__salt"], how).drop("__salt")


def hot_limit(rows: int) -> int:
    """A key of more rows is hot: fewer than HOT keys are."""
    return max(200, rows // HOT)


def _settled(links: DataFrame) -> DataFrame:
    """(node, component) of links (u, v), all in one task; its caller has seen that they are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches, pa.schema([("u", pa.int64()), ("v", pa.int64())]))
        u, v = t.column("u").to_numpy(), t.column("v").to_numpy()
        node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        least = node[roots(len(node), at[: len(u)], at[len(u) :])]
        yield from pa.table({"node": node, "component": least}).to_batches(1 << 16)

    return links.select("u", "v").coalesce(1).mapInArrow(run, "node long, component long")


def components(links: DataFrame, scratch: Scratch, name: str = "links", few: int = FEW) -> DataFrame:
    """(node, component): least reachable node, for every node of links (a, b).

    Alternates large-star and small-star steps until no link changes. A step joins links
    with a minimum for each node, so no neighbourhood is gathered in one place, and a hub's
    links are spread over tasks. Rounds grow with the logarithm of the number of nodes. Of few
    links, a round's jobs and plans cost the driver more than the links: one task settles them,
    also where a large table has shrunk to few.
    """
    spark = scratch.spark
    now = scratch.settle(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    mark, k = _mark(now), 0
    while mark[0]:
        if mark[0] <= few:
            return _settled(now)
        limit = hot_limit(mark[0])
        least = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n"))
        large = spread_join(now, least.withColumnRenamed("u", "v"), "v", "u", limit).where("u <> m").select("u", F.col("m").alias("v")).distinct()
        large = scratch.settle(large, f"{name}-{k}l")
        own = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = spread_join(large, own, "u", "v", limit).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own.select("u", F.col("m").alias("v"))).distinct()
        new = scratch.settle(small, f"{name}-{k + 1}")
        scratch.drop(f"{name}-{k}l")
        before, mark, k = mark, _mark(new), k + 1
        if mark == before:
            break
        scratch.drop(f"{name}-{k - 1}")
        now = new
    own = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.unionByName(own.select(F.col("component").alias("node"), "component").distinct()) if mark[0] else spark.createDataFrame([], "node long, component long")


def labels(nodes: DataFrame, links: DataFrame, scratch: Scratch, name: str = "links") -> DataFrame:
    """nodes (node, own, ...) with component: the least own that a node can reach by links (a, b) of nodes.

    A node is unique, what it is called by (own) need not be. nodes is read twice.
    """
    comp = scratch.settle(components(links, scratch, name), f"{name}-components")
    least = nodes.select("node", "own").join(comp, "node").groupBy("component").agg(F.min("own").alias("__least"), F.count("*").alias("n"))
    named = spread_join(comp, least, "component", "node", hot_limit(comp.count())).select("node", "__least")
    return nodes.join(named, "node", "left").withColumn("component", F.coalesce("__least", "own")).drop("__least")


def _mark(links: DataFrame) -> tuple:
    """Count and checksum: equal for equal tables."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n rows linked by (a, b), the least row that each can reach."""
    p = np.arange(n)
    while len(a):
        m = np.minimum(p[a], p[b])
        np.minimum.at(p, p[a], m)
        np.minimum.at(p, p[b], m)
        while not np.array_equal(q := p[p], p):
            p = q
        open_ = p[a] != p[b]
        a, b = a[open_], b[open_]
    return p


def deal(rows: DataFrame, key: str, node: str, limit: int) -> DataFrame:
    """rows with (part, one, two): the cells in which the rows of a key are to be compared.

    A key of at most limit rows is one cell (0, 0). A larger one is cut into parts of about
    limit rows, and each pair of parts is a cell, so that all pairs of rows meet exactly once
    (rows of part one with rows of part two) and no task holds more than two parts. The rows
    learn their key's number of parts by a join on key and salt, so a hot key is in SALTS
    tasks from the start. rows are read twice: settle what is dear to compute.
    """
    salt = F.pmod(F.xxhash64(node, F.lit(11)), F.lit(SALTS)).cast("int")
    hot = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > limit)
    hot = hot.select(key, F.ceil(F.col("__n") / limit).cast("int").alias("__parts"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    x = rows.withColumn("__salt", salt).join(hot, [key, "__salt"], "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
    x = x.withColumn("part", F.pmod(F.xxhash64(node, F.lit(7)), F.col("__parts")).cast("int"))
    x = x.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    return x.withColumns({"one": F.least("part", "__other"), "two": F.greatest("part", "__other")}).drop("__parts", "__other", "__salt")


def cells(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], rows: int) -> Iterator[pa.RecordBatch]:
    """Whole cells of a stream sorted by keys, put together up to about so many rows."""
    held: list[pa.RecordBatch] = []
    count = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        count += b.num_rows
        if count >= rows:
            t = _one(held)
            cut = _last_cell(t, keys)
            if cut:
                yield t.slice(0, cut)
            held, count = [t.slice(cut)], t.num_rows - cut
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(held).combine_chunks()
    return t.to_batches()[0]


def _last_cell(t: pa.RecordBatch, keys: tuple[str, ...]) -> int:
    """Where the last cell of t starts."""
    same = np.ones(t.num_rows, bool)
    for k in keys:
        v = t.column(k).to_numpy(zero_copy_only=False)
        same &= v == v[-1]
    return int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0


def edges_of(*cols: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin in sorted columns, and the end."""
    n = len(cols[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)
