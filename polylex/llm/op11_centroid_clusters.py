"""Clusters around centroids, with exact integers and group bounds that spare most distances.

The centroids are put into groups once, by a few steps of clustering the first centroids
themselves. A vector carries its centroid, an upper bound on the distance to it and a lower
bound for each group on the distance to all others of the group. When centroids have moved, the
bounds are widened by how far they moved. A vector whose upper bound stays below all its lower
bounds keeps its centroid unseen; else the distance to its own centroid is taken exactly, and if
that isn't below all bounds either, only the groups that it isn't below are scanned, exactly.
Bounds are kept a little wider than rounding could make them wrong, and ties are settled on
exact integer distances, so the result is that of comparing everything.

A round is one pass that writes the vectors with their bounds anew, and one sum over those that
changed their centroid: sums are exact, so they are kept up by what came and went. Centroids,
their sums and counts (k times dim integers) are all that the driver holds. Rounds after one in
which no vector changed its centroid can't change anything and are left out.

Defined cases: a vector of another length than ``dim``, or with a component that is null, not
finite, or beyond 2^27 once it is an integer (its squared distances would not fit 64 bits), is
not in the result. With fewer vectors than k there are as many centroids as vectors. Repeated
vectors and ids are vectors of their own; of equal ids the vector that compares less is the
earlier centroid; a null id is a centroid only where there are no others, and is kept. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .integer_vectors import as_text, integers, list_column, matrix, sums, usable
from .scratch import Scratch

K, ROUNDS, DIM, SEED = 8, 10, 64, 3
#: Centroids to a group, about.
GROUP = 4
#: Rows worked on at a time.
ROWS = 4096


def group_centroids(c: np.ndarray, groups: int, steps: int = 5) -> np.ndarray:
    """The group of each centroid."""
    x = c.astype(np.float64)
    mid = x[np.linspace(0, len(x) - 1, groups).astype(int)]
    for _ in range(steps):
        own = ((x[:, None] - mid) ** 2).sum(2).argmin(1)
        mid = np.stack([x[own == g].mean(0) if (own == g).any() else mid[g] for g in range(groups)])
    return np.unique(own, return_inverse=True)[1]


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of c."""
    d = x[:, None] - c[None]
    return np.einsum("ijk,ijk->ij", d, d)


def _wide(a: np.ndarray) -> np.ndarray:
    """Upper bounds of the roots of exact squares."""
    return np.sqrt(a.astype(np.float64)) * (1 + 1e-12) + 1e-9


def _narrow(a: np.ndarray) -> np.ndarray:
    """Lower bounds of the roots."""
    return np.maximum(np.sqrt(a.astype(np.float64)) * (1 - 1e-12) - 1e-9, 0)


_FAR = np.iinfo(np.int64).max


def first_bounds(x: np.ndarray, c: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, upper bound, and a lower bound for each group, by all distances."""
    d = distances(x, c)
    own = d.argmin(1)
    at = np.arange(len(x))
    upper = _wide(d[at, own])
    d[at, own] = _FAR
    return own, upper, np.stack([_narrow(d[:, group == g].min(1)) for g in range(group.max() + 1)], 1)


def settle_bounds(x: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: np.ndarray, moved: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(own, upper, lower, distances taken) after the centroids moved to c, each by moved at most."""
    groups = lower.shape[1]
    drift = np.array([moved[group == g].max() for g in range(groups)])
    own, upper = own.copy(), (upper + moved[own]) * (1 + 1e-12) + 1e-9
    lower = np.maximum((lower - drift) * (1 - 1e-12) - 1e-9, 0)
    taken = 0
    at = np.flatnonzero(upper >= lower.min(1))  # the global filter
    if len(at):
        diff = x[at] - c[own[at]]
        exact = np.einsum("ij,ij->i", diff, diff)
        taken += len(at)
        upper[at] = _wide(exact)
        still = upper[at] >= lower[at].min(1)
        at, exact = at[still], exact[still]
    if not len(at):
        return own, upper, lower, taken
    best, who = exact.copy(), own[at].copy()
    scan = upper[at][:, None] >= lower[at]  # the groups' filter
    second = lower[at].copy()
    seen: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    for g in range(groups):
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        members = np.flatnonzero(group == g)
        d = distances(x[at[rows]], c[members])
        taken += d.size
        seen.append((g, rows, members, d))
        k = d.argmin(1)
        near, name = d[np.arange(len(rows)), k], members[k]
        better = (near < best[rows]) | ((near == best[rows]) & (name < who[rows]))
        best[rows[better]], who[rows[better]] = near[better], name[better]
    for g, rows, members, d in seen:
        d[who[rows][:, None] == members] = _FAR
        second[rows, g] = _narrow(d.min(1))
    left = np.flatnonzero(who != own[at])  # the old centroid now counts for its group's bound
    g = group[own[at[left]]]
    second[left, g] = np.minimum(second[left, g], _narrow(exact[left]))
    own[at], upper[at], lower[at] = who, _wide(best), second
    return own, upper, lower, taken


def _pass(points: DataFrame, schema: str, c: np.ndarray, group: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """points (id, vec, own, upper, lower) with own, bounds and before brought up to the centroids c."""
    names = ["id", "vec", "own", "before", "upper", "lower"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                b = whole.slice(a, ROWS)
                x = matrix(b.column("vec"), c.shape[1])
                if moved is None:
                    before = np.full(len(x), -1)
                    own, upper, lower = first_bounds(x, c, group)
                else:
                    before = b.column("own").to_numpy().astype(np.int64)
                    held = b.column("lower").flatten().to_numpy().reshape(len(x), -1)
                    own, upper, lower, _ = settle_bounds(x, before, b.column("upper").to_numpy(), held, c, moved, group)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vec"), pa.array(own, pa.int32()), pa.array(before, pa.int32()), pa.array(upper), list_column(lower)], names=names)

    return points.mapInArrow(run, schema)


def _changes(points: DataFrame, dim: int) -> list:
    """For each centroid, count and sums of what came (way 1) and went (way -1)."""
    x = points.where("own <> before").select("vec", F.explode(F.array(F.struct(F.col("own").alias("c"), F.lit(1).alias("way")), F.struct(F.col("before").alias("c"), F.lit(-1).alias("way")))).alias("m"))
    x = x.select("vec", "m.c", "m.way").where("c >= 0")
    return x.groupBy("c", "way").agg(F.count("*").alias("n"), *sums(dim)).collect()


def _measured(points: DataFrame, c: np.ndarray) -> DataFrame:
    """(id, cluster, distance): the exact squared distance to the own centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            diff = matrix(b.column("vec"), c.shape[1]) - c[b.column("own").to_numpy()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("own"), pa.array(np.einsum("ij,ij->i", diff, diff))], names=["id", "cluster", "distance"])

    return points.mapInArrow(run, f"id {points.schema['id'].dataType.simpleString()}, cluster int, distance long")


def centroid_clusters(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, dim: int = DIM, seed: int = SEED, scratch: Scratch | None = None
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every usable vector, and the final centroids."""
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "op11")
    raw = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v")) & (F.size("v") == dim))
    points = scratch.settle(raw.select("id", integers(F.col("v")).alias("vec")), "points-0")
    order = [F.asc_nulls_last("h"), "id", "vec"]
    first = points.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)).orderBy(*order).limit(k).collect()
    if not first:
        return spark.createDataFrame([], f"id {df.schema[key].dataType.simpleString()}, cluster int, distance long"), np.zeros((0, dim), np.int64)
    c = np.array([r.vec for r in first], np.int64)
    group = group_centroids(c, -(-len(c) // GROUP))
    schema = f"id {points.schema['id'].dataType.simpleString()}, vec array<int>, own int, before int, upper double, lower array<double>"
    total, count = [[0] * dim for _ in c], [0] * len(c)
    moved: np.ndarray | None = None
    for r in range(rounds):
        points = scratch.settle(_pass(points, schema, c, group, moved), f"points-{r + 1}")
        scratch.drop(f"points-{r}")
        changes = _changes(points, dim)
        if not changes:
            break
        for x in changes:
            count[x.c] += x.way * x.n
            total[x.c] = [a + x.way * x[f"s{i}"] for i, a in enumerate(total[x.c])]
        new = np.array([[a // n for a in t] if n else old for t, n, old in zip(total, count, c.tolist(), strict=True)], np.int64)
        moved, c = _wide(((new - c) ** 2).sum(1)), new
    else:
        points = _pass(points, schema, c, group, moved)
    return scratch.settle(_measured(points.select("id", "vec", "own"), c), "clusters"), c


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, c = centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digests = [(k, hashlib.sha256(as_text(x.tolist()).encode()).hexdigest()) for k, x in enumerate(c)]
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    each = each.join(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster")
    each = each.crossJoin(found.agg(F.sum("distance").alias("inertia")))  # one row
    return found.join(F.broadcast(each), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row for each of K centroids
