"""Short codes of vectors: each part named by its nearest codebook entry, found by partial distances.

A vector's integer components are cut into equal parts, and every part position has a codebook.
The search goes through the codebook in blocks of entries. The entry that is nearest on the few
dimensions of greatest variance gives the first complete distance. Within a block, dimensions
come in descending order of the codebook's variance, and a pair of part and entry is dropped as
soon as its accumulated distance is strictly greater than the least complete distance so far; so
ties stay and go to the lower entry. All of it is masks over many parts at a time.

A round is one pass over the vectors, which are written once; tasks give sums and counts of the
entries that they used, which are added up by Spark. Codebooks (parts times entries times
components of a part) are all that the driver holds.

Defined cases: a vector that is null or empty, or has a component that is null, not finite, or
beyond 2^27 once it is an integer, is not in the result; nor is one whose length isn't the
commonest among the others (the lesser of two as common), or no multiple of the number of parts.
With fewer vectors than entries the codebook has as many entries as vectors. Repeated vectors
and ids are vectors of their own; of equal ids the vector that compares less comes first; null
ids come last. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import hot_limit, spread_join
from .integer_vectors import as_text, integers, matrix, sums, usable
from .scratch import Scratch

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Rows and entries worked on at a time; dimensions after which pairs are looked at one by one.
ROWS, BLOCK, DENSE = 1024, 64, 4


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, exact squared distance) of the nearest row of book for each row of x; ties to the lower entry."""
    order = np.argsort(-book.astype(np.float64).var(0), kind="stable")
    x, book = x[:, order], book[:, order]
    n, dim = x.shape
    at = np.arange(n)
    few = min(DENSE, dim)
    guess = ((x[:, None, :1] - book[None, :, :1]) ** 2)[..., 0].argmin(1)
    diff = x - book[guess]
    best, who = np.einsum("ij,ij->i", diff, diff), guess
    for a in range(0, len(book), BLOCK):
        part = book[a : a + BLOCK]
        acc = np.zeros((n, len(part)), np.int64)
        for k in range(few):
            d = x[:, k, None] - part[None, :, k]
            acc += d * d
        i, j = np.nonzero(acc <= best[:, None])
        acc = acc[i, j]
        for k in range(few, dim):
            if not len(i):
                break
            d = x[i, k] - part[j, k]
            acc += d * d
            stay = acc <= best[i]
            if not stay.all():
                i, j, acc = i[stay], j[stay], acc[stay]
        if len(i):  # complete: the least of each row, the lower entry first
            first = np.lexsort((j, acc, i))
            i, j, acc = i[first], j[first] + a, acc[first]
            head = np.append(True, i[1:] != i[:-1])
            i, j, acc = i[head], j[head], acc[head]
            better = (acc < best[i]) | (j < who[i])
            best[i[better]], who[i[better]] = acc[better], j[better]
    return who, best


def _codes(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, distance) of each row: an entry for each part, and the parts' distances together."""
    parts, _, width = books.shape
    found = [nearest(x[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
    return np.stack([w for w, _ in found], 1), sum(d for _, d in found)


def _usage(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, s): of the parts that chose an entry, number and sums, a row for each task that has some."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                x = matrix(whole.slice(a, ROWS).column(0), parts * width)
                who, _ = _codes(x, books)
                for p in range(parts):
                    np.add.at(s[p], who[:, p], x[:, p * width : (p + 1) * width])
                    n[p] += np.bincount(who[:, p], minlength=entries)
        p, e = np.nonzero(n)
        lists = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * width, pa.array(s[p, e].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), lists], names=["part", "entry", "n", "s"])

    return vectors.select("vec").mapInArrow(run, "part int, entry int, n long, s array<long>")


def vector_codes(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", carry: tuple[str, ...] = (), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scratch: Scratch | None = None
) -> tuple[DataFrame, np.ndarray]:
    """(id, entries, error, and carry's columns as fields of ``row``) of every usable vector, and the final codebooks (part, entry, component)."""
    spark = df.sparkSession
    scratch = scratch or Scratch(spark, "op13")
    row = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(True)
    raw = df.select(F.col(key).alias("id"), row.alias("row"), F.col(vector).alias("v")).where(usable(F.col("v")))
    vectors = scratch.settle(raw.select("id", "row", integers(F.col("v")).alias("vec")), "vectors")
    sizes = vectors.groupBy(F.size("vec").alias("dim")).count().where(f"dim % {parts} = 0").orderBy(F.desc("count"), "dim").first()
    dim = sizes.dim if sizes else parts
    vectors = vectors.where(F.size("vec") == dim)
    width = dim // parts
    first = vectors.select("id", "vec").orderBy(F.asc_nulls_last("id"), "vec").limit(entries).collect()
    books = np.array([r.vec for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    if first:
        for _ in range(rounds):
            used = _usage(vectors, books).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums(width, "s")).collect()
            new = books.copy()
            for r in used:
                new[r.part, r.entry] = [r[f"s{k}"] // r.n for k in range(width)]
            if np.array_equal(new, books):
                break
            books = new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                b = whole.slice(a, ROWS)
                who, error = _codes(matrix(b.column("vec"), dim), books)
                lists = pa.ListArray.from_arrays(np.arange(len(who) + 1, dtype=np.int32) * parts, pa.array(who.astype(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), lists, pa.array(error)], names=["id", "row", "entries", "error"])

    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    coded = vectors.select("id", "row", "vec").mapInArrow(run, f"id {kind['id']}, row {kind['row']}, entries array<int>, error long")
    return scratch.settle(coded, "codes"), books


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=("label",))
    digest = hashlib.sha256(as_text(books.ravel().tolist()).encode()).hexdigest()
    code = F.lower(F.concat(*(F.lpad(F.hex(F.get("entries", F.lit(p))), 2, "0") for p in range(PARTS))))
    known = F.when(F.col("row.label").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("row.label").cast("string")))
    out = coded.select(F.col("id").alias("vec_id"), code.alias("code"), "error", known.alias("label"))
    each = out.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    out = spread_join(out, each, "label", "vec_id", hot_limit(coded.count()))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
