"""Quality classifier: random-indexing word vectors, pooled, under a small calibrated network.

Every token has a sparse random index vector, drawn from its hash. A word's vector is the sum
of the index vectors of what stands around it in the training texts: its neighbours, its own
shape and theirs (letters, digits and marks, with runs cut to two), and whether the word
before is the same and whether the four words from here have come before in the text. Shapes and these
marks are words of their own with such vectors. Vectors lie in a table of ``ROWS`` rows by
hash, so its size does not grow with the corpus. A document is the mean of its words'
vectors, the mean of its shapes' and marks' vectors, and the logarithm of its length. Two
layers in numpy give a logit; a temperature, fitted on a part of the sample that the network
has not learnt from, turns it into a probability.

Training reads at most ``TRAIN_ROWS`` labelled ids, those with the least hashes, as far as their
texts have ``TRAIN_BYTES`` bytes together, so one task can learn from them; an id whose texts have
more than ``TRAIN_TEXT`` bytes is passed over. The driver gets the model alone, of a fixed size, and
a task that is lost learns the same again. Scoring is one pass over the whole texts.

Defined cases: null and empty texts, and texts without words, score 0; a null id is never
held out and never learnt from; an id with several labels counts as its greatest; without
two kinds of labels every text with words scores the labels' mean, or 0.5 without any; an
empty table gives an empty result. Labels, language, source and id are never inputs.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship
from .kernels import U64, Words, mix, range_hash, repeated, rolling, slices, text_buffer

DIM = 64
ROWS = 1 << 15
NONZERO = 6
HIDDEN = 32
TRAIN_ROWS = 4000
TRAIN_BYTES = 32 << 20
TRAIN_TEXT = 1 << 20
EPOCHS = 60
FOLDS, HELD = 3, 1
#: Bytes of text whose vectors are held at a time.
PART = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.arange(256, dtype=np.uint8)  # of each byte, in a shape
_CLASS[97:123] = _CLASS[128:256] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48


def _index(h: np.ndarray) -> np.ndarray:
    """Sparse index vectors of hashes."""
    out = np.zeros((len(h), DIM), np.float32)
    rows = np.arange(len(h))
    for k in range(NONZERO):
        place = ((h >> U64(8 * k)) & U64(DIM - 1)).astype(np.int64)
        sign = 1 - 2 * ((h >> U64(8 * k + 7)) & U64(1)).astype(np.float32)
        np.add.at(out, (rows, place), sign)
    return out


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words with hashes of the words, of their shapes and of their marks."""
    w = Words(_LOWER[data], off)
    cls = _CLASS[data]
    keep = np.ones(len(data), bool)
    keep[2:] = (cls[2:] != cls[1:-1]) | (cls[2:] != cls[:-2]) | w.space[2:]
    keep[off[:-1][off[:-1] < len(data)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    shape = Words(cls[keep], at[off]).hashes()
    word = w.hashes()
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (w.doc[1:] == w.doc[:-1])
    i = np.arange(len(word))
    i = i[i + 4 <= w.first[1:][w.doc]]
    again = np.zeros(len(word), bool)
    again[i] = repeated(mix(range_hash(rolling(word), i, i + 4) ^ mix((w.doc[i] + 1).astype(U64))))[1]
    mark = mix((1 + same + 2 * again).astype(U64))
    return w, word, mix(shape), mark


def word_vectors(texts: pa.Array) -> np.ndarray:
    """The table of word vectors, from what stands around each word in the texts."""
    table = np.zeros((ROWS, DIM), np.float32)
    data, off = text_buffer(texts)
    for a, z in slices(off, PART):
        w, word, shape, mark = _tokens(data[off[a] : off[z]], off[a : z + 1] - off[a])
        own = _index(shape) + _index(mark)
        side = _index(word) + own
        near = own.copy()
        link = w.doc[1:] == w.doc[:-1]
        near[1:][link] += side[:-1][link]
        near[:-1][link] += side[1:][link]
        for h in (word, shape, mark):
            np.add.at(table, (h % U64(ROWS)).astype(np.int64), near)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.maximum(norm, 1e-6)


def pooled(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each text, and its number of words."""
    data, off = text_buffer(texts)
    out, count = [np.zeros((0, 2 * DIM + 1), np.float32)], [np.zeros(0, np.int64)]
    for a, z in slices(off, PART):
        w, word, shape, mark = _tokens(data[off[a] : off[z]], off[a : z + 1] - off[a])
        f = np.zeros((z - a, 2 * DIM + 1), np.float32)
        full = np.flatnonzero(w.n)
        if len(full):
            rows = [(h % U64(ROWS)).astype(np.int64) for h in (word, shape, mark)]
            n = w.n[full][:, None].astype(np.float32)
            f[full, :DIM] = np.add.reduceat(table[rows[0]], w.first[full], axis=0) / n
            f[full, DIM:-1] = np.add.reduceat(table[rows[1]] + table[rows[2]], w.first[full], axis=0) / n
            f[full, -1] = np.log1p(w.n[full])
        out.append(f)
        count.append(w.n)
    return np.concatenate(out), np.concatenate(count)


class Network:
    """Standardised inputs, one hidden layer, a logit, a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        check, train = order[: len(x) // 5], order[len(x) // 5 :]
        self.mean, self.sd = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
        n, half = x.shape[1], 0.5
        self.w1, self.b1 = rng.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2, self.heat = rng.normal(0, HIDDEN**-half, HIDDEN), 0.0, 1.0
        m = [np.zeros_like(p, dtype=float) for p in (self.w1, self.b1, self.w2, np.zeros(()))]
        v, step = [p.copy() for p in m], 0
        for _ in range(EPOCHS):
            for part in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
                z = (x[part] - self.mean) / self.sd
                hid = np.tanh(z @ self.w1 + self.b1)
                err = (_sigmoid(hid @ self.w2 + self.b2) - y[part]) / len(part)
                back = err[:, None] * self.w2 * (1 - hid**2)
                grads = [z.T @ back + 1e-4 * self.w1, back.sum(axis=0), hid.T @ err + 1e-4 * self.w2, err.sum()]
                step += 1
                new = []
                for k, (p, g) in enumerate(zip((self.w1, self.b1, self.w2, self.b2), grads, strict=True)):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    new.append(p - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
                self.w1, self.b1, self.w2, self.b2 = new
        if len(check):
            logit, goal = self.logit(x[check]), y[check]
            loss = lambda t: np.mean(np.logaddexp(0, logit / t) - goal * logit / t)
            self.heat = float(min(np.geomspace(0.25, 8, 101), key=loss))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.sd) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x) / self.heat)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string")) % FOLDS == HELD, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> tuple[np.ndarray, Network | float]:
    """Word vectors and network from a bounded sample of the labelled rows that are not held out."""
    y = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__id")).agg(F.max(label).cast("double").alias("__y"))
    x = docs.select(F.col(key).alias("__id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text")).where(~held_out(F.col("__id")))
    size = x.groupBy("__id").agg(F.sum(F.octet_length("__text")).alias("__size"), F.count("*").alias("__rows"))
    first = size.join(y, "__id").where(F.col("__size") <= TRAIN_TEXT).orderBy(F.xxhash64("__id"), "__id").limit(TRAIN_ROWS)
    total = {c: F.sum(c).over(Window.orderBy(F.xxhash64("__id"), "__id")) for c in ("__size", "__rows")}  # over TRAIN_ROWS rows at most
    ids = first.select("__id", "__y", *(t.alias(f"{c}_sum") for c, t in total.items())).where((F.col("__size_sum") <= TRAIN_BYTES) & (F.col("__rows_sum") <= TRAIN_ROWS)).select("__id", "__y")
    sample = x.join(F.broadcast(ids), "__id").orderBy(F.xxhash64("__id"), "__id", "__text").limit(TRAIN_ROWS).select("__text", "__y")  # TRAIN_ROWS ids at most are broadcast
    ship(docs.sparkSession)
    models = sample.mapInArrow(_learn, "model binary").collect()  # a limit has one partition
    return pickle.loads(models[0].model) if models else _fitted(pa.array([], pa.string()), np.zeros(0))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    texts = pa.concat_arrays([pa.array([], pa.string()), *(b.column(0) for b in held)])
    goal = np.concatenate([np.zeros(0), *(b.column(1).to_numpy() for b in held)])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_fitted(texts, goal))], pa.binary())], names=["model"])


def _fitted(texts: pa.Array, goal: np.ndarray) -> tuple[np.ndarray, Network | float]:
    table = word_vectors(texts)
    if len(np.unique(goal)) < 2:
        return table, float(goal.mean()) if len(goal) else 0.5
    feats, n = pooled(texts, table)
    return table, Network(feats[n > 0].astype(np.float64), goal[n > 0])


def score(docs: DataFrame, model: tuple[np.ndarray, Network | float], text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry and __score of every row: one pass."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size and a network
    schema = T.StructType([docs.schema[c] for c in carry] + [T.StructField("__score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, net = shared.value
        for b in batches:
            col = b.column(len(carry))
            x, n = pooled(col, table)
            p = np.full(len(n), net) if isinstance(net, float) else net.score(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(carry)], pa.array(np.where(n > 0, p, 0.0))], names=schema.names)

    return docs.select(*carry, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
