"""Language-model scores: prediction by partial matching over bytes, beside a word unigram base.

Training counts every byte of the learning texts after its three bytes of context, with a
mark (0xFF, which UTF-8 never has) for a text's start and end. The counts, shuffled and added
up, are a trie of contexts of three, two, one and no bytes. A symbol is predicted from the
longest context that has been seen. One that the context lacks costs an escape, of weight
equal to the number of different symbols seen there (method C), and goes on to the next
shorter context, where all symbols of the longer one are excluded. What a longer context has
seen its suffix has seen too, so the excluded set is one for each context and every final
probability can be worked out beforehand: ``Trie`` holds, for each context, the logarithms
for all symbols, and scoring is two table lookups for each byte of the whole text.

Every context that training has seen counts, whatever their number. The ``CONTEXTS`` most
frequent ones of three bytes (as many of a like frequency as fit) are broadcast with all that
is shorter, and the others by a bitmap of 2 MB that says which they are. What a text has after
one of those is joined with their counts instead: each different (context, symbol) is priced
once, by the same function, and then joined with the texts. So the bound chooses the way, and
no score depends on it.

The base needs the training count of every word. The ``COMMON`` most frequent words are
looked up in a broadcast list; all others are joined with the counts, one row for each
document and word. So a frequent word is no skewed key. Words are told apart by 64-bit hashes.

Defined cases: a null text is the empty one: it has the end token and the end mark alone. A
null id is learnt from and never held out. Repeated rows and ids are scored row by row.
Without training rows, N and V are 0 and bytes are uniform. An empty table gives an empty
result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import SLICE, U64, Words, signed, slices, text_buffer
from .scratch import Scratch

END = 0xFF
CONTEXTS = 1 << 16
COMMON = 1 << 17
FOLDS, HELD = 5, 1
#: Distinct items that a task adds up before it sends them on.
FLUSH = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of some texts, end marks included: (three bytes before, symbol) as a number; where each text begins."""
    n = np.diff(off)
    buf = np.full(len(data) + 4 * len(n), END, np.uint8)
    buf[np.arange(len(data)) + 4 * np.repeat(np.arange(len(n)), n) + 3] = data
    b = buf.astype(np.uint32)
    key = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    first = off[:-1] + 4 * np.arange(len(n))
    use = np.ones(len(key), bool)
    pad = (first[1:, None] - np.arange(1, 4)).ravel()  # places whose symbol is a start mark
    use[pad] = False
    return key[use], off[:-1] + np.arange(len(n))


def _tally(items: Iterator[tuple[np.ndarray, np.ndarray]], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Items and counts added up as far as memory is meant to hold them."""
    keys, counts, size = [], [], 0

    def out() -> pa.RecordBatch:
        k, c = _added(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array(k.astype(np.uint64).view(np.int64)), pa.array(c)], names=list(names))

    for k, c in items:
        keys.append(k)
        counts.append(c)
        size += len(k)
        if size > FLUSH:
            keys, counts = ([x] for x in _added(keys, counts))
            size = len(keys[0])
            if size > FLUSH // 2:
                yield out()
                keys, counts, size = [], [], 0
    if keys:
        yield out()


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def count_grams(texts: DataFrame) -> DataFrame:
    """(gram, n) of texts (text): counted in tasks, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for b in batches:
                data, off = text_buffer(b.column(0))
                for i, j in slices(off):
                    yield np.unique(grams(data[off[i] : off[j]], off[i : j + 1] - off[i])[0], return_counts=True)

        yield from _tally(items(), ("gram", "n"))

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of texts (text): hashes of lower-cased words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for b in batches:
                data, off = text_buffer(b.column(0))
                for i, j in slices(off):
                    yield np.unique(Words(_LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]).hashes(), return_counts=True)

        yield from _tally(items(), ("word", "n"))

    return texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Trie:
    """Logarithms of all symbols' probabilities in every context."""

    def __init__(self, triples: tuple[np.ndarray, np.ndarray], quads: tuple[np.ndarray, np.ndarray]):
        """triples: (two bytes and symbol, count) of all; quads: (three bytes and symbol, count) of the contexts kept."""
        key, n = triples
        count = np.zeros(256, np.float64)
        np.add.at(count, key & 0xFF, n)
        seen = np.flatnonzero(count)
        a = len(seen)  # symbols never seen share the last column
        self.rank = np.full(256, a, np.int64)
        self.rank[seen] = np.arange(a)
        self.width, r = a + 1, self.rank
        root = np.append(count[seen], 0)[None]
        left = np.log10(max(1, 256 - a))
        rows, beyond = [], np.full((1, a + 1), -left)  # log10 of each symbol in the next shorter context, what this one has excluded
        rows.append(self._final(root, beyond))
        owner = np.zeros((a + 1) ** 3, np.int32)  # of three ranks, the row of their longest context
        base, counts = 1, root
        order1 = np.zeros((a + 1, a + 1))
        np.add.at(order1, (r[(key >> 8) & 0xFF], r[key & 0xFF]), n)
        ids = np.arange(a + 1)
        counts, beyond, base = self._level(rows, owner, ids, order1, np.zeros(a + 1, np.int64), counts, beyond, base, 1)
        two = r[(key >> 16) & 0xFF] * (a + 1) + r[(key >> 8) & 0xFF]
        ids2, at = np.unique(two, return_inverse=True)
        order2 = np.zeros((len(ids2), a + 1))
        np.add.at(order2, (at, r[key & 0xFF]), n)
        counts, beyond, base = self._level(rows, owner, ids2, order2, ids2 % (a + 1), counts, beyond, base, 2)
        self.ids2, self.parent = ids2, (counts, beyond)
        key, n = quads
        three = self._contexts(key >> 8)
        ids3, at = np.unique(three, return_inverse=True)
        order3 = np.zeros((len(ids3), a + 1))
        np.add.at(order3, (at, r[key & 0xFF]), n)
        self._level(rows, owner, ids3, order3, np.searchsorted(ids2, ids3 % (a + 1) ** 2), counts, beyond, base, 3)
        self.table, self.owner = np.concatenate(rows).astype(np.float32).ravel(), owner

    def _contexts(self, ctx: np.ndarray) -> np.ndarray:
        """Numbers of three bytes by their ranks."""
        r, w = self.rank, self.width
        return (r[(ctx >> 16) & 0xFF] * w + r[(ctx >> 8) & 0xFF]) * w + r[ctx & 0xFF]

    def prices(self, ctx: np.ndarray, symbols: list[np.ndarray], counts: list[np.ndarray], asked: list[np.ndarray]) -> list[np.ndarray]:
        """log10 of the symbols asked for, in contexts of three bytes with the counts given."""
        out: list[np.ndarray] = []
        for k in range(0, len(ctx), 1024):
            part = range(k, min(k + 1024, len(ctx)))
            count = np.zeros((len(part), self.width))
            for i, j in enumerate(part):
                np.add.at(count[i], self.rank[symbols[j]], counts[j])
            parent = np.searchsorted(self.ids2, self._contexts(ctx[k : k + 1024]) % self.width**2)
            logs = self._final(count, self._beyond(count, parent, *self.parent)).astype(np.float32)
            out += [logs[i, self.rank[asked[j]]] for i, j in enumerate(part)]
        return out

    @staticmethod
    def _final(count: np.ndarray, beyond: np.ndarray) -> np.ndarray:
        total, kinds = count.sum(axis=1, keepdims=True), (count > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.where(count > 0, np.log10(count / (total + kinds)), np.log10(kinds / (total + kinds)) + beyond)
        return np.where(total > 0, out, beyond)

    @staticmethod
    def _beyond(c: np.ndarray, p: np.ndarray, up: np.ndarray, up_beyond: np.ndarray) -> np.ndarray:
        """log10 of each symbol in the next shorter contexts p, without what c has."""
        rest = np.where(c > 0, 0, up[p])
        total, kinds = rest.sum(axis=1, keepdims=True), (rest > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            x = np.where(rest > 0, np.log10(rest / (total + kinds)), np.log10(kinds / (total + kinds)) + up_beyond[p])
        return np.where(total > 0, x, up_beyond[p])  # nothing left there: on to the next at no cost

    def _level(self, rows: list, owner: np.ndarray, ids: np.ndarray, count: np.ndarray, parent: np.ndarray, up: np.ndarray, up_beyond: np.ndarray, base: int, order: int) -> tuple[np.ndarray, np.ndarray, int]:
        beyond = np.empty(count.shape, np.float32)
        for a in range(0, len(count), 4096):
            c, p = count[a : a + 4096], parent[a : a + 4096]
            beyond[a : a + 4096] = self._beyond(c, p, up, up_beyond)
            rows.append(self._final(c, beyond[a : a + 4096]).astype(np.float32))
        live = np.flatnonzero(count.sum(axis=1) > 0)
        grid = owner.reshape(-1, self.width**order)
        grid[:, ids[live]] = base + live
        return count, beyond, base + len(count)

    def logs(self, key: np.ndarray) -> np.ndarray:
        """log10 of each gram's symbol in its context."""
        r, w = self.rank, self.width
        ctx = (r[(key >> np.uint32(24))] * w + r[(key >> np.uint32(16)) & np.uint32(255)]) * w + r[(key >> np.uint32(8)) & np.uint32(255)]
        return self.table[self.owner[ctx].astype(np.int64) * w + r[key & np.uint32(255)]]


def train_trie(counts: DataFrame, contexts: int = CONTEXTS) -> tuple[Trie, DataFrame, np.ndarray]:
    """The trie of a table (gram, n), the counts that it has not, and the bitmap of their contexts."""
    counts = counts.withColumn("c", F.call_function("shiftright", "gram", F.lit(8)))
    by = counts.groupBy("c").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n")).cast("int")
    seen = {r.k: r.m for r in by.groupBy(level.alias("k")).agg(F.count("*").alias("m")).collect()}  # 63 rows at most
    floor = next(k for k in range(65) if sum(m for x, m in seen.items() if x >= k) <= contexts)
    triples = counts.groupBy(F.col("gram").bitwiseAND(0xFFFFFF).alias("g")).agg(F.sum("n").alias("n"))
    quads = counts.join(by.where(level >= floor).select("c"), "c", "left_semi").select("gram", "n")
    both = [t.toArrow() for t in (triples, quads)]  # bounded by two bytes' contexts, and by contexts
    trie = Trie(*((t.column(0).to_numpy().astype(np.int64), t.column(1).to_numpy().astype(np.float64)) for t in both))
    rare, bits = by.where(level < floor).select("c"), np.zeros(512 * 4096, np.uint8)
    if floor:
        place = F.col("c") + 1
        maps = rare.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
        for r in maps.collect():  # 512 rows of 4 KB: all contexts of three bytes
            bits[4096 * (r.k - 1) : 4096 * r.k] = np.frombuffer(r.m, np.uint8)
    return trie, counts.join(rare, "c", "left_semi"), bits


def _priced(asked: DataFrame, counts: DataFrame, trie) -> DataFrame:
    """(gram, log) of grams (gram) whose contexts are priced by counts (c, gram, n); trie: broadcast."""
    low = F.col("gram").bitwiseAND(255).cast("int")
    want = asked.groupBy(F.call_function("shiftright", "gram", F.lit(8)).alias("c")).agg(F.collect_list(low).alias("asked"))  # 256 at most
    have = counts.groupBy("c").agg(F.collect_list(F.struct(low.alias("s"), "n")).alias("have"))  # likewise

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ctx, ask, have = b.column(0).to_numpy(), b.column(1), b.column(2)
            asked = [ask[k].values.to_numpy(zero_copy_only=False) for k in range(b.num_rows)]
            held = [have[k].values for k in range(b.num_rows)]
            logs = trie.value[0].prices(ctx, [h.field(0).to_numpy(zero_copy_only=False) for h in held], [h.field(1).to_numpy(zero_copy_only=False) for h in held], asked)
            gram = [(int(c) << 8) + a.astype(np.int64) for c, a in zip(ctx, asked, strict=True)]
            if gram:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(gram)), pa.array(np.concatenate(logs).astype(np.float64))], names=["gram", "log"])

    return want.join(have, "c").select("c", "asked", "have").mapInArrow(run, "gram long, log double")


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string")) % FOLDS == HELD, F.lit(False))


def _lists(items: np.ndarray, doc: np.ndarray, docs: int) -> list[pa.Array]:
    """For each document, its distinct items and how often it has them."""
    order = np.lexsort((items, doc))
    items, doc = items[order], doc[order]
    at = np.flatnonzero(np.append(True, (items[1:] != items[:-1]) | (doc[1:] != doc[:-1]))) if len(items) else np.zeros(0, np.int64)
    times = np.diff(np.append(at, len(items))).astype(np.int32)
    starts = np.searchsorted(doc[at], np.arange(docs + 1)).astype(np.int32)
    return [pa.ListArray.from_arrays(starts, pa.array(v)) for v in (items[at], times)]


def ppm_scores(df: DataFrame, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None, common: int = COMMON, contexts: int = CONTEXTS) -> DataFrame:
    """(doc, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    scratch = scratch or Scratch(df.sparkSession, "op6")
    spark = scratch.spark
    docs = df.select(F.col(key).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    learn = docs.where(~held_out(F.col("doc"))).select("text")
    ends = learn.count()
    trie, rare_grams, bits = train_trie(scratch.settle(count_grams(learn), "grams"), contexts)
    words = scratch.settle(count_words(learn), "words")
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = total + ends, kinds + (ends > 0)
    top = words.orderBy(F.desc("n"), "word").limit(common).toArrow()  # common rows at most
    h, c = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(h)
    shared = spark.sparkContext.broadcast((trie, h[order], c[order], bits))
    end_log = float(np.log10(ends + 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known, count, bits = shared.value
        logs, some = np.log10(count + 0.5), bits.any()
        for b in batches:
            data, off = text_buffer(b.column(1))
            for i, j in slices(off, SLICE // 2):
                part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                gram, first = grams(part, o)
                log, apart = trie.logs(gram).astype(np.float64), np.zeros(0, np.int64)
                if some:
                    apart = np.flatnonzero(bits[gram >> np.uint32(11)] >> ((gram >> np.uint32(8)) & np.uint32(7)).astype(np.uint8) & 1)
                    log[apart] = 0
                score = np.add.reduceat(log, first)
                away = _lists(gram[apart].astype(np.int64), np.searchsorted(first, apart, "right") - 1, j - i)
                w = Words(_LOWER[part], o)
                word = w.hashes()
                k = np.minimum(np.searchsorted(known, word), max(0, len(known) - 1))
                hit = known[k] == word if len(known) else np.zeros(len(word), bool)
                base = np.bincount(w.doc[hit], logs[k[hit]], j - i) if len(known) else np.zeros(j - i)
                n_known = np.bincount(w.doc[hit], minlength=j - i)
                lists = [*_lists(signed(word[~hit]), w.doc[~hit], j - i), *away]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(w.n.astype(np.int64) + 1), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score), *lists], names=["doc", "n_tokens", "n_known", "base", "score", "rare", "times", "grams", "gtimes"])

    kind = docs.schema["doc"].dataType.simpleString()
    scored = docs.mapInArrow(run, f"doc {kind}, n_tokens long, n_known long, base double, score double, rare array<bigint>, times array<int>, grams array<bigint>, gtimes array<int>")
    scored = scratch.settle(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    found = rare.join(words, "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"))
    scores = scored.select("row", "doc", "n_tokens", "n_known", "base", "score").join(found, "row", "left")
    if bits.any():
        each = scored.select("row", F.explode(F.arrays_zip("grams", "gtimes")).alias("x")).select("row", F.col("x.grams").alias("gram"), F.col("x.gtimes").alias("times"))
        priced = scratch.settle(_priced(each.select("gram").distinct(), rare_grams, shared), "priced")
        scores = scores.join(each.join(priced, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("apart")), "row", "left").withColumn("score", F.col("score") + F.coalesce("apart", F.lit(0.0)))
    den = float(np.log10(total + 0.5 * (kinds + 1)))
    base = F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(den)
    return scores.select(
        "doc", held_out(F.col("doc")).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )


def op6_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("doc", "doc_id")
