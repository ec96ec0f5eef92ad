"""Incremental removal of repeated 50-word passages by a log of sorted fingerprint runs.

A window is 50 consecutive words. Its fingerprint is the least hash among its 16-word
hashes: equal windows have equal fingerprints, and neighbouring windows mostly share
one, so a document's windows fall into stretches (about one for 18 words). A stretch is
a row (fingerprint, digest of its words, document).

``FingerprintLog`` holds what earlier batches had, in immutable runs of three tables: stretches
and windows, each with its least document, and spans, which say of a fingerprint whether it has
one stretch or several. They are bucketed and sorted by their keys, a batch's own tables too, so
a batch is merge-joined with each run without any exchange of history. Runs of like size are
compacted into one by the same kind of join. A manifest beside the runs lets a later session
open the log again.

* A stretch whose words are those of a stretch in a smaller document goes as a whole.
  Counted map-side first; groups of copies cost a row each, never pairs.
* Fingerprints with several different stretches are settled window by window: the first
  document of each different stretch is read again, and the digests of its windows' own words
  decide. What that gives is kept in the log, so of history only the one document of a
  fingerprint that had a single stretch so far is ever read again.
* Every removal is verified on the words, by a digest of 64 bits besides the fingerprint's 64.

Defined cases: null text has no words; documents below 50 words lose nothing; rows with a
null id neither lose words nor cause loss; rows that share an id never remove each other's
words, as no smaller id has them; empty tables give empty results; only id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import U64, Words, range_hash, rolling, signed, slices, text_buffer
from .scratch import Scratch

WINDOW = 50
GRAM = 16
#: Batches into which one table is cut by the query; an incremental user passes each day's batch instead.
BATCHES = 3


class Windows(Words):
    """Words with fingerprints of their windows, and the text with single spaces."""

    def __init__(self, data: np.ndarray, off: np.ndarray, window: int = WINDOW, gram: int = GRAM):
        super().__init__(data, off)
        self.window, n = window, len(self.s)
        last = self.first[1:][self.doc]
        at = np.arange(n)
        grams = np.full(n, np.iinfo(np.uint64).max, U64)
        ok = at[at + gram <= last]
        grams[ok] = range_hash(rolling(self.hashes()), ok, ok + gram)
        self.at = at[at + window <= last]  # where a window starts
        width, have = window - gram + 1, 1
        while have * 2 <= width:  # least of 1, 2, 4, ... hashes from each word on
            grams[: max(0, n - have)] = np.minimum(grams[: max(0, n - have)], grams[have:])
            have *= 2
        self.mark = np.minimum(grams[self.at], grams[self.at + width - have]) if len(self.at) else grams[:0]
        new = np.ones(len(self.at), bool)
        if len(new):
            new[1:] = (self.mark[1:] != self.mark[:-1]) | (np.diff(self.at) != 1) | (np.diff(self.doc[self.at]) != 0)
        self.run = np.flatnonzero(new)  # index into at of each stretch's first window
        self.run_end = np.append(self.run[1:], len(self.at)) if len(self.run) else self.run
        lens = self.e - self.s
        self.pos = np.concatenate([[0], np.cumsum(lens + 1)])  # where each word starts, joined by a space
        flat = np.full(int(self.pos[-1]), 32, np.uint8)
        flat[np.arange(int(lens.sum())) + np.repeat(at, lens)] = data[~self.space]
        self.flat = flat.tobytes()

    def digest(self, a: int, b: int) -> int:
        """64 bits of the words a to b - 1."""
        d = hashlib.blake2b(self.flat[self.pos[a] : self.pos[b] - 1], digest_size=8).digest()
        return int.from_bytes(d, "little", signed=True)

    def stretches(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Document, fingerprint and digest of each stretch."""
        a, b = self.at[self.run], self.at[self.run_end - 1] + self.window if len(self.run) else self.run
        lo, hi, flat = self.pos[a].tolist(), (self.pos[b] - 1).tolist(), self.flat
        take, num = hashlib.blake2b, int.from_bytes
        return self.doc[a], self.mark[self.run], [num(take(flat[x:y], digest_size=8).digest(), "little", signed=True) for x, y in zip(lo, hi, strict=True)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(h, x, doc): the stretches of docs (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(1))
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j in slices(off):
                d, h, x = Windows(data[off[i] : off[j]], off[i : j + 1] - off[i]).stretches()
                yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(x, pa.int64()), pa.array(ids[i:j][d], pa.int64())], names=["h", "x", "doc"])

    return docs.where("doc is not null").mapInArrow(run, "h long, x long, doc long")


def _windows(docs: DataFrame) -> DataFrame:
    """(h, x, doc): digests of those windows of docs (doc, text, marks) whose fingerprint is in marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(1))
            ids, marks = b.column(0).to_numpy(zero_copy_only=False), b.column(2)
            for i, j in slices(off):
                w = Windows(data[off[i] : off[j]], off[i : j + 1] - off[i])
                doc = w.doc[w.at] if len(w.at) else w.at
                edge = np.searchsorted(doc, np.arange(j - i + 1))
                for k in range(j - i):
                    own = w.mark[edge[k] : edge[k + 1]]
                    hit = np.flatnonzero(np.isin(signed(own), marks[i + k].values.to_numpy(zero_copy_only=False))) + edge[k]
                    if len(hit):
                        x = [w.digest(a, a + WINDOW) for a in w.at[hit].tolist()]
                        yield pa.RecordBatch.from_arrays([pa.array(signed(w.mark[hit])), pa.array(x, pa.int64()), pa.array(np.full(len(hit), ids[i + k]), pa.int64())], names=["h", "x", "doc"])

    return docs.mapInArrow(run, "h long, x long, doc long")


def _cut(docs: DataFrame) -> DataFrame:
    """(doc, n_words, n_removed, kept): docs (doc, text, whole, single); the two lists hold (h, x) of dead stretches and windows.

    With a column row in docs, each row's text and row follow."""
    extra = ["text", "row"] if "row" in docs.columns else []
    schema = T.StructType([*T.StructType.fromDDL("doc long, n_words long, n_removed long, kept string").fields, *(docs.schema[c] for c in extra)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(1))
            whole, single = b.column(2), b.column(3)
            some = ~(np.asarray(whole.is_null()) & np.asarray(single.is_null()))
            for i, j in slices(off):
                w = Windows(data[off[i] : off[j]], off[i : j + 1] - off[i])
                doc = w.doc[w.at] if len(w.at) else w.at
                edge, redge = np.searchsorted(doc, np.arange(j - i + 1)), np.searchsorted(doc[w.run] if len(w.run) else w.run, np.arange(j - i + 1))
                gone, kept = np.zeros(len(w.s) + 1, np.int64), []
                for k in range(j - i):
                    if some[i + k]:
                        _mark_dead(w, gone, _pairs(whole[i + k]), _pairs(single[i + k]), edge[k : k + 2], redge[k : k + 2])
                dead = np.cumsum(gone[:-1]) > 0
                for k in range(j - i):
                    a, z = w.first[k], w.first[k + 1]
                    if some[i + k] and dead[a:z].any():
                        live = np.flatnonzero(~dead[a:z]) + a
                        kept.append(b" ".join([w.flat[w.pos[x] : w.pos[x + 1] - 1] for x in live.tolist()]))
                    else:
                        kept.append(w.flat[w.pos[a] : max(w.pos[a], w.pos[z] - 1)])
                removed = np.bincount(w.doc[dead], minlength=j - i) if len(dead) else np.zeros(j - i, np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(w.n.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string()), *(b.column(c).slice(i, j - i) for c in extra)], names=schema.names)

    return docs.mapInArrow(run, schema)


def _pairs(cell: pa.Scalar) -> dict[int, set[int]]:
    out: dict[int, set[int]] = {}
    if cell.is_valid:
        v = cell.values
        for h, x in zip(v.field(0).to_pylist(), v.field(1).to_pylist(), strict=True):
            out.setdefault(h, set()).add(x)
    return out


def _mark_dead(w: Windows, gone: np.ndarray, whole: dict, single: dict, edge: np.ndarray, redge: np.ndarray) -> None:
    if whole:
        for r in range(*redge):
            known = whole.get(int(signed(w.mark[w.run[r] : w.run[r] + 1])[0]))
            if known:
                a, z = w.at[w.run[r]], w.at[w.run_end[r] - 1] + w.window
                if w.digest(a, z) in known:
                    gone[a] += 1
                    gone[z] -= 1
    if single:
        marks = signed(w.mark[edge[0] : edge[1]])
        for k in np.flatnonzero(np.isin(marks, list(single))).tolist():
            a = w.at[edge[0] + k]
            if w.digest(a, a + w.window) in single[int(marks[k])]:
                gone[a] += 1
                gone[a + w.window] -= 1


#: The tables of a run and their keys.
TABLES = {"stretches": ("h", "x"), "spans": ("h",), "windows": ("h", "x")}
#: A key with more than one in so many of all rows is hot, so there are fewer hot keys than this; their
#: rows are spread over so many tasks where they meet the key's verdict.
HOT, SALTS = 2000, 64


class FingerprintLog:
    """Immutable runs of stretches (h, x, own), spans (h, lo, hi, own) and windows (h, x, own) in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.label = "polylex_" + uuid.uuid4().hex
        self.runs: list[tuple[str, int]] = []  # name and number of stretches
        self.made = self.version = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> FingerprintLog:
        """The log that an earlier session left in the folder."""
        log = cls(spark, folder)
        files = [f.getPath().getName() for f in log._files().listStatus(log._path(""))]
        log.version = max(int(n[9:-5]) for n in files if n.startswith("manifest-"))
        text = spark.read.text(f"{log.folder}/manifest-{log.version}.json", wholetext=True).first()[0]
        known = json.loads(text)
        log.buckets, log.made, log.runs = known["buckets"], known["made"], [tuple(r) for r in known["runs"]]
        for name, _ in log.runs:
            for kind, keys in TABLES.items():
                cols = ", ".join(f"{c} BIGINT" for c in _COLUMNS[kind])
                by = ", ".join(keys)
                spark.sql(f"CREATE TABLE {log._table(name, kind)} ({cols}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {log.buckets} BUCKETS LOCATION '{log.folder}/{name}/{kind}'")
        return log

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _table(self, name: str, kind: str) -> str:
        return f"{self.label}_{name}_{kind}"

    def table(self, name: str, kind: str) -> DataFrame:
        return self.spark.table(self._table(name, kind))

    def tables(self, kind: str) -> list[DataFrame]:
        return [self.table(name, kind) for name, _ in self.runs]

    def new_name(self) -> str:
        self.made += 1
        return f"run{self.made}"

    def write(self, rows: DataFrame, name: str, kind: str) -> DataFrame:
        """rows, one for each key and dealt by the keys already, as a table of a run."""
        keys = TABLES[kind]
        rows.write.option("path", f"{self.folder}/{name}/{kind}").bucketBy(self.buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(self._table(name, kind))
        return self.table(name, kind)

    def drop(self, name: str) -> None:
        for kind in TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name, kind)}")
        self._files().delete(self._path(name), True)

    def append(self, name: str) -> None:
        """Takes a written run in; then the newest two are compacted while the older one is not twice as large."""
        self.runs.append((name, self.table(name, "stretches").count()))
        old: list[str] = []
        while len(self.runs) > 1 and self.runs[-2][1] <= 2 * self.runs[-1][1]:
            (a, _), (b, _) = self.runs[-2:]
            new = self.new_name()
            for kind, keys in TABLES.items():
                x, y = (self.table(n, kind) for n in (a, b))
                both = {"lo": F.least(x["lo"], y["lo"]), "hi": F.greatest(x["hi"], y["hi"])} if kind == "spans" else {}
                merged = x.join(y, [x[k] == y[k] for k in keys], "full").select(*(F.coalesce(x[k], y[k]).alias(k) for k in keys), *(c.alias(n) for n, c in both.items()), F.least(x["own"], y["own"]).alias("own"))
                self.write(merged, new, kind)
            self.runs[-2:] = [(new, self.table(new, "stretches").count())]
            old += [a, b]
        self._save()
        for n in old:  # nothing names them any more
            self.drop(n)

    def _save(self) -> None:
        """A new manifest; the one before goes when it is there, so that there is one at any time."""
        self.version += 1
        out = self._files().create(self._path(f"manifest-{self.version}.json"), True)
        out.write(bytearray(json.dumps({"buckets": self.buckets, "made": self.made, "runs": self.runs}).encode()))
        out.close()
        self._files().delete(self._path(f"manifest-{self.version - 1}.json"), False)

    def close(self, keep: bool = True) -> None:
        """Takes the tables from the session's catalog; with keep, the files stay for open()."""
        for name, _ in self.runs:
            for kind in TABLES:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name, kind)}")
        if not keep:
            self._files().delete(self._path(""), True)


_COLUMNS = {"stretches": ("h", "x", "own"), "spans": ("h", "lo", "hi", "own"), "windows": ("h", "x", "own")}


def _firsts(new: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """new (h, x, own, top, n) with the least document of all and whether no run has the key: merge joins of buckets."""
    out = new
    for k, run in enumerate(runs):
        out = out.join(run.select("h", "x", F.col("own").alias(f"own{k}")), ["h", "x"], "left")
    olds = [F.col(f"own{k}") for k in range(len(runs))]
    fresh = F.lit(True)
    for o in olds:
        fresh &= o.isNull()
    return out.select("h", "x", "own", "top", "n", (F.least("own", *olds) if olds else F.col("own")).alias("least"), fresh.alias("fresh"))


def _dead(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The (doc, h, x) of rows (settled) that a smaller document has."""
    many = F.col("n") > max(1000, rows.count() // HOT)
    salts = F.explode(F.sequence(F.lit(0), F.when(many, SALTS - 1).otherwise(0)))
    gone = firsts.where("top > least").select("h", "x", "least", salts.alias("salt"))
    hot = firsts.where(many & (F.col("top") > F.col("least"))).select("h", "x", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc"), F.lit(SALTS))).otherwise(0).cast("int")
    salted = rows.join(F.broadcast(hot), ["h", "x"], "left").withColumn("salt", salt)  # fewer than HOT keys
    return salted.join(gone, ["h", "x", "salt"]).where("doc > least").select("doc", "h", "x")


def _of_mixed(rows: DataFrame, mixed: DataFrame, many: DataFrame) -> DataFrame:
    """The rows (h, x, own) of the keys in mixed (h, ...); those of the keys in many (h, n) are spread over SALTS tasks."""
    hot = F.broadcast(many.select("h", F.lit(True).alias("hot")))
    salts = F.explode(F.sequence(F.lit(0), F.when(F.col("hot"), SALTS - 1).otherwise(0)))
    right = mixed.select("h").join(hot, "h", "left").select("h", salts.alias("salt"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("x"), F.lit(SALTS))).otherwise(0).cast("int")
    return rows.join(hot, "h", "left").withColumn("salt", salt).join(right, ["h", "salt"], "left_semi")


def dedup_batch(batch: DataFrame, log: FingerprintLog, corpus: DataFrame, scratch: Scratch, tag: str, append: bool = True) -> DataFrame:
    """(doc, n_words, n_removed, kept) of a batch (doc, text) whose ids are above those of the log.

    corpus (doc, text) holds the texts of the batch and of what the log has; only the
    documents that a verification needs are read from it. Where both are bucketed by doc,
    no text is exchanged. A column row of the batch is carried.
    """
    name = log.new_name()
    rows = scratch.settle(fingerprints(batch), f"{tag}-rows")
    ends = (F.min("doc").alias("own"), F.max("doc").alias("top"), F.count("*").alias("n"))
    new = log.write(rows.groupBy("h", "x").agg(*ends), name, "stretches")
    firsts = _firsts(new, log.tables("stretches"))
    whole = _dead(rows, firsts)
    span = log.write(new.groupBy("h").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.min("own").alias("own")), name, "spans")
    state = span.select("h", "lo", "hi")
    for k, run in enumerate(log.tables("spans")):
        state = state.join(run.select("h", F.col("lo").alias(f"lo{k}"), F.col("hi").alias(f"hi{k}"), F.col("own").alias(f"own{k}")), "h", "left")
    n = range(len(log.runs))
    low, high, own = (f("__none", "__none", *(f"{c}{k}" for k in n)) for f, c in ((F.least, "lo"), (F.greatest, "hi"), (F.least, "own")))
    state = state.withColumn("__none", F.lit(None).cast("long")).select("h", "lo", "hi", low.alias("low"), high.alias("high"), own.alias("single"))
    mixed = scratch.settle(state.where("least(lo, low) <> greatest(hi, high)").select("h", F.when(F.col("low") == F.col("high"), F.col("single")).alias("single")), f"{tag}-mixed")
    limit = max(1000, rows.count() // HOT)
    hot = new.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > limit)  # fewer than HOT
    many = scratch.settle(hot.join(mixed, "h", "left_semi"), f"{tag}-many")
    readers = _of_mixed(firsts.where("fresh").select("h", "x", "own"), mixed, many).select("h", F.col("own").alias("doc"))
    readers = readers.unionByName(mixed.where("single is not null").select("h", F.col("single").alias("doc")))
    marks = scratch.settle(readers.groupBy("doc").agg(F.collect_set("h").alias("marks")), f"{tag}-marks")
    read = _windows(corpus.join(marks, "doc").select("doc", "text", "marks"))
    windows = scratch.settle(read.distinct(), f"{tag}-windows")
    seen = log.write(windows.groupBy("h", "x").agg(*ends), name, "windows")
    single = _dead(windows, _firsts(seen, log.tables("windows")))
    both = whole.withColumn("k", F.lit(0)).unionByName(single.withColumn("k", F.lit(1)))
    pair = F.struct("h", "x")
    lists = both.groupBy("doc").agg(*(F.collect_set(F.when(F.col("k") == k, pair)).alias(n) for k, n in enumerate(("whole", "single"))))
    lists = scratch.settle(lists, f"{tag}-lists")
    if append:
        log.append(name)
    else:
        log.drop(name)
    for part in ("rows", "mixed", "many", "marks", "windows"):
        scratch.drop(f"{tag}-{part}")
    return _cut(batch.join(lists, "doc", "left").select("doc", "text", "whole", "single", *batch.columns[2:]))


def substring_dedup(df: DataFrame, doc: str = "doc_id", text: str = "text", batches: int = BATCHES, scratch: Scratch | None = None, carry: bool = False) -> DataFrame:
    """One table as successive batches by ascending id: (doc, n_words, n_removed, kept), a row for each row.

    With carry, also each row's text and, as a struct named row, its other columns: an id does not tell rows apart."""
    scratch = scratch or Scratch(df.sparkSession, "op2")
    log = FingerprintLog(scratch.spark, scratch.path("log"))
    extra = [F.struct(*(F.col(f"`{c}`") for c in df.columns if c != text)).alias("row")] * carry
    every = df.select(F.col(doc).cast("long").alias("doc"), F.col(text).cast("string").alias("text"), *extra)
    # dealt by id once: no later step exchanges texts
    name = f"{log.label}_docs"
    dealt = every.where("doc is not null").repartition(log.buckets, "doc")
    dealt.write.option("path", scratch.path("docs")).bucketBy(log.buckets, "doc").mode("overwrite").saveAsTable(name)
    docs = scratch.spark.table(name)
    cuts = sorted(set(docs.approxQuantile("doc", [k / batches for k in range(1, batches)], 0.01))) if batches > 1 else []
    edges, out = [None, *(int(c) for c in cuts), None], None
    for k in range(len(edges) - 1):
        lo, hi = edges[k], edges[k + 1]
        here = F.lit(True) if hi is None else F.col("doc") <= hi
        batch = docs.where(here if lo is None else here & (F.col("doc") > lo))
        done = dedup_batch(batch, log, docs.where(here), scratch, f"b{k}", append=hi is not None)
        out = done if out is None else out.unionByName(done)
    log.close(keep=False)
    scratch.spark.sql(f"DROP TABLE {name}")  # its files stay, as results read them
    none = [F.lit(None).cast("array<struct<h:bigint,x:bigint>>").alias(c) for c in ("whole", "single")]
    return out.unionByName(_cut(every.where("doc is null").select("doc", "text", *none, *every.columns[2:])))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
