"""Quality rules with thresholds learnt per language and source from mergeable quantile sketches.

``rule_metrics`` measures each whole text. ``bucket_sketch`` counts the metrics in
buckets of bounded relative width: integer counts, so sketches merge by addition,
give the same result in any order, and say their error (a 32nd of the value).
``fences`` reads quartiles from the sketch of each (language, source); a group of
fewer than ``MIN_GROUP`` documents takes the merged sketch of its language, and a
small language that of all. ``apply_rules`` joins the fences back and gives the
verdict.

Defined cases: a null text has no words and fails the base rule, as does an empty
one. Null language or source is a group of its own, shared with the empty string.
Repeated rows and repeated ids are judged row by row. An empty table gives an empty
result. Other columns are carried only where asked for by ``carry``, under any name
that does not begin with ``__``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kernels import U64, Words, cover, mix, range_hash, repeated, rolling, signed, slices, text_buffer
from .scratch import Scratch

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A group of fewer documents takes its thresholds from its language, or from all.
MIN_GROUP = 200
#: A fence stands FACTOR quartile ranges beyond the quartile, and at least SLACK[metric] beyond it.
FACTOR = 4
SLACK = {"symbols": 150, "dup_lines": 40, "repeats": 200, "word_len": 250}
LOWER = ("word_len",)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(b"#*$%&|<>")] = 1


def _measure(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    w, docs = Words(data, off), len(off) - 1
    salt = mix(np.arange(1, docs + 1, dtype=U64))
    out = {"n_words": w.n, "word_chars": w.sums(~w.space & ((data & 0xC0) != 0x80)), "n_symbols": w.sums(_SYMBOL[data])}
    nl = np.flatnonzero(data == 10)
    starts, ends = np.sort(np.concatenate([off[:-1], nl + 1])), np.sort(np.concatenate([nl, off[1:]]))
    line_doc = np.repeat(np.arange(docs), w.sums(data == 10) + 1)
    full = np.searchsorted(w.s, ends) > np.searchsorted(w.s, starts)
    line_doc = line_doc[full]
    later = repeated(mix(w.spans(starts[full], ends[full]) ^ salt[line_doc]))[1]
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=docs)
    at = np.arange(len(w.s))
    at = at[at + WINDOW <= w.first[1:][w.doc]]
    grams = range_hash(rolling(w.hashes()), at, at + WINDOW)
    twice = repeated(mix(grams ^ salt[w.doc[at]]))[0]
    covered = cover(at[twice], WINDOW, len(w.s))
    out["n_repeat_words"] = np.bincount(w.doc[covered], minlength=docs)
    return {k: v.astype(np.int64) for k, v in out.items()}


def rule_metrics(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """carry and the five counts, a row for each row of df. One pass, no shuffle."""
    schema = T.StructType([df.schema[c] for c in carry] + [T.StructField(f"__{c}", T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_buffer(b.column(len(carry)))
            parts = [_measure(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in slices(off)]
            cols = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], pa.int64()) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(carry)], *cols], names=schema.names)

    return df.select(*carry, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def _rates() -> dict[str, Column]:
    """Whole-numbered rates; null where there are no words."""
    n = F.when(F.col("__n_words") > 0, F.col("__n_words"))
    rate = lambda c, k: F.floor(F.col(c) * k / n)
    return {"symbols": rate("__n_symbols", 1000), "dup_lines": rate("__n_dup_lines", 1000), "repeats": rate("__n_repeat_words", 1000), "word_len": rate("__word_chars", 100)}


def bucket_of(v: Column) -> Column:
    """Bucket of a whole number of 0 or more: exact below 64, then 32 to each doubling."""
    e = (F.length(F.bin(v)) - 6).cast("int")
    return F.when(v < 64, v).otherwise(64 + (e - 1) * 32 + (F.call_function("shiftright", v, e) - 32)).cast("long")


def bucket_floor(b: Column) -> Column:
    """The least number in a bucket."""
    e = (F.floor((b - 64) / 32) + 1).cast("int")
    return F.when(b < 64, b).otherwise(F.call_function("shiftleft", (b - 64) % 32 + 32, e)).cast("long")


def bucket_sketch(metrics: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): counted map-side before the exchange."""
    each = F.array(*(F.struct(F.lit(k).alias("metric"), bucket_of(v).alias("bucket")) for k, v in _rates().items()))
    g = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__{c}")
    rows = metrics.where("__n_words > 0").select(g("lang"), g("source"), F.explode(each).alias("x"))
    return rows.groupBy("__lang", "__source", F.col("x.metric").alias("metric"), F.col("x.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups: counts added up."""
    return sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def _limits(sketch: DataFrame, *by: str) -> DataFrame:
    """A row for each group: its size, and a struct of lower and upper fences by metric."""
    spark = sketch.sparkSession
    keys = ", ".join([*by, "metric"])
    first = lambda p: f"min(bucket) FILTER (WHERE 100 * seen >= {p} * total)"
    q = spark.sql(f"""
        SELECT {keys}, max(total) AS total, {first(25)} AS b1, {first(75)} AS b3 FROM (
            SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY {keys}) AS total FROM {{sketch}})
        GROUP BY {keys}""", sketch=sketch)
    lo, hi = bucket_floor(F.col("b1")), bucket_floor(F.col("b3"))
    slack = F.create_map(*(x for k, v in SLACK.items() for x in (F.lit(k), F.lit(v))))[F.col("metric")]
    reach = F.greatest(FACTOR * (hi - lo), slack)
    q = q.withColumns({"hi": hi + reach, "lo": F.when(F.col("metric").isin(*LOWER), lo - reach).otherwise(F.lit(0))})
    aggs = [F.max(F.when(F.col("metric") == k, F.col(c))).alias(f"__{c}_{k}") for k in SLACK for c in ("lo", "hi")]
    return q.groupBy(*by).agg(F.max("total").alias("__docs"), *aggs)


def fences(sketch: DataFrame) -> DataFrame:
    """(__lang, __source) with fences: own, else the language's, else those of all documents."""
    names = [f"__{c}_{k}" for k in SLACK for c in ("lo", "hi")]
    own = _limits(sketch, "__lang", "__source")
    by_lang = _limits(merge(sketch, "__lang"), "__lang")
    of_all = _limits(merge(sketch).withColumn("__one", F.lit(1)), "__one")
    at = lambda d, p: d.select(*[c for c in d.columns if c not in names and c != "__docs"], F.struct("__docs", *names).alias(p))
    x = at(own, "o").join(at(by_lang, "l"), "__lang").join(F.broadcast(at(of_all, "a").drop("__one")))  # a single row
    pick = lambda c: F.when(F.col("o.__docs") >= MIN_GROUP, F.col(f"o.{c}")).when(F.col("l.__docs") >= MIN_GROUP, F.col(f"l.{c}")).otherwise(F.col(f"a.{c}"))
    return x.select("__lang", "__source", *(pick(c).alias(c) for c in names))


def apply_rules(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """metrics with ``__base_failed`` and ``__kept``. limits is joined, never collected."""
    rates = _rates()
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    m = metrics.withColumns({"__base_failed": (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words")), "__k1": key("lang"), "__k2": key("source")})
    lim = limits.withColumnsRenamed({"__lang": "__k1", "__source": "__k2"})
    inside = F.lit(True)
    for k, v in rates.items():
        inside &= v.between(F.col(f"__lo_{k}"), F.col(f"__hi_{k}"))
    j = m.join(lim, ["__k1", "__k2"], "left")
    return j.withColumn("__kept", ~F.col("__base_failed") & F.coalesce(inside, F.lit(False))).select(*m.columns[:-2], "__kept")


def learn(metrics: DataFrame, scratch: Scratch) -> DataFrame:
    """Fences of a table of metrics, settled, so that the join knows their size."""
    return scratch.settle(fences(scratch.settle(bucket_sketch(metrics), "sketch")), "fences")


def quality_rules(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id", "lang", "source"), scratch: Scratch | None = None) -> DataFrame:
    """Metrics and verdict of every row; the texts are read once and the metrics settled."""
    scratch = scratch or Scratch(df.sparkSession, "op1")
    metrics = scratch.settle(rule_metrics(df, text, carry), "metrics")
    return apply_rules(metrics, learn(metrics, scratch))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", *(F.col(f"__{c}").alias(c) for c in COUNTS), F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))
