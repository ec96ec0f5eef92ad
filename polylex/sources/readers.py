"""Readers of corpus, ontology and artifact files. Paths are arguments; schemas are explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import normalize_id
from ..schema import CACHE, CONCEPTS, LINKED, TEXT_FIELDS, VARIANT
from .reply_log import ReplyLog


def read_corpus_csv(spark: SparkSession, path: str) -> DataFrame:
    """Parallel-language rows; fields may be quoted and hold newlines, which are read as LF. Null is empty."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    cols = ("id", "language", *TEXT_FIELDS, "publication_number")
    has = set(raw.columns)
    text = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "\r\n?", "\n") if c in has else F.lit("")
    return raw.select(*(text(c).alias(c) for c in cols))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table, plain or gzipped, all strings, with the order of its rows in ``pos``.

    A gzipped file is one partition, so pos follows the file; for a plain file it follows the splits.
    No row is left out: one of too few fields has nulls for the rest, of too many the first are kept
    (ragged_rows counts them).
    """
    raw = spark.read.option("header", True).option("sep", "\t").option("quote", "").option("mode", "PERMISSIVE").csv(path)
    return raw.withColumn("pos", F.monotonically_increasing_id())


def ragged_rows(spark: SparkSession, path: str) -> DataFrame:
    """(path, short, long): how many rows of a tab-separated table have too few fields and too many; one row, zeros for an empty file."""
    lines = spark.read.text(path).where("value <> ''")
    tabs = lines.limit(1).select(F.size(F.split("value", "\t")).alias("want")).agg(F.max("want").alias("want"))  # of the header: one row
    have = lines.select(F.size(F.split("value", "\t")).alias("have")).groupBy("have").count()
    return have.join(F.broadcast(tabs)).agg(
        F.lit(path).alias("path"), F.coalesce(F.sum(F.when(F.col("have") < F.col("want"), F.col("count"))), F.lit(0)).alias("short"),
        F.coalesce(F.sum(F.when(F.col("have") > F.col("want"), F.col("count"))), F.lit(0)).alias("long"),
    )


def read_obo(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, parents): the terms of an ontology file that are not obsolete."""
    return parse_obo(spark.read.option("lineSep", "\n[Term]\n").text(path))


def parse_obo(stanzas: DataFrame) -> DataFrame:
    """(id, name, parents) from stanzas (value)."""
    v = F.substring_index(F.col("value"), "\n[Typedef]", 1)
    x = stanzas.select(v.alias("v")).select(
        normalize_id(F.regexp_extract("v", r"(?m)^id: (\S+)", 1)).alias("id"),
        F.nullif(F.regexp_extract("v", r"(?m)^name: (.*)$", 1), F.lit("")).alias("name"),
        F.regexp_extract_all("v", F.lit(r"(?m)^is_a: (CHEBI:\d+)"), 1).alias("parents"),
        F.col("v").rlike(r"(?m)^is_obsolete: true").alias("gone"),
    )
    return x.where("id is not null and not gone").drop("gone")


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """The optional crosswalk (chebi_id, qid, lang, title): the first title of a concept and language."""
    return spark.read.schema("chebi_id string, qid string, lang string, title string").json(path)


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONCEPTS).parquet(path)


def read_linked(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINKED).parquet(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, VARIANT)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(key, response): the last record of a key holds. See reply_log for the folder's runs."""
    return ReplyLog(spark, path, CACHE).read().select("key", "response")
