"""The training-data pipeline: classifier, rules, near duplicates, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last give the columns of documents; the last gives the packed pieces. Nulls in any
column, empty texts, repeated rows, empty tables and further columns are handled as the
operators' modules state; a row with a null id passes the near-duplicate stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polylex.llm import near_texts, op1_quality_rules, op2_substring_dedup, op3_quality_classifier, op8_best_fit_packing
from polylex.llm.scratch import Scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of score 0.5 or more stay."""
    model = op3_quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = op3_quality_classifier.score(docs, model, carry=tuple(docs.columns))
    return scored.where("__score >= 0.5").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learnt thresholds keep."""
    scratch = Scratch(spark, "rules")
    limits = op1_quality_rules.learn(op1_quality_rules.rule_metrics(docs, carry=("lang", "source")), scratch)
    measured = op1_quality_rules.rule_metrics(docs, carry=tuple(docs.columns))
    return op1_quality_rules.apply_rules(measured, limits).where("__kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of each class of near duplicates stays; of its rows of equal words, the one of the least hash.

    Texts meet by op5's fingerprints; an exact check of their similarity follows.
    """
    classes = near_texts.near_text_classes(docs, by_fingerprints=True)
    keys = ["__doc", "__node", "__check"]
    keep = classes.select(*(F.col(f"first.{k[2:]}").alias(k) for k in keys)).distinct()
    tagged = near_texts.tag(docs.where("doc_id is not null")).withColumn("__doc", F.col("doc_id").cast("long"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    stay = tagged.join(keep, keys).groupBy(*keys).agg(F.min_by(row, F.xxhash64(row)).alias("__row")).select("__row.*")
    return stay.unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents of smaller ids have; a cut text has its words joined by a space."""
    cut = op2_substring_dedup.substring_dedup(docs, carry=True)
    less = F.col("n_removed") > 0
    new = {c: F.col("row").getField(c) for c in docs.columns if c != "text"} | {"text": F.when(less, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in new:
        new["n_chars"] = F.when(less, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return cut.select(*(new[c].alias(c) for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    out = op8_best_fit_packing.pack(docs)
    return out.select(F.col("doc").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), F.col("sequence").alias("sequence_id"), "offset")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.settle(stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL: str | None = None  # the classifier, the near duplicates and the packing are beyond SQL
