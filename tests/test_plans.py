"""What the plans exchange."""

import re

from pyspark.sql import functions as F

from polylex.operators import instances, variants
from polylex.schema import TEXT_FIELDS

LINKED = "id string, publication_number string, language string, text string, mentions array<struct<surface:string,start:int,end:int,chebi_id:string>>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def saved(spark, folder, rows=400):
    """Linked rows and a corpus on disk, so that plans read columns."""
    word = F.concat_ws(" ", *(F.lit("word") for _ in range(220)))
    x = spark.range(rows).select(F.col("id").cast("string").alias("id"), F.floor(F.col("id") / 3).cast("string").alias("publication_number"), F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit("fr")), (F.col("id") % 3 + 1).cast("int")).alias("language"), word.alias("text"))
    mention = F.array(F.struct(F.lit("word").alias("surface"), F.lit(0).alias("start"), F.lit(4).alias("end"), F.lit("C1").alias("chebi_id")))
    x.withColumn("mentions", mention).write.parquet(f"{folder}/linked")
    x.select("id", "language", "publication_number", *(F.col("text").alias(f) if f == "description" else F.lit("").alias(f) for f in TEXT_FIELDS)).write.parquet(f"{folder}/corpus")
    return spark.read.schema(LINKED).parquet(f"{folder}/linked"), spark.read.parquet(f"{folder}/corpus")


def exchanged(text):
    """For each exchange that is no broadcast: the columns below it."""
    lines, out = text.split("\n"), []
    for k, line in enumerate(lines):
        if re.search(r"\bExchange\b", line):
            below = next(x for x in lines[k + 1 :] if "Project" in x or "Scan" in x or "Aggregate" in x or "HashAggregate" in x)
            out.append(below)
    return out


def test_the_source_sample_exchanges_no_texts(spark, tmp_path):
    linked, corpus = saved(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        langs = variants.available_languages(corpus)
        sample = variants.sample_rows(linked, langs)
        for df in (variants.choose_rows(variants.qualifying_rows(linked, langs)), variants.with_fields(sample, corpus), variants.parallel_rows(linked, sample)):
            below = exchanged(plan(df))
            assert below and not any(re.search(r"\b(text|mentions|description)#", x) for x in below)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = variants.with_fields(sample, corpus).collect()
    assert len(rows) == 80 and len({r.publication_number for r in rows}) == 80


def test_a_stratum_is_cut_before_it_is_exchanged(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("chebi_id"), (2 + F.col("id") % 2).alias("star"), (F.col("id") % 3).alias("alias_lang_count"), F.col("id").cast("string").substr(1, 1).alias("coarse"))
    sample = instances.balanced_sample(rows)
    text = plan(sample)
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")
    assert sample.count() == 80
