"""Exact duplicates: sorted runs of digests, merged up a tree and answered down again.

A partition of the rows is a run: its texts by digest, each once, with a count and the id that
stays. In a round, ``radix`` runs exchange: a run is known by the digits of its number, and the
runs that differ in one digit alone deal their digests out among themselves by that digit of
the digest. So every round merges at most ``radix`` entries of a digest, whatever the number of
copies, the runs stay of equal size, and after the last round a run is a range of digests that
holds all entries. What is then known of a digest that several rows have goes back down by the
same rounds, run by run, so no task meets more rows of one text than a partition of the input
had. Entries are one text only if a 64-bit hash, the length and the SHA-256 all agree, at every
level. DataFrame functions only.

Defined cases: a null text counts as the empty text, which is a text like any other; texts are
compared byte for byte. Of equal texts the row with the largest (or smallest) id stays, a null
id only where there is no other; of rows that share text and id one stays. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

#: Runs that exchange in a round, at most.
FAN = 16
TEXT = ("h", "size", "sha")


def tree_shape(runs: int, fan: int = FAN) -> tuple[int, int]:
    """(radix, rounds) with radix ** rounds >= runs and radix <= fan."""
    rounds = 1
    while fan**rounds < runs:
        rounds += 1
    radix = max(1, math.ceil(runs ** (1 / rounds)))
    return (radix if radix**rounds >= runs else radix + 1), rounds


def _next_run(step: int, radix: int, rounds: int) -> Column:
    """The run in which an entry of run ``run`` is after a round: the step's digit becomes the digest's."""
    place = radix**step
    return F.expr(f"run + ((pmod(h, {radix**rounds}) div {place}) % {radix} - (run div {place}) % {radix}) * {place}")


def digest_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(run, row, id, h, size, sha): a row for each of df, in runs by partition, each sorted."""
    t = df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    x = t.select(F.spark_partition_id().cast("long").alias("run"), F.monotonically_increasing_id().alias("row"), "id", F.xxhash64("t").alias("h"), F.octet_length("t").alias("size"), F.unhex(F.sha2("t", 256)).alias("sha"))
    return x.sortWithinPartitions("h")


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest", fan: int = FAN, scratch: Scratch | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, sha256): a row for each of df; keep is smallest or largest."""
    scratch = scratch or Scratch(df.sparkSession, "op12")
    rows = scratch.settle(digest_rows(df, key, text), "rows")
    radix, rounds = tree_shape((rows.agg(F.max("run")).first()[0] or 0) + 1, fan)
    largest = keep == "largest"
    best = F.max("best") if largest else F.min("best")
    place = F.struct(F.col("id").isNotNull() if largest else F.col("id").isNull(), "id", (-F.col("row") if largest else F.col("row")).alias("row"))

    def merged(entries: DataFrame, name: str) -> DataFrame:
        one = entries.groupBy("run", *TEXT).agg(best.alias("best"), F.sum("n").alias("n"))
        return scratch.settle(one.sortWithinPartitions("run", "h"), name)

    levels = [merged(rows.withColumns({"best": place, "n": F.lit(1).cast("long")}), "level-0")]
    for k in range(rounds):
        levels.append(merged(levels[-1].withColumn("run", _next_run(k, radix, rounds)), f"level-{k + 1}"))
    known = levels[-1].where("n > 1")
    for k in reversed(range(rounds)):
        above = known.withColumnRenamed("run", "up")
        below = levels[k].select("run", *TEXT).withColumn("up", _next_run(k, radix, rounds))
        known = below.join(above, ["up", *TEXT]).drop("up")
    out = rows.join(known, ["run", *TEXT], "left")
    alone = F.col("n").isNull()
    return out.select(
        "id", F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.abs("best.row") == F.col("row"))).alias("kept"), F.lower(F.hex("sha")).alias("sha256"),
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep="largest")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))
