"""Linking of arriving documents against a dictionary that changes.

``publish`` adds a version of the dictionary. Each micro-batch of ``link_versions`` is linked by
one version, the last when the batch was first tried, which is noted before anything is
written; a batch that is tried again after a failure takes the same version and overwrites its
own folder, so its documents are there once. ``linked_now`` gives all documents as the last
version links them: of those linked by an earlier one, only texts with a changed key are linked
again (linking.changed_keys). A version's index is packed once in a session, not for each batch.

Defined cases: batches that never finished are not read; a null text has no mentions; without a
version a batch fails and is tried again when the stream is next started. Changed keys are
sought from one version to the last, however many lie between.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import key_index, linking
from ..schema import LINKED, Config
from ..sources.reply_log import hadoop_folder

_PUBLISHED: dict[tuple[str, str], str] = {}


def _finished(spark: SparkSession, path: str, what: str) -> list[int]:
    """The numbers of the folders what=n in path that Spark has finished."""
    fs, p = hadoop_folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{what}=") and fs.exists(hadoop_folder(spark, f"{path}/{n}/_SUCCESS")[1]))


def publish(dictionary: DataFrame, path: str) -> int:
    """One more version of the dictionary (lang, key, chebi_id, reg_order); gives its number."""
    n = max(_finished(dictionary.sparkSession, path, "version"), default=0) + 1
    dictionary.write.mode("overwrite").parquet(f"{path}/version={n}")
    return n


def _dictionary(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def _index(spark: SparkSession, path: str, version: int, cfg: Config) -> str:
    of = f"{path}/version={version}"
    key = (spark.sparkContext.applicationId, of)
    if key not in _PUBLISHED:
        _PUBLISHED[key] = key_index.publish(_dictionary(spark, path, version), cfg.keys_in_part)
    return _PUBLISHED[key]


def link_batch(batch: DataFrame, number: int, dictionaries: str, out: str, cfg: Config = Config()) -> None:
    """Links a micro-batch into its own folder."""
    spark = batch.sparkSession
    note = f"{out}/_versions/batch={number}"
    if number not in _finished(spark, f"{out}/_versions", "batch"):
        version = max(_finished(spark, dictionaries, "version"), default=0)
        if not version:
            raise ValueError(f"no version of a dictionary in {dictionaries}")
        spark.range(1).select(F.lit(version).alias("version")).write.mode("overwrite").json(note)
    version = spark.read.schema("version int").json(note).first()[0]
    linked = linking.linked_documents(linking.link_by_index(batch, _index(spark, dictionaries, version, cfg), cfg.whole_characters))
    linked.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{out}/batch={number}")


def link_versions(docs: DataFrame, dictionaries: str, out: str, checkpoint: str, cfg: Config = Config()) -> StreamingQuery:
    """Links the stream docs (id, publication_number, language, text) up to what has arrived, each batch by one version."""
    todo = lambda batch, number: link_batch(batch, number, dictionaries, out, cfg)
    return docs.writeStream.foreachBatch(todo).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def linked_as_written(spark: SparkSession, out: str) -> DataFrame:
    """The finished batches, with the version that each document was linked by."""
    schema = StructType([*StructType.fromDDL(LINKED).fields]).add("version", "integer")
    done = [f"{out}/batch={n}" for n in _finished(spark, out, "batch")]
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def linked_now(spark: SparkSession, dictionaries: str, out: str, cfg: Config = Config()) -> DataFrame:
    """All documents of the finished batches as the last version links them."""
    docs, last = linked_as_written(spark, out), max(_finished(spark, dictionaries, "version"))
    done = sorted(r.version for r in docs.select("version").distinct().collect())  # one for each version in use
    parts = [docs.where(F.col("version") == last).drop("version")]
    for v in (v for v in done if v != last):
        old = docs.where(F.col("version") == v)
        changed = linking.changed_keys(_dictionary(spark, dictionaries, v), _dictionary(spark, dictionaries, last))
        marked = linking.mark_with_a_key(old, changed, cfg)
        parts.append(marked.where("not touched").drop("version", "touched"))
        again = marked.where("touched").select("id", "publication_number", "language", "text")
        parts.append(linking.linked_documents(linking.link_by_index(again, _index(spark, dictionaries, last, cfg), cfg.whole_characters)))
    return reduce(DataFrame.unionByName, parts)
