"""Linking of arriving documents: the linker keeps no state, so it runs on a stream as it is, with any dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import linking
from ..schema import Config
from ..sources.readers import LINKED

DOCUMENT = "id string, publication_number string, language string, text string"


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files of (id, publication_number, language, text) as they come into a folder."""
    return spark.readStream.schema(DOCUMENT).parquet(folder)


def linked_stream(docs: DataFrame, dictionary: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The linked documents of a stream, against a dictionary that does not change."""
    return linking.linked_documents(linking.link_exact(docs, dictionary, cfg))


def write_linked(linked: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet files, each document once."""
    return linked.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


__all__ = ["DOCUMENT", "LINKED", "linked_stream", "read_documents", "write_linked"]
