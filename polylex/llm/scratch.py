"""Shared-folder tables: lineage is cut by writing Parquet where every executor can read it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..shared import shared_root
from ..shipping import ship


class Scratch:
    """Named tables of one run, in a folder of its own below the shared root."""

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.dir = f"{shared_root(spark)}/polylex/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}"

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as Parquet and read it back: the lineage ends here."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.dir)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
