"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; own folder only where that is unset.

    Unset and local master: a temporary folder. Unset on a cluster: a folder
    beside the warehouse tables, which all executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.applicationId not in _OWN:
        if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="polylex-")
        else:
            _OWN[sc.applicationId] = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_polylex"
    return _OWN[sc.applicationId]


def settle(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as Parquet to a new path of that folder and read from there, and the path: plans over it stay small."""
    path = f"{shared_root(df.sparkSession)}/polylex/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def is_there(spark: SparkSession, path: str) -> bool:
    """Whether a settled table has not been cleared away."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
