"""Makes the package importable in executors' Python workers."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Add the package to the application's Python files, once for each application, and keep Arrow batches small.

    Spark serves the archive from the driver to every executor, also to those that
    start later, so no folder has to be shared for it.
    """
    if spark.conf.get(_BATCH) == "10000":  # as it comes; rows hold whole texts
        spark.conf.set(_BATCH, "1024")
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="polylex-py-")) / "polylex_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"polylex/{p.relative_to(root)}")
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
