"""Replies from outside that must not be lost: committed runs of JSON lines in one folder.

A run is a folder ``run=<last>-<first>`` that Spark has finished (it has the marker that Spark
writes when a job commits); what a lost driver left half-written has none and is not read.
Runs are never changed. Merging writes one run that covers those before it, with one record for
each key, sorted; covered runs stay until ``vacuum``, as a plan may still read them. Plain files
of records beside the runs are older than every run. One driver writes to a log at a time.

``ask_in_waves`` asks for what is missing in waves and commits each
wave, so a run that is stopped loses the wave under way at most, and the next one asks for the
rest only.

Defined cases: a folder that is missing or empty has no records; of the records of a key, the
one in the last run holds, in one run or in plain files the last one; a null key is kept as a
key of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..shared import shared_root

Asker = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
#: Runs after which they are merged, rows of a merged run's part, and waves without a reply after which asking ends.
MERGE, PART, GIVE_UP = 64, 1 << 20, 3


def hadoop_folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path's file system, and the path in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class ReplyLog:
    """The records of one folder; schema is theirs, key the column that tells them apart."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "key"):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), StructType.fromDDL(schema), key
        self._next: int | None = None  # the number of the next run, once this driver has listed the folder

    def _listed(self) -> tuple[list[tuple[int, int, bool]], list[str]]:
        """(first, last, committed) of the runs, and plain files."""
        fs, folder = hadoop_folder(self.spark, self.path)
        runs, files = [], []
        for s in fs.listStatus(folder) if fs.exists(folder) else []:
            name = s.getPath().getName()
            if name.startswith("run=") and s.isDirectory():
                last, first = map(int, name[4:].split("-"))
                runs.append((first, last, fs.exists(hadoop_folder(self.spark, f"{self.path}/{name}/_SUCCESS")[1])))
            elif s.isFile() and name[0] not in "_.":
                files.append(s.getPath().toString())
        return sorted(runs, key=lambda r: r[1]), files

    def _name(self, first: int, last: int) -> str:
        return f"{self.path}/run={last:08d}-{first:08d}"

    def _split(self) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Runs that hold, and runs that are covered by them."""
        done = [(a, z) for a, z, committed in self._listed()[0] if committed]
        covered = {r for r in done if any(s != r and s[0] <= r[0] and r[1] <= s[1] for s in done)}
        return [r for r in done if r not in covered], sorted(covered)

    def records(self) -> DataFrame:
        """All records of the runs and files as they are now, with run (null for files) and pos."""
        runs, files = self._split()[0], self._listed()[1]
        read = lambda s: self.spark.read.schema(s)
        parts = []
        if files:
            parts.append(read(self.schema).json(files).withColumn("run", F.lit(None).cast("string")))
        if runs:
            named = StructType([*self.schema.fields]).add("run", "string")
            parts.append(read(named).option("basePath", self.path).json([self._name(*r) for r in runs]))
        if not parts:
            return self.spark.createDataFrame([], StructType([*self.schema.fields]).add("run", "string").add("pos", "long"))
        parts = [p.withColumn("pos", F.monotonically_increasing_id()) for p in parts]
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]

    def read(self) -> DataFrame:
        """The record that holds for each key."""
        x = self.records()
        row = F.struct(*(F.col(f"`{c}`") for c in self.schema.names))
        last = x.groupBy(F.col(self.key).alias("__k")).agg(F.max_by(row, F.struct("run", "pos")).alias("r"))
        return last.select("r.*")

    def append(self, records: DataFrame) -> str:
        """One more run; gives its folder."""
        n = 1 + max((z for _, z, _ in self._listed()[0]), default=-1) if self._next is None else self._next
        self._next = n + 1
        records.write.mode("errorifexists").option("ignoreNullFields", "false").json(self._name(n, n))
        return self._name(n, n)

    def merge(self) -> None:
        """One run with what holds of all before it; files are left as they are, being older."""
        runs = self._split()[0]
        if len(runs) < 2:
            return
        held = self.read()
        parts = max(1, -(-held.count() // PART))
        one = held.repartition(parts, self.key).sortWithinPartitions(self.key)
        target, work = self._name(runs[0][0], runs[-1][1]), f"{self.path}/_merge-{uuid.uuid4().hex}"
        one.write.option("ignoreNullFields", "false").json(work)
        fs, p = hadoop_folder(self.spark, work)
        fs.rename(p, hadoop_folder(self.spark, target)[1])

    def vacuum(self) -> None:
        """Removes covered runs, once no plan reads them."""
        for r in self._split()[1]:
            fs, p = hadoop_folder(self.spark, self._name(*r))
            fs.delete(p, True)

    def missing(self, asked: DataFrame) -> DataFrame:
        """The rows of asked whose key (not null) has no record, one for each key."""
        known = self.records().select(self.key).distinct()
        return asked.where(F.col(self.key).isNotNull()).dropDuplicates([self.key]).join(known, self.key, "left_anti")


def ask_in_waves(log: ReplyLog, asked: DataFrame, run: Asker, batch: int, tasks: int) -> int:
    """Asks for the rows of asked that the log lacks, so many (batch) a task and wave; gives how many still have no record.

    GIVE_UP waves in a row without any record raise, as more of them would bring none either.
    """
    if len(log._split()[0]) >= MERGE:
        log.merge()
    spark, place = log.spark, f"{shared_root(log.spark)}/polylex/asked-{uuid.uuid4().hex}"
    turn = F.floor(F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) / batch).alias("wave")  # the row's number in its partition
    log.missing(asked).repartition(tasks, log.key).select("*", turn).write.partitionBy("wave").parquet(place)
    fs, p = hadoop_folder(spark, place)
    waves = sorted(int(s.getPath().getName()[5:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("wave="))
    idle = 0
    for k in waves:
        part = spark.read.parquet(f"{place}/wave={k}").repartition(tasks, log.key)
        new = log.append(part.mapInPandas(run, log.schema))
        idle = 0 if spark.read.schema(log.schema).json(new).take(1) else idle + 1
        if idle == GIVE_UP:
            raise RuntimeError(f"{idle} waves in a row brought no reply; what others brought is kept")
    left = log.missing(spark.read.parquet(place)).count() if waves else 0
    fs.delete(p, True)
    return left
