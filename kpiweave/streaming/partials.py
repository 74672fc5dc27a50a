"""Stored partial sums by day, added to by every batch of a stream.

A part lies below its day, named by the query and the number of the batch that brought it, so a
replayed batch replaces its own parts and nothing else. A read adds up the parts of the days it
names, and lists the folders of no other day.

``compact`` turns the parts of a day into one. The new part counts once the log says so, and the
same line of the log takes the old parts out; a job that is lost before it wrote the line has
changed nothing. A batch that is replayed after that rewrites a part that no longer counts.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiweave.sources.writers import write_partitioned

PARTS = ("day", "run", "batch")
BASE = "base-"  # runs of compacted parts
_LOG = "base string, day date, run string, batch bigint"


@dataclass(frozen=True)
class Partials:
    """Rows of ``keys``, the first of them the date ``day``, with ``sums`` that add up."""

    spark: SparkSession
    path: str
    fields: str  # names and types of keys and sums but for the day
    sums: Sequence[str]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.fields}, day date, run string, batch bigint")

    @property
    def keys(self) -> list[str]:
        return [f.name for f in self.schema if f.name not in (*self.sums, *PARTS)]

    @property
    def _log_path(self) -> str:
        return f"{self.path}-log"

    def add(self, rows: DataFrame, run: str, batch: int) -> list[dt.date]:
        """Stores the partial sums of a batch, rows without a day left out, and returns their
        days. The batch is read once: into a part of its own, from which the rest is done."""
        incoming = f"{self.path}-incoming/{run}"
        rows.where(F.col("day").isNotNull()).write.mode("overwrite").parquet(incoming)
        own = self.spark.read.schema(T.StructType(self.schema.fields[:-2])).parquet(incoming)
        marks = {"run": F.lit(run), "batch": F.lit(batch).cast("bigint")}
        write_partitioned(own.withColumns(marks), self.path, list(PARTS))
        return sorted(r.day for r in own.select("day").distinct().collect())

    def days(self) -> list[dt.date]:
        """The days that have parts, by one look at the root."""
        names = [name for name in children(self.spark, self.path) if name.startswith("day=")]
        return sorted(dt.date.fromisoformat(name[4:]) for name in names)

    def _parts(self, days: Iterable[dt.date]) -> DataFrame:
        """The rows of all parts of ``days`` that count."""
        paths = [f"{self.path}/day={day.isoformat()}" for day in days]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", self.path)
        rows = reader.parquet(*paths)
        # Deleting an absorbed part may leave its folder behind, empty.
        log = self._log()
        if log is None:
            return rows.where(~F.col("run").startswith(BASE))
        # One line per part that a compaction took in: few and narrow.
        live = log.select(F.col("base").alias("run"), "day").distinct()
        absorbed = log.select("day", "run", "batch")
        plain = rows.where(~F.col("run").startswith(BASE))
        based = rows.where(F.col("run").startswith(BASE)).join(live, ["run", "day"], "left_semi")
        return plain.unionByName(based.select(plain.columns)).join(
            absorbed, list(PARTS), "left_anti"
        )

    def _log(self) -> DataFrame | None:
        if not children(self.spark, self._log_path):
            return None
        return self.spark.read.schema(_LOG).parquet(self._log_path)

    def read(self, first: dt.date, last: dt.date) -> DataFrame:
        """day, keys, sums over the days first..last."""
        there = [day for day in self.days() if first <= day <= last]
        total = [F.sum(name).alias(name) for name in self.sums]
        return self._parts(there).groupBy("day", *self.keys).agg(*total)

    def compact(self, before: dt.date) -> int:
        """Makes one part of each day before ``before`` that has several, and returns how many
        days that were."""
        closed = [day for day in self.days() if day < before]
        parts = self._parts(closed).select(*PARTS).distinct()
        several = parts.groupBy("day").agg(F.count("*").alias("n")).where("n > 1").select("day")
        days = sorted(r.day for r in several.collect())
        if not days:
            return 0
        base = f"{BASE}{uuid.uuid4().hex}"
        # The log is written from the parts as they are read now, not as they are listed later.
        taken = self._parts(days).select(*PARTS).distinct().toArrow()
        total = [F.sum(name).alias(name) for name in self.sums]
        merged = self._parts(days).groupBy("day", *self.keys).agg(*total)
        marks = {"run": F.lit(base), "batch": F.lit(0).cast("bigint")}
        write_partitioned(merged.withColumns(marks), self.path, list(PARTS))
        lines = self.spark.createDataFrame(taken).withColumn("base", F.lit(base))
        lines.select("base", *PARTS).coalesce(1).write.mode("append").parquet(self._log_path)
        return len(days)

    def vacuum(self) -> int:
        """Deletes parts that were taken into another. No read may be under way."""
        log = self._log()
        if log is None:
            return 0
        there = set(self.days())
        gone = 0
        for row in log.select(*PARTS).distinct().toLocalIterator():
            if row.day in there:
                part = f"{self.path}/day={row.day.isoformat()}/run={row.run}/batch={row.batch}"
                gone += delete(self.spark, part)
        return gone


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def children(spark: SparkSession, path: str) -> list[str]:
    system, where = _file_system(spark, path)
    if not system.exists(where):
        return []
    return [status.getPath().getName() for status in system.listStatus(where)]


def delete(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return bool(system.delete(where, True))
