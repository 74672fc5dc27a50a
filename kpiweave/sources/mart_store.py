"""Marts and extracts of a run, computed once and read from files by all that build on them.

A run is named by its caller, say by its day. A mart that the run has finished is read, also by a
later try of the same run; one that was lost half way is computed again, and its files replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kpiweave.sources.writers import write_mart


@dataclass(frozen=True)
class MartStore:
    spark: SparkSession
    root: str
    run: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/run={self.run}/{name}"

    def finished(self, name: str) -> bool:
        """Whether the job that writes the mart has committed."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/_SUCCESS")
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return where.getFileSystem(conf).exists(where)

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored mart; ``build`` is asked for it only while the run has none."""
        if not self.finished(name):
            write_mart(build(), self.path(name))
        return self.spark.read.parquet(self.path(name))
