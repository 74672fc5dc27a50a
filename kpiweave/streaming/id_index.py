"""Drops repeats of an id at any delay, against an index of all ids that a stream has brought.

A watermark forgets ids when their time is over; this index does not. Ids lie by day in buckets of
their hash, and each bucket of each day has a Bloom filter, several to a day if several batches
brought ids of it. A batch asks the filters of its own buckets first. Only the days that a filter
names are read, for an exact anti join: an id that is new, as most are, reads no stored id.

A batch that is replayed finds the index as it was without it, for its own parts are left out, and
writes the same parts again. Memory of a task is one bucket: its filters, ten bits and more per id,
and the batch's ids in it, so ``buckets`` must grow with the ids that are to be kept.

Rows without an id belong to the quarantine of ``transforms.validate`` and must not get here.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpiweave.sources.writers import write_partitioned
from kpiweave.streaming.partials import children
from kpiweave.streaming.sinks import each_batch

BITS_PER_ID, PROBES = 12, 6
_FILTER = "bucket int, day date, bits binary"
_FILTERS = f"{_FILTER}, run string, batch bigint"
_ASKED = "bucket int, day date, event_id string"


def _places(h: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash in a filter of ``size`` bits, a row per probe."""
    h = h.astype(np.int64).view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (low + steps * high) % np.uint64(size)


def built(h: np.ndarray) -> bytes:
    size = max(64, -(-len(h) * BITS_PER_ID // 8) * 8)
    bits = np.zeros(size, bool)
    bits[_places(h, size).ravel()] = True
    return np.packbits(bits).tobytes()


def holds(bits: bytes, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold: all that it was built from, and a few others."""
    packed = np.frombuffer(bits, np.uint8)
    where = _places(h, len(packed) * 8)
    return ((packed[where >> np.uint64(3)] >> (7 - (where & np.uint64(7)).astype(np.uint8))) & 1).all(0)


def _filters_of(group: pd.DataFrame) -> pd.DataFrame:
    first = group.iloc[0]
    bits = built(group["h"].to_numpy())
    return pd.DataFrame({"bucket": [first.bucket], "day": [first.day], "bits": [bits]})


def _ask(asked: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """The pairs of id and day that a filter names."""
    h, ids = asked["h"].to_numpy(), asked["event_id"].to_numpy()
    found = set()
    if len(h):
        for bucket, day, bits in zip(filters["bucket"], filters["day"], filters["bits"]):
            found |= {(bucket, day, id_) for id_ in ids[holds(bits, h)]}
    named = pd.DataFrame(sorted(found), columns=["bucket", "day", "event_id"], dtype=object)
    return named.astype({"bucket": "int32"})


@dataclass(frozen=True)
class IdIndex:
    """Where the ids, their filters and the rows that came first are kept."""

    spark: SparkSession
    root: str
    buckets: int = 64

    @property
    def rows_path(self) -> str:
        return f"{self.root}/rows"

    @property
    def ids_path(self) -> str:
        return f"{self.root}/ids"

    @property
    def filters_path(self) -> str:
        return f"{self.root}/filters"

    def _placed(self, rows: DataFrame) -> DataFrame:
        h = F.xxhash64("event_id")
        bucket = F.pmod(h, F.lit(self.buckets)).cast("int").alias("bucket")
        return rows.select("event_id", "day", h.alias("h"), bucket)

    def _not_of(self, run: str, batch: int) -> Column:
        return ~((F.col("run") == run) & (F.col("batch") == batch))

    def candidates(self, rows: DataFrame, run: str, batch: int) -> DataFrame | None:
        """bucket, day, event_id: where the filters say that an id may be stored; None while
        nothing is."""
        if not children(self.spark, self.filters_path):
            return None
        filters = self.spark.read.schema(_FILTERS).parquet(self.filters_path)
        filters = filters.where(self._not_of(run, batch)).select("bucket", "day", "bits")
        ours = self._placed(rows)
        return (
            ours.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_ask, _ASKED)
        )

    def stored(self, named: DataFrame, run: str, batch: int) -> DataFrame:
        """The ids of ``named`` that are stored. Only the days named are listed and read."""
        days = [r.day for r in named.select("day").distinct().collect()]
        schema = "event_id string, bucket int, day date, run string, batch bigint"
        paths = [f"{self.ids_path}/day={day.isoformat()}" for day in days]
        reader = self.spark.read.schema(schema).option("basePath", self.ids_path)
        kept = reader.parquet(*paths).where(self._not_of(run, batch))
        found = kept.join(named, ["day", "bucket", "event_id"], "left_semi")
        return found.select("event_id").distinct()

    def first_of(self, rows: DataFrame, run: str, batch: int) -> None:
        """Stores the rows whose id no other batch has brought, each id once, and their ids."""
        incoming = f"{self.root}/incoming/{run}"
        day = F.col("event_timestamp").cast("timestamp_ntz").cast("date")
        # Dealt by id first: else a task would sort all whole rows of the files that it reads.
        dealt = rows.repartition("event_id")
        once = dealt.dropDuplicates(["event_id"]).withColumn("day", F.coalesce(day, F.lit("1970-01-01").cast("date")))
        once.write.mode("overwrite").parquet(incoming)
        once = self.spark.read.schema(once.schema).parquet(incoming)
        named = self.candidates(once, run, batch)
        new = once
        if named is not None:
            path = f"{self.root}/named/{run}"
            named.write.mode("overwrite").parquet(path)
            named = self.spark.read.schema(_ASKED).parquet(path)
            if not named.isEmpty():
                new = once.join(self.stored(named, run, batch), "event_id", "left_anti")
        part = f"run={run}/batch={batch}"
        out = f"{self.rows_path}/{part}"
        new.select(once.columns).write.mode("overwrite").parquet(out)
        new = self.spark.read.schema(once.schema).parquet(out)
        marks = {"run": F.lit(run), "batch": F.lit(batch).cast("bigint")}
        placed = self._placed(new)
        ids = placed.select("event_id", "bucket", "day").withColumns(marks)
        write_partitioned(ids, self.ids_path, ["day", "bucket", "run", "batch"])
        filters = placed.groupBy("bucket", "day").applyInPandas(_filters_of, _FILTER)
        filters.write.mode("overwrite").parquet(f"{self.filters_path}/{part}")


def feed(events: DataFrame, index: IdIndex, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keeps the first row of each id of a stream at ``index.rows_path``."""
    writer = events.writeStream.option("checkpointLocation", checkpoint)
    return each_batch(writer, index.first_of, once)


def first_rows(index: IdIndex) -> DataFrame:
    """The rows kept so far."""
    return index.spark.read.parquet(index.rows_path).drop("day", "run", "batch")
