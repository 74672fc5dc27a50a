"""Stream sinks that survive a replayed batch and a lost checkpoint, and how to read them.

A stored part is named by the id of its query and the number of its batch. A query keeps its id
over restarts, so a replayed batch replaces itself; a new checkpoint, or a second source of the
same table, is another query and replaces nothing.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def read_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as a stream, with the schema of what is there."""
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    if _is_file(spark, path):
        # A stream source is a folder: a single file is its folder with a name filter.
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    """One look at the path itself; its files are not listed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.getFileStatus(where).isFile()


def append_files(
    df: DataFrame, path: str, checkpoint: str, by: Sequence[str] = (), once: bool = False
) -> StreamingQuery:
    """Append mode into parquet; the file sink's log makes every row count once."""
    writer = df.writeStream.format("parquet").outputMode("append")
    if by:
        writer = writer.partitionBy(*by)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer, once)


def changelog(
    df: DataFrame,
    path: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Update mode: each batch stores the rows that changed, below its query and batch.
    ``finish`` runs on each batch before it is stored."""

    def store(batch: DataFrame, run: str, batch_id: int) -> None:
        rows = finish(batch) if finish else batch
        stamped = rows.withColumn("stored_at", F.current_timestamp())
        stamped.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return each_batch(writer, store, once)


_MARKS = ("run", "batch", "stored_at")


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current row per key of a ``changelog``: the one stored last. Batches of one query
    follow each other by number, whatever the clock says; queries by the time of storing."""
    log = spark.read.parquet(path)
    values = [c for c in log.columns if c not in (*keys, *_MARKS)]
    there = [c for c in ("stored_at", "run") if c in log.columns]
    of_run = [c for c in there if c == "run"]
    stamped = F.struct(*[c for c in there if c != "run"], *values)
    last = log.groupBy(*keys, *of_run).agg(F.max_by(stamped, "batch").alias("last"))
    if not there:
        return last.select(*keys, *[f"last.{c}" for c in values])
    order = F.struct(*[F.col(f"last.{c}") if c != "run" else F.col(c) for c in there])
    newest = last.groupBy(*keys).agg(F.max_by("last", order).alias("row"))
    return newest.select(*keys, *[f"row.{c}" for c in values])


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Writes the current rows of the changelog at ``path`` as the base of a new one at
    ``target``; later parts there count as newer."""
    base = latest(spark, path, keys).withColumn("stored_at", F.current_timestamp())
    base.write.mode("overwrite").parquet(f"{target}/run=base/batch=0")


def late_rows(query: StreamingQuery) -> int:
    """Late rows of the batches that the query still remembers; ``LateRows`` counts all."""
    operators = [op for p in query.recentProgress for op in p["stateOperators"]]
    return sum(op.get("numRowsDroppedByWatermark", 0) for op in operators)


class LateRows(StreamingQueryListener):
    """Counts, per query id, all rows that came after their window had closed. Add it to
    ``spark.streams`` before the query starts."""

    def __init__(self) -> None:
        self.rows: Counter = Counter()

    def onQueryStarted(self, event) -> None:
        self.rows[str(event.id)] += 0

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.rows[str(event.progress.id)] += late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def each_batch(
    writer, store: Callable[[DataFrame, str, int], None], once: bool = False
) -> StreamingQuery:
    """Runs ``store(batch, query id, batch number)`` for each batch. The id is known when the
    query has started; the first batch waits for it."""
    run: list[str] = []
    known = threading.Event()

    def apply(batch: DataFrame, batch_id: int) -> None:
        known.wait()
        store(batch, run[0], batch_id)

    writer = writer.foreachBatch(apply)
    query = (writer.trigger(availableNow=True) if once else writer).start()
    run.append(str(query.id))
    known.set()
    if once:
        query.awaitTermination()
    return query


def _start(writer, once: bool) -> StreamingQuery:
    if not once:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
