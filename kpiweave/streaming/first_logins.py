"""New and returning users of each day, kept up by a stream, whatever the order of arrival.

A user is new on the first day with a login. A late row can move that day: then the day that
counted the user as new must count a returning one. Keyed state holds a user's login days with
their platforms and the first day, and emits the changes of the daily counts; their sums per day
are the counts. Nothing but the state of the users of a batch is read again. The changes are kept
as partial sums, so a replayed batch changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from kpiweave import fixed_values as V
from kpiweave.plans.activity import raw_logins
from kpiweave.plans.staging import not_test_account
from kpiweave.streaming.partials import Partials
from kpiweave.streaming.sinks import each_batch

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS = ("dau", "new_users", "returning_users", *[f"dau_{p}" for p in V.PLATFORMS])
_FIELDS = ", ".join(f"{name} bigint" for name in COUNTS)
SCHEMA = f"day date, {_FIELDS}"


class FirstLogins(StatefulProcessor):
    """Per user, as one value: the login days and the platforms of each, as bits. The first of
    the days is the day that counts the user as new. A batch reads and writes a user's state
    once, however many days it brings."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.logins = handle.getValueState("logins", "days array<int>, platforms array<int>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seen: dict[int, int] = {}
        for row in rows:
            seen[row.day] = seen.get(row.day, 0) | row.platforms
        state = self.logins.get()
        known = dict(zip(*state)) if state is not None else {}
        changes = self._applied(known, seen)
        if changes:
            days = sorted(known)
            self.logins.update((days, [known[day] for day in days]))
        yield from changes

    @staticmethod
    def _applied(known: dict[int, int], seen: dict[int, int]) -> list[Row]:
        """Adds days to the known ones; the changes of the daily counts that follow."""
        first, earliest = min(known, default=None), min(seen)
        out: dict[int, dict] = defaultdict(lambda: dict.fromkeys(COUNTS, 0))
        for day, bits in seen.items():
            if day not in known:
                out[day]["dau"] += 1
                out[day]["returning_users"] += 1
            added = bits & ~known.get(day, 0)
            for i, platform in enumerate(V.PLATFORMS):
                if added >> i & 1:
                    out[day][f"dau_{platform}"] += 1
            known[day] = known.get(day, 0) | bits
        if first is None or earliest < first:
            for day, step in ((earliest, 1), (first, -1)):
                if day is not None:
                    out[day]["new_users"] += step
                    out[day]["returning_users"] -= step
        return [
            Row(day=day, **counts) for day, counts in out.items() if any(counts.values())
        ]


def changes(events: DataFrame) -> DataFrame:
    """day and changes of ``COUNTS``, from a stream of raw events. Needs RocksDB state."""
    bits = F.lit(0)
    for i, platform in enumerate(V.PLATFORMS):
        bits = bits + F.when(F.col("platform") == platform, 1 << i).otherwise(0)
    logins = raw_logins(events).where(not_test_account() & F.col("login_date").isNotNull())
    days = logins.select("user_id", F.unix_date("login_date").alias("day"), bits.alias("platforms"))
    found = days.groupBy("user_id").transformWithState(
        statefulProcessor=FirstLogins(),
        outputStructType=f"day int, {_FIELDS}",
        outputMode="Update",
        timeMode="None",
    )
    return found.withColumn("day", F.date_from_unix_date("day"))


def daily_changes(spark: SparkSession, path: str) -> Partials:
    """Where the changes are kept."""
    return Partials(spark, path, _FIELDS, COUNTS)


def feed(
    events: DataFrame, counts: Partials, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Keeps ``counts`` up to date with a stream of raw events."""

    def store(batch: DataFrame, run: str, batch_id: int) -> None:
        summed = batch.groupBy("day").agg(*[F.sum(name).alias(name) for name in COUNTS])
        counts.add(summed, run, batch_id)

    before = counts.spark.conf.get(PROVIDER_KEY)
    counts.spark.conf.set(PROVIDER_KEY, ROCKSDB)
    try:
        writer = changes(events).writeStream.outputMode("update")
        return each_batch(writer.option("checkpointLocation", checkpoint), store, once)
    finally:
        counts.spark.conf.set(PROVIDER_KEY, before)


def current(counts: Partials) -> DataFrame:
    """The daily counts as they stand, in the form of ``activity.dau_new_returning``."""
    days = counts.days()
    if not days:
        rows = counts.spark.createDataFrame([], SCHEMA)
    else:
        rows = counts.read(days[0], days[-1])
    return rows.where("dau > 0").select(F.col("day").alias("login_date"), *COUNTS)
