"""Quality measures taken while a table is written, in the pass that writes it.

The measures are counts of the rows that the writing tasks see. Nothing is read a second time, and
no shuffle lies between the measuring and the files: each written row counts once, also when a task
is run again. Counts add up, so the batches of a stream keep theirs as partial sums by load day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpiweave import fixed_values as V
from kpiweave.functions import labelled, pct
from kpiweave.quality.checks import EVENT_ROW_RULES, TXN_ROW_RULES
from kpiweave.streaming.partials import Partials
from kpiweave.streaming.sinks import each_batch

ROWS = "rows"
LIMIT_PCT = 5.0


def measures(columns: Sequence[str], rules: Mapping[str, Callable[[], Column]]) -> dict[str, Column]:
    """Name -> count: all rows, the values that are there per column, the violations per rule."""
    return {
        ROWS: F.count("*"),
        **{f"present:{c}": F.count(F.col(f"`{c}`")) for c in columns},
        **{f"broken:{name}": F.count_if(rule()) for name, rule in rules.items()},
    }


def event_measures(df: DataFrame) -> dict[str, Column]:
    return measures(df.columns, EVENT_ROW_RULES)


def transaction_measures(df: DataFrame) -> dict[str, Column]:
    return measures(df.columns, TXN_ROW_RULES)


def measured_write(
    df: DataFrame, wanted: Mapping[str, Column], write: Callable[[DataFrame], None]
) -> dict[str, int]:
    """Runs ``write`` on ``df`` and returns what its tasks counted. ``write`` must store the frame
    as it comes, without a shuffle of its own: repartition before."""
    seen = Observation()
    write(df.observe(seen, *[column.alias(name) for name, column in wanted.items()]))
    found = seen.get
    return {name: found.get(name) or 0 for name in wanted}


def log(spark: SparkSession, path: str) -> Partials:
    """Where the counts of a stream's batches are kept, by load day."""
    return Partials(spark, path, "measure string, value bigint", ("value",))


def long(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "measure string, value bigint")


def feed(
    stream: DataFrame,
    wanted: Mapping[str, Column],
    path: str,
    counts: Partials,
    load_day: dt.date,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Stores a stream below ``path`` and the counts of each batch in ``counts``."""

    def store(batch: DataFrame, run: str, batch_id: int) -> None:
        part = f"{path}/run={run}/batch={batch_id}"
        found = measured_write(batch, wanted, lambda df: df.write.mode("overwrite").parquet(part))
        rows = long(counts.spark, found).withColumn("day", F.lit(load_day))
        counts.add(rows, run, batch_id)

    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return each_batch(writer, store, once)


def totals(counts: Partials) -> DataFrame:
    """measure, value over all load days."""
    days = counts.days()
    first, last = (days[0], days[-1]) if days else (dt.date.min, dt.date.min)
    return counts.read(first, last).groupBy("measure").agg(F.sum("value").alias("value"))


def null_rates(counted: DataFrame, limit_pct: float = LIMIT_PCT) -> DataFrame:
    """column, null_pct, ok from measure, value: as ``monitors.null_rate_by_column``."""
    rows = counted.where(F.col("measure") == ROWS).agg(F.max("value")).scalar()
    there = counted.where(F.col("measure").startswith("present:"))
    rates = there.select(
        F.substring_index("measure", "present:", -1).alias("column"),
        pct(rows - F.col("value"), rows).alias("null_pct"),
    )
    return rates.withColumn("ok", ~(F.col("null_pct") > limit_pct))


def row_checks(counted: DataFrame) -> DataFrame:
    """check_name, expectation, severity, passed, details, violations of the row rules: as
    ``report.quality_report`` has them."""
    rules = counted.where(F.col("measure").startswith("broken:"))
    name, n = F.substring_index("measure", "broken:", -1), F.col("value")
    failed = F.concat(n.cast("string"), F.lit(V.CHECK_FAILED))
    return rules.select(
        name.alias("check_name"),
        labelled(name, {k: text for k, (text, _) in V.CHECKS.items()}).alias("expectation"),
        labelled(name, {k: level for k, (_, level) in V.CHECKS.items()}).alias("severity"),
        (n == 0).alias("passed"),
        F.when(n == 0, V.CHECK_PASSED).otherwise(failed).alias("details"),
        n.alias("violations"),
    )
