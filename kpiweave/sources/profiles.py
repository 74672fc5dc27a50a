"""What was loaded: sizes and simple profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.functions import pct, per


def load_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table, rows, columns."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        out = part if out is None else out.unionByName(part)
    return out


def event_profile(events: DataFrame, top: int = 15) -> DataFrame:
    """The most frequent event names."""
    counted = events.groupBy("event_name").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "event_name").limit(top)


def transaction_profile(transactions: DataFrame) -> DataFrame:
    """section, key, n, value: mean amount by type, completed totals, share by status.

    One scan groups by (type, status); every section is summed from those few cells.
    """
    cells = transactions.groupBy("transaction_type", "status").agg(
        F.count("*").alias("n"),
        F.sum("amount").alias("amount"),
        F.count("amount").alias("priced"),
        F.sum("fee").alias("fee"),
    )
    done = F.col("status") == "completed"

    def part(section: str, key, n, total, base):
        return F.struct(
            F.lit(section).alias("section"),
            key.alias("key"),
            n.alias("n"),
            total.alias("total"),
            base.alias("base"),
        )

    n, zero = F.col("n"), F.lit(0).cast("bigint")
    done_n = F.when(done, n).otherwise(zero)
    parts = F.array(
        part("type", F.col("transaction_type"), n, F.col("amount"), F.col("priced")),
        part("total", F.lit("gmv"), done_n, F.when(done, F.col("amount")), zero),
        part("total", F.lit("fee"), done_n, F.when(done, F.col("fee")), zero),
        part("status", F.col("status"), n, n, zero),
    )
    sums = (
        cells.select(F.inline(parts))
        .groupBy("section", "key")
        .agg(*[F.sum(c).alias(c) for c in ("n", "total", "base")])
    )
    of_section = F.sum("n").over(Window.partitionBy("section"))
    value = (
        F.when(F.col("section") == "type", per(F.col("total"), F.col("base"), 0))
        .when(F.col("section") == "status", pct(n, of_section, 1))
        .otherwise(F.col("total").cast("double"))
    )
    return sums.select("section", "key", "n", value.alias("value"))
