"""Step funnels: first time per user and step, then one row per step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.functions import pct


def first_times(
    events: DataFrame, keys: Sequence[str], name: str, ts: str, steps: Mapping[str, str]
) -> DataFrame:
    """One row per ``keys``: the first time of every step (output column -> event name)."""
    aggs = [F.min(F.when(F.col(name) == event, F.col(ts))).alias(c) for c, event in steps.items()]
    return events.where(F.col(name).isin(*steps.values())).groupBy(*keys).agg(*aggs)


def step_rows(
    totals: DataFrame,
    labels: Sequence[str],
    counts: Sequence[str],
    names: tuple[str, str, str, str, str],
    digits: int,
    extra: Mapping[str, Mapping[int, str]] | None = None,
) -> DataFrame:
    """Turns a one-row frame of step counts into a row per step, reading it once.

    ``names`` = label, order, users, share of the first step, share of the step before.
    ``extra`` = output column -> {step order: column of ``totals``}; other steps get NULL.
    """
    label, order, users, from_start, from_prev = names
    first = F.col(counts[0])
    rows = []
    for i, (text, column) in enumerate(zip(labels, counts), start=1):
        here = F.col(column)
        before = F.col(counts[max(i - 2, 0)])
        fields = [
            F.lit(text).alias(label),
            F.lit(i).alias(order),
            here.cast("bigint").alias(users),
            (F.lit(100.0) if i == 1 else pct(here, first, digits)).alias(from_start),
            (F.lit(100.0) if i == 1 else pct(here, before, digits)).alias(from_prev),
        ]
        for out, sources in (extra or {}).items():
            value = F.col(sources[i]) if i in sources else F.lit(None)
            fields.append(value.cast("double").alias(out))
        rows.append(F.struct(*fields))
    return totals.select(F.inline(F.array(*rows)))
