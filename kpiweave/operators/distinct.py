"""Distinct counts without the row blow-up of several COUNT(DISTINCT …) side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def conditional_distinct(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    total: str | None,
    flags: Mapping[str, Column] | None = None,
    partials: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Distinct ``entity`` per ``keys``: overall and once per flag condition.

    One row per (keys, entity) first, so a copy-heavy entity is combined on the map side,
    then plain sums. ``partials`` carries further sums and counts through both levels:
    output name -> (second-level aggregate, first-level aggregate expression).
    A NULL entity is not counted, as in SQL.
    """
    flags = flags or {}
    partials = partials or {}
    inner = [F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in flags.items()]
    inner += [expr.alias(name) for name, (_, expr) in partials.items()]
    per_entity = df.groupBy(*keys, entity)
    per_entity = per_entity.agg(*inner) if inner else per_entity.agg(F.lit(1).alias("_one"))
    present = F.col(entity).isNotNull()
    outer = [F.count(entity).alias(total)] if total else []
    outer += [F.sum(F.when(present, F.col(name)).otherwise(0)).alias(name) for name in flags]
    outer += [getattr(F, how)(name).alias(name) for name, (how, _) in partials.items()]
    return per_entity.groupBy(*keys).agg(*outer)


def daily_distinct(
    df: DataFrame,
    entity: str,
    day: str,
    total: str | None = None,
    flags: Mapping[str, Column] | None = None,
    windows: Mapping[str, int] | None = None,
) -> DataFrame:
    """Per day: distinct entities, distinct per flag, and distinct over trailing windows.

    A trailing window of ``n`` days counts an entity on every day from an active day up to
    ``n - 1`` days later. Per entity those spans are cut where the next active day starts,
    so they never overlap, and the count on a day is a running total of "+1 where a span
    opens, -1 where it closes". This is exact, reads each (entity, day) once and shuffles
    no row per window day. The running total itself is over one row per calendar day.
    Only days on which some entity was active are returned.
    """
    flags = flags or {}
    windows = windows or {}
    seen = df.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
    per_entity = seen.groupBy(entity, day)
    marks = [F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in flags.items()]
    user_days = per_entity.agg(*marks) if marks else seen.select(entity, day).distinct()
    counts = {"_active": F.lit(1), **{name: F.col(name) for name in flags}}
    if not windows:
        out = user_days.groupBy(day).agg(*[F.sum(c).alias(n) for n, c in counts.items()])
        return _named(out, day, total, flags, windows)

    following = F.lead(day).over(Window.partitionBy(entity).orderBy(day))
    user_days = user_days.withColumn("_next", following)

    def change(at: Column, opened: bool, closed: str | None) -> Column:
        fields = [at.alias(day)]
        fields += [(c if opened else F.lit(0)).alias(n) for n, c in counts.items()]
        for name in windows:
            step = 1 if opened else (-1 if name == closed else 0)
            fields.append(F.lit(step).alias(name))
        return F.struct(*fields)

    changes = [change(F.col(day), True, None)]
    for name, length in windows.items():
        # least() skips NULL: the last span of an entity runs its full length.
        end = F.least(F.date_add(day, length), F.col("_next"))
        changes.append(change(end, False, name))
    per_day = (
        user_days.select(F.inline(F.array(*changes)))
        .groupBy(day)
        .agg(*[F.sum(n).alias(n) for n in [*counts, *windows]])
    )
    upto = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_day.select(
        day, *counts, *[F.sum(name).over(upto).alias(name) for name in windows]
    ).where(F.col("_active") > 0)
    return _named(running, day, total, flags, windows)


def _named(df: DataFrame, day: str, total, flags, windows) -> DataFrame:
    head = [F.col("_active").alias(total)] if total else []
    return df.select(day, *head, *flags, *windows)
