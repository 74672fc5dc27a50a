from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from kpiweave.streaming import past_baseline, sinks, transforms
from tests import helpers as H
from tests.test_streaming import arrive, stream


def test_moments_merge():
    rng = random.Random(3)
    values = [rng.uniform(-5, 90) for _ in range(40)]
    whole = (0, 0.0, 0.0)
    for low, high in ((0, 1), (1, 15), (15, 40)):
        part = (0, 0.0, 0.0)
        for x in values[low:high]:
            part = past_baseline.merged(part, (1, x, 0.0))
        whole = past_baseline.merged(whole, part)
    assert whole[1] == pytest.approx(statistics.mean(values))
    assert past_baseline.limit_of(whole, 2.0) == pytest.approx(
        statistics.mean(values) + 2 * statistics.stdev(values)
    )
    assert past_baseline.limit_of((1, 5.0, 0.0), 2.0) is None
    assert past_baseline.merged((0, 0.0, 0.0), (0, 0.0, 0.0)) == (0, 0.0, 0.0)


def failures(day, n, code="ERR_1"):
    return [{"at": f"2024-01-{day:02d}T02:00:00", "status": "failed", "error_code": code}] * n


def test_an_alert_depends_on_earlier_windows_only(spark, tmp_path):
    """A surge on the fourth day; the days after it, in a later run, do not change the verdict."""
    counts = {1: 3, 2: 5, 3: 4, 4: 30, 5: 6, 6: 28, 7: 1}
    root, seen = tmp_path, {}
    for days in ((1, 2), (3, 4, 5), (6, 7)):
        rows = [r for d in days for r in failures(d, counts[d])] + failures(days[0], 2, "ERR_2")
        arrive(H.transactions(spark, rows), root / "in")
        signals = transforms.transaction_signals(stream(spark, root / "in"))
        sinks.append_files(signals, str(root / "windows"), str(root / "cp1"), once=True)
        windows = spark.readStream.schema(signals.schema).parquet(str(root / "windows"))
        past_baseline.feed(windows, str(root / "judged"), str(root / "cp2"), once=True)
        for r in spark.read.parquet(str(root / "judged")).collect():
            key = (r.rule, r.window_start.day)
            assert seen.setdefault(key, r) == r
    surges = {d: r for (rule, d), r in seen.items() if rule == "error_surge:ERR_1"}
    for day, row in surges.items():
        past = [counts[d] for d in range(1, day)]
        limit = statistics.mean(past) + 2 * statistics.stdev(past) if len(past) > 1 else None
        assert row.value == counts[day]
        assert row.alert == (limit is not None and counts[day] > limit)
        assert row.limit == (limit if limit is None else pytest.approx(limit))
    assert set(surges) == {1, 2, 3, 4, 5, 6}  # the last window is still open
    rates = [r for (rule, _), r in seen.items() if rule == "success_rate"]
    assert len(rates) == 6 and all(r.alert and r.value == 0 for r in rates)


def test_batch_frames_are_judged_like_a_window_function(spark):
    """The state's limits against avg and stddev_samp over the rows before."""
    from pyspark.sql import Window

    rng = random.Random(8)
    rows = [(H.ts(f"2024-01-{d:02d}T00:00:00"), "error_surge:X", 0, rng.randint(1, 50)) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, rule string, hits bigint, n bigint")
    past = Window.partitionBy("rule").orderBy("window_start").rowsBetween(Window.unboundedPreceding, -1)
    limits = df.select((F.avg("n").over(past) + 2 * F.stddev_samp("n").over(past)).alias("x"))
    now = (0, 0.0, 0.0)
    for row, (_, _, _, n) in zip(limits.collect(), rows):
        mine = past_baseline.limit_of(now, 2.0)
        assert (mine is None) == (row.x is None) and (mine is None or mine == pytest.approx(row.x))
        now = past_baseline.merged(now, (1, float(n), 0.0))
