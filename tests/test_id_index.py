from __future__ import annotations

import numpy as np
import pytest

from kpiweave.streaming import id_index
from tests import helpers as H
from tests.test_streaming import arrive, stream


def event(id_, day, **more):
    return {"at": f"2024-01-{day:02d}T03:00:00", "event_id": id_, **more}


def test_a_filter_holds_what_it_was_built_from_and_little_else():
    rng = np.random.default_rng(1)
    h = rng.integers(-(2**63), 2**63, 5000)
    bits = id_index.built(h)
    assert len(bits) * 8 <= 5000 * id_index.BITS_PER_ID + 64
    assert id_index.holds(bits, h).all()
    assert id_index.holds(bits, rng.integers(-(2**63), 2**63, 50_000)).mean() < 0.02


def test_repeats_go_at_any_delay_and_across_days(spark, tmp_path):
    index = id_index.IdIndex(spark, str(tmp_path / "index"), buckets=3)
    parts = [
        [event("a", 1), event("b", 1), event("a", 1), event("c", 20)],
        [event("d", 30), event("b", 30)],  # b again, on a later day
        [event("a", 1, received_at=H.ts("2024-03-01T00:00:00")), event("e", 1), event("d", 2)],
    ]
    for rows in parts:
        arrive(H.events(spark, rows), tmp_path / "in")
        id_index.feed(stream(spark, tmp_path / "in"), index, str(tmp_path / "cp"), once=True)
    rows = id_index.first_rows(index)
    assert rows.columns == H.events(spark, []).columns
    kept = sorted((r.event_id, r.event_timestamp.day) for r in rows.collect())
    assert kept == [("a", 1), ("b", 1), ("c", 20), ("d", 30), ("e", 1)]


def test_a_replayed_batch_leaves_the_index_as_it_is(spark, tmp_path):
    index = id_index.IdIndex(spark, str(tmp_path / "index"), buckets=2)
    first, second = [event("a", 1)], [event("a", 2), event("b", 2)]
    index.first_of(H.events(spark, first), "r", 0)
    for _ in range(2):
        index.first_of(H.events(spark, second), "r", 1)
    # Also when the index of the first run is lost between its parts.
    index.first_of(H.events(spark, first), "r", 0)
    assert sorted(r.event_id for r in id_index.first_rows(index).collect()) == ["a", "b"]


def test_new_ids_read_no_stored_id(spark, tmp_path):
    index = id_index.IdIndex(spark, str(tmp_path / "index"), buckets=2)
    index.first_of(H.events(spark, [event(f"x{i}", 1 + i % 3) for i in range(50)]), "r", 0)
    rows = H.events(spark, [event("x1", 9), event("new", 9)])
    named = index.candidates(rows.withColumn("day", rows.event_timestamp.cast("date")), "r", 1)
    assert ("x1", 2) in {(r.event_id, r.day.day) for r in named.collect()}
    read = index.stored(named.where("event_id = 'x1'"), "r", 1)
    assert [r.event_id for r in read.collect()] == ["x1"]
    assert all("day=2024-01-02" in f for f in read.inputFiles() if "/ids/" in f)


def test_an_empty_batch(spark, tmp_path):
    index = id_index.IdIndex(spark, str(tmp_path / "index"))
    index.first_of(H.events(spark, []), "r", 0)
    index.first_of(H.events(spark, [event("a", 1)]), "r", 1)
    assert [r.event_id for r in id_index.first_rows(index).collect()] == ["a"]


@pytest.mark.parametrize("n", [0, 1, 7])
def test_small_filters(n):
    h = np.arange(n)
    assert id_index.holds(id_index.built(h), h).all()


def test_a_batch_writes_one_file_per_day_and_bucket(spark, tmp_path):
    index = id_index.IdIndex(spark, str(tmp_path / "index"), buckets=2)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # many writing tasks, as with many rows
    try:
        index.first_of(H.events(spark, [event(f"x{i}", 1 + i % 3) for i in range(200)]), "r", 0)
    finally:
        spark.conf.set(key, before)
    assert len(list(tmp_path.glob("index/ids/day=*/bucket=*/run=r/batch=0/*.parquet"))) == 6
