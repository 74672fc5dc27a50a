from __future__ import annotations

import glob

import pytest

from verification import queries_streaming as Q
from verification.queries_models import Tables


@pytest.fixture
def small_files(monkeypatch):
    monkeypatch.setattr(Q, "FILE_ROWS", 20)


def test_files_grow_in_number_with_the_events(spark, sf_dir, tmp_path, small_files):
    t = Tables(spark, sf_dir)
    rows = Q.fixture.source(spark, sf_dir, "events").count()
    root = str(tmp_path)
    Q.mixed_arrivals(t, root)
    files = glob.glob(f"{root}/mixed/*.parquet")
    assert len(files) > 6 and len(files) >= 0.9 * rows / 20
    assert max(spark.read.parquet(f).count() for f in files) < 6 * 20
    assert spark.read.parquet(f"{root}/mixed").exceptAll(t.events).isEmpty()
    assert spark.read.parquet(f"{root}/mixed").count() == t.events.count()


def test_time_ordered_files_grow_in_number_with_the_transactions(spark, sf_dir, tmp_path, small_files):
    t = Tables(spark, sf_dir)
    root = str(tmp_path)
    Q.time_ordered_arrivals(t, t.transactions, "orders", f"{root}/txns", "created_at")
    assert len(glob.glob(f"{root}/txns/*.parquet")) > 3
    assert spark.read.parquet(f"{root}/txns").count() == t.transactions.count()


def test_buckets_of_the_id_index_grow_with_the_events(spark, sf_dir, monkeypatch):
    t = Tables(spark, sf_dir)
    assert Q.id_buckets(t) == 8
    monkeypatch.setattr(Q, "BUCKET_IDS", 20)
    assert Q.id_buckets(t) == -(-Q.fixture.source(spark, sf_dir, "events").count() // 20)
