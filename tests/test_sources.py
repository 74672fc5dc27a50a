from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from kpiweave.sources import profiles, readers, writers
from tests import helpers as H


def test_json_array_and_lines_read_alike(spark, tmp_path):
    documents = [
        {
            "event_id": "e1",
            "event_name": "payment_transfer_completed",
            "event_timestamp": "2031-07-08T09:10:11.250Z",
            "received_at": "2031-07-08T09:10:12.500Z",
            "user_id": "usr_1",
            "platform": "ios",
            "event_properties": {"amount": 50000, "fee": "0", "transfer_type": "instant"},
        },
        {"event_id": "e2", "user_id": None, "event_properties": {"amount": "many", "new": [1]}},
    ]
    (tmp_path / "array.json").write_text(json.dumps(documents, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(d) for d in documents))
    array = readers.read_events_json(spark, str(tmp_path / "array.json"), multi_line=True)
    lines = readers.read_events_json(spark, str(tmp_path / "lines.json"))
    flat = [H.dicts(readers.flatten_properties(df), "event_id") for df in (array, lines)]
    assert flat[0] == flat[1]
    first, second = flat[0]
    assert first["event_timestamp"] == dt.datetime(2031, 7, 8, 9, 10, 11, 250000)
    assert (first["prop_amount"], first["prop_fee"]) == (50000, 0)
    assert first["prop_transfer_type"] == "instant" and first["prop_screen_name"] is None
    assert second["prop_amount"] is None and second["event_timestamp"] is None


def test_user_csv(spark, tmp_path):
    path = tmp_path / "users.csv"
    path.write_text(
        "user_id,device_id,platform,device_model,signup_date,signup_method\n"
        "usr_1,dev_1,ios,Pixel 8,2024-12-30,phone\n"
    )
    (row,) = readers.read_users(spark, str(path)).collect()
    # ISO week: the last Monday of December belongs to week 1.
    assert row["signup_week"] == 1 and row["signup_month"] == dt.date(2024, 12, 1)


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "p")
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    for rows in ([(day1, 1), (day2, 2)], [(day2, 3)]):
        writers.write_partitioned(spark.createDataFrame(rows, "d date, v int"), path, ["d"])
    rows = {(r["d"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert rows == {(day1, 1), (day2, 3)}


def test_time_ordered_files_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [{"at": f"2024-01-{1 + i % 28:02d}T{i % 24:02d}:00:00"} for i in range(500)]
    # A third of all rows have one time.
    rows += [{"at": "2024-01-15T00:00:00"}] * 250
    writers.write_time_ordered(H.events(spark, rows), path, "event_timestamp", files=6)
    spans = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(
            F.min("event_timestamp").alias("a"),
            F.max("event_timestamp").alias("b"),
            F.count("*").alias("n"),
        )
        .orderBy("a", "b")
        .collect()
    )
    assert sum(r["n"] for r in spans) == 750 and max(r["n"] for r in spans) < 250
    assert all(x["b"] <= y["a"] for x, y in zip(spans, spans[1:]))


def test_bucketed_tables_join_without_a_shuffle(spark):
    big = spark.range(1000).select(F.concat(F.lit("u"), F.col("id")).alias("user_id"), "id")
    writers.save_bucketed(big, "bucketed_a", "user_id", 4)
    writers.save_bucketed(big.withColumnRenamed("id", "x"), "bucketed_b", "user_id", 4)
    joined = spark.table("bucketed_a").hint("merge").join(spark.table("bucketed_b"), "user_id")
    plan = joined.groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 1000
    spark.sql("DROP TABLE bucketed_a")
    spark.sql("DROP TABLE bucketed_b")


def test_scratch_path_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master = "yarn"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError):
        writers.scratch_path(Session(), "x")
    shared = spark.conf.get("spark.checkpoint.dir")
    assert writers.scratch_path(spark, "x").startswith(shared)


def test_csv_extract_is_one_file_with_a_header(spark, tmp_path):
    path = tmp_path / "extract"
    df = spark.range(100).repartition(7)
    writers.write_csv_extract(df, str(path), ["id"])
    (part,) = list(path.glob("part-*.csv"))
    assert part.read_text().splitlines()[:3] == ["id", "0", "1"]


def test_profiles(spark):
    events = H.events(spark, [{"at": "2024-01-01T00:00:00"}] * 3)
    assert [tuple(r) for r in profiles.event_profile(events).collect()] == [
        ("auth_login_completed", 3)
    ]
    (size,) = profiles.load_summary({"events": events}).collect()
    assert (size["rows"], size["columns"]) == (3, 21)


def test_a_run_computes_each_mart_once_and_again_after_a_loss(spark, tmp_path):
    from kpiweave.sources.mart_store import MartStore

    asked = []

    def build(rows):
        def now():
            asked.append(rows)
            return spark.range(rows)

        return now

    store = MartStore(spark, str(tmp_path / "marts"), "2024-01-01")
    assert store.get("m", build(3)).count() == 3
    assert MartStore(spark, store.root, "2024-01-01").get("m", build(4)).count() == 3
    assert MartStore(spark, store.root, "2024-01-02").get("m", build(5)).count() == 5
    # Without the mark of a committed job the files are those of a lost one.
    (tmp_path / "marts" / "run=2024-01-01" / "m" / "_SUCCESS").unlink()
    assert store.get("m", build(6)).count() == 6 and asked == [3, 5, 6]
