from __future__ import annotations

import datetime as dt

from kpiweave.quality import checks, ingest, monitors, report
from tests import helpers as H
from tests.test_streaming import arrive, stream

EVENTS = [
    {"at": "2024-01-01T00:00:00"},
    {"at": "2024-01-01T00:00:00", "event_id": None, "user_id": None},
    {"at": "2024-01-02T00:00:00", "platform": None},
]
MONEY = [
    {"at": "2024-01-01T00:00:00", "amount": -5},
    {"at": "2024-01-01T00:00:00", "amount": 5, "fee": 9, "transaction_id": None},
]


def test_a_written_table_is_measured_in_its_own_pass(spark, tmp_path):
    events, path = H.events(spark, EVENTS), str(tmp_path / "events")
    scans = []

    def write(df):
        scans.append(df)
        df.write.parquet(path)

    found = ingest.measured_write(events, ingest.event_measures(events), write)
    assert len(scans) == 1 and spark.read.parquet(path).count() == found[ingest.ROWS] == 3
    counted = ingest.long(spark, found)
    assert H.dicts(ingest.null_rates(counted), "column") == H.dicts(monitors.null_rate_by_column(events), "column")
    rules = {name: rule() for name, rule in checks.EVENT_ROW_RULES.items()}
    whole = {r.check_name: r.violations for r in checks.violation_counts(events, rules).collect()}
    assert {r.check_name: r.violations for r in ingest.row_checks(counted).collect()} == whole


def test_the_batches_of_a_stream_add_up_and_a_replay_adds_nothing(spark, tmp_path):
    counts = ingest.log(spark, str(tmp_path / "counts"))
    wanted = ingest.transaction_measures(H.transactions(spark, []))
    for rows in (MONEY, MONEY[:1], []):
        arrive(H.transactions(spark, rows), tmp_path / "in")
        source = stream(spark, tmp_path / "in")
        where = (str(tmp_path / "rows"), counts, dt.date(2024, 1, 5), str(tmp_path / "cp"))
        ingest.feed(source, wanted, *where, once=True)
    every = H.transactions(spark, MONEY + MONEY[:1])
    users = H.users(spark, [])
    whole = report.quality_report(H.events(spark, EVENTS), every, users)
    found = ingest.row_checks(ingest.totals(counts))
    names = [r.check_name for r in found.collect()]
    assert sorted(names) == sorted(checks.TXN_ROW_RULES)
    whole = whole.where(whole.check_name.isin(names))
    assert H.dicts(found, "check_name") == H.dicts(whole.select(found.columns), "check_name")
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 3


def test_an_empty_table(spark, tmp_path):
    events = H.events(spark, [])
    found = ingest.measured_write(
        events, ingest.event_measures(events), lambda df: df.write.parquet(str(tmp_path / "e"))
    )
    assert set(found.values()) == {0}
    assert ingest.totals(ingest.log(spark, str(tmp_path / "none"))).count() == 0
