from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Row

from kpiweave.plans import activity
from kpiweave.streaming import first_logins
from tests import helpers as H
from tests.test_streaming import arrive, stream


def login(day, user, platform="ios", **more):
    return {"at": f"2024-01-{day:02d}T01:00:00", "user_id": user, "platform": platform, **more}


def feed(spark, tmp_path, parts):
    counts = first_logins.daily_changes(spark, str(tmp_path / "counts"))
    seen = []
    for rows in parts:
        arrive(H.events(spark, rows), tmp_path / "in")
        source = stream(spark, tmp_path / "in")
        first_logins.feed(source, counts, str(tmp_path / "cp"), once=True)
        seen.append({r.login_date.day: (r.dau, r.new_users) for r in first_logins.current(counts).collect()})
    return counts, seen


def test_a_late_login_corrects_the_day_that_counted_the_user_as_new(spark, tmp_path):
    parts = [
        [login(9, "usr_1"), login(9, "usr_2"), login(12, "usr_1")],
        [login(4, "usr_1")],
        [login(4, "usr_1", "web"), login(6, "usr_1"), login(9, "usr_test7"), login(9, None)],
    ]
    counts, seen = feed(spark, tmp_path, parts)
    assert seen[0] == {9: (2, 2), 12: (1, 0)}
    assert seen[1] == {4: (1, 1), 9: (2, 1), 12: (1, 0)}
    assert seen[2] == {4: (1, 1), 6: (1, 0), 9: (2, 1), 12: (1, 0)}
    batch = activity.dau_new_returning(H.events(spark, [r for p in parts for r in p]))
    now = first_logins.current(counts).select(batch.columns)
    assert H.dicts(now, "login_date") == H.dicts(batch, "login_date")


def test_any_order_gives_the_batch(spark, tmp_path):
    rng = random.Random(4)
    rows = [
        login(rng.randint(1, 28), f"usr_{int(rng.paretovariate(0.8)) % 20}", rng.choice(["ios", "web", "tv"]))
        for _ in range(400)
    ]
    counts, _ = feed(spark, tmp_path, [rows[:150], rows[150:300], rows[300:]])
    batch = activity.dau_new_returning(H.events(spark, rows))
    now = first_logins.current(counts).select(batch.columns)
    assert H.dicts(now, "login_date") == H.dicts(batch, "login_date")
    assert counts.compact(dt.date(2030, 1, 1)) > 0
    assert H.dicts(first_logins.current(counts), "login_date") == H.dicts(now, "login_date")


def test_nothing_yet(spark, tmp_path):
    counts = first_logins.daily_changes(spark, str(tmp_path / "counts"))
    assert first_logins.current(counts).count() == 0


def test_a_batch_reads_and_writes_the_state_of_a_user_once():
    class Value:
        calls, kept = 0, None

        def get(self):
            Value.calls += 1
            return Value.kept

        def update(self, value):
            Value.calls += 1
            Value.kept = value

    class Handle:
        def getValueState(self, *_):
            return Value()

    user = first_logins.FirstLogins()
    user.init(Handle())
    rows = [Row(day=20_000 + i % 60, platforms=1) for i in range(600)]
    changes = list(user.handleInputRows(("usr_1",), iter(rows), None))
    assert sum(c.dau for c in changes) == 60 and Value.calls == 2
    earlier = [Row(day=19_999, platforms=2)]
    changes = {c.day: c.new_users for c in user.handleInputRows(("usr_1",), iter(earlier), None)}
    assert changes == {19_999: 1, 20_000: -1} and Value.calls == 4
