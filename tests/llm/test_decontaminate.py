import re

import pytest

from kpiweave.llm import decontaminate as D

DOCS = "doc_id bigint, text string, item_id string"
ITEMS = "item_id bigint, text string, doc_id string"
LONG = " ".join(f"w{i}" for i in range(15))


def words(text):
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))


def brute(docs, items, size=10):
    out = []
    for doc_id, text, _ in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item, _ in items:
            v = words(item)
            n = min(size, len(v))
            if not n or item_id is None:
                continue
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found.add(item_id)
        out.append((doc_id, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=repr)


CASES = [
    (1, f"Start {LONG.upper()} end", "x"),
    (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8, w9", None),
    (3, "w0 w1 w2 w3 w4 w5 w6 w7 w8 x w9", None),
    (4, None, None),
    (5, "", None),
    (6, "one two", None),
    (6, "one two", None),
    (6, "two one two ünder", None),
    (None, "only ünder one two", None),
    (8, " ".join(["w3 w4 w5"] * 50), None),
    (9, "z " * 3000 + LONG, None),
]
BENCH = [(10, LONG, "c"), (9, "One-two", None), (9, "ünder", None), (11, None, None), (12, "...", None)]
BENCH += [(None, "only", None), (13, "w3 w4 w5", None), (10, LONG, "again")]


@pytest.mark.parametrize("per_pass", [D.PER_PASS, 3])
def test_against_brute_force_in_one_and_in_several_passes(spark, per_pass):
    docs, items = spark.createDataFrame(CASES, DOCS), spark.createDataFrame(BENCH, ITEMS)
    rows = D.hits(docs, items, per_pass=per_pass).drop("row_key").collect()
    assert sorted(map(tuple, rows), key=repr) == brute(CASES, BENCH)


def test_clean_keeps_rows_without_hits(spark):
    docs, items = spark.createDataFrame(CASES, DOCS), spark.createDataFrame(BENCH, ITEMS)
    kept = D.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame(BENCH, ITEMS)
    assert D.report(D.hits(docs, items)).count() == 0
    none = D.report(D.hits(spark.createDataFrame(CASES, DOCS), spark.createDataFrame([], ITEMS)))
    assert none.where("contaminated").count() == 0 and none.count() == len(CASES)
