import random

from kpiweave.llm import toxicity as X

DOCS = "doc_id bigint, text string, lang string, score double"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(values, low, high):
    """Maximal segments by their definition: the best one, then both sides of it."""
    best = max(
        ((sum(values[i:j]), i, j) for i in range(low, high) for j in range(i + 1, high + 1)),
        default=(0, 0, 0),
    )
    if best[0] <= 0:
        return []
    _, i, j = best
    return brute(values, low, i) + [(i, j - 1)] + brute(values, j, high)


def test_segments_equal_the_recursive_definition():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(0, 30)
        values = [rng.uniform(0.1, 3) if rng.random() < 0.4 else -X.DRIFT for _ in range(n)]
        places = [i for i, v in enumerate(values) if v > 0]
        got = X.segments(places, [values[i] for i in places])
        assert [(a, b) for a, b, _ in got] == brute(values, 0, n)
        for a, b, s in got:
            assert abs(s - sum(values[a : b + 1])) < 1e-9


def corpus(n=400):
    rng = random.Random(1)
    plain = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(1, 60))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["vile", "nasty", "foulness"]))
        docs.append((i, " ".join(words), "en", 0.5))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_learns_and_rejects_and_keeps_columns(spark):
    docs, labels = corpus()
    docs += [(1000, "a VILE nasty one", "x", None), (1001, None, "x", 1.0), (1002, "", None, 1.0)]
    docs += [(None, "wordaa", None, 1.0), (1003, "wordab " * 20000, "x", 1.0), (1, docs[1][1], "en", 0.5)]
    documents = spark.createDataFrame(docs, DOCS)
    judged = spark.createDataFrame([*labels, (None, 1, 1), (2, 0, None), (3, 0, 7)], LABELS)
    kept = X.reject(documents, judged)
    assert kept.columns == documents.columns
    ids = [r.doc_id for r in kept.collect()]
    expected = [d[0] for d in docs if d[0] is None or (d[0] % 5 or d[0] > 1000) and d[0] != 1000]
    assert sorted(ids, key=str) == sorted(expected, key=str)
    rows = {r.doc_id: r for r in X.report(documents, judged).collect()}
    assert 0 <= rows[1001].score == rows[1002].score < 0.5 < rows[1000].score <= 1
    assert rows[None].held_out is False and len(rows) == len({d[0] for d in docs})


def test_passages_are_located(spark):
    docs, labels = corpus()
    documents, judged = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    model = X.train(documents, judged)
    one = spark.createDataFrame([(1, "wordaa " * 50 + "vile nasty vile " + "wordab " * 50, "", 0.0)], DOCS)
    found = X.find(one, model).first()
    assert [(p.first, p.last) for p in found.passages] == [(50, 52)] and found.n_tokens == 103


def test_nothing_to_learn_from(spark):
    docs, labels = corpus(30)
    documents = spark.createDataFrame(docs, DOCS)
    for rows in ([], [(i, q, 0) for i, q, _ in labels]):
        report = X.report(documents, spark.createDataFrame(rows, LABELS)).collect()
        assert len(report) == 30 and all(r.predicted == 0 for r in report)
    empty = spark.createDataFrame([], DOCS)
    assert X.report(empty, spark.createDataFrame(labels, LABELS)).count() == 0
