import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiweave.llm import language_model as L
from kpiweave.llm import pitman_yor as P
from kpiweave.llm.common import table

DOCS = "doc_id bigint, text string, h bigint, n bigint"


def brute(rows):
    """All but the model's own score."""

    def split(text):
        return [*(text or "").encode().lower().split(), None]

    def rest(i):
        return None if i is None else zlib.crc32(str(i).encode()) % 10

    counts = Counter(w for i, t in rows if rest(i) for w in split(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = split(t)
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        out.append((i, rest(i) == 0, len(w), sum(x in counts for x in w), total, base))
    return sorted(out, key=repr)


def check(found, rows):
    got = sorted((tuple(r)[:6] for r in found), key=lambda r: repr(r[:5]))
    expected = sorted(brute(rows), key=lambda r: repr(r[:5]))
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    by = {}
    for e in expected:
        by.setdefault(e[:5], []).append(e[5])
    for g in got:
        assert min(abs(g[5] - b) for b in by[g[:5]]) < 1e-6 * max(1, abs(g[5]))
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in found)


@pytest.mark.parametrize("known", [L.KNOWN, 50])
def test_given_documents(spark, sf_dir, known):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = L.report(docs, known).collect()
    check(found, rows)
    held = [r for r in found if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    own, base = (10 ** (-sum(r[c] for r in held) / tokens) for c in ("score", "base_score"))
    assert own < 0.8 * base  # perplexity of held-out texts


def test_odd_rows_and_extra_columns(spark):
    rows = [(i, f"the cat sat on the mat {i % 7} again") for i in range(60)]
    rows += [(100, None), (101, ""), (None, "the cat"), (102, "zzz \x0b Qqq"), (103, "ünï " * 30000)]
    rows += [rows[3], rows[3], (3, "other the"), (104, "zzz " * 50)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], DOCS)
    found = L.report(docs).collect()
    check(found, rows)
    score = {r.doc_id: r.score / r.n_tokens for r in found}
    assert score[5] > score[102]


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(held, "a b"), (None, "c")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], DOCS)
    check(L.report(docs).collect(), rows)
    assert L.report(spark.createDataFrame([], DOCS)).count() == 0


def test_probabilities_sum_to_one(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("text")
    model, seats = L.train(texts)
    assert np.allclose((10.0 ** model.matrix.astype(float)).sum(axis=1), 1, atol=1e-4)
    outside = ~np.isin(model.known, model.head)
    own = (model.counts - model.d * model.seats)[outside].sum()
    own += seats.agg(F.sum(F.col("n") - model.d * F.col("seats"))).first()[0] or 0
    shares = outside.sum() + seats.count() + 1  # of the known words and of those never met
    whole = (own + model.back * shares) / (P.THETA + model.customers)
    assert abs(whole - 1) < 1e-6


def test_seating_follows_the_exact_posterior():
    """Tables of a single dish: P(t) is proportional to the sum over seatings."""
    d, p, c = 0.5, 0.3, 6
    weights = {1: 1.0}  # by tables, the first customer opens one
    for i in range(1, c):
        after = Counter()
        for t, w in weights.items():
            after[t] += w * (i - d * t)
            after[t + 1] += w * (P.THETA + d * t) * p
        weights = after
    total = sum(weights.values())
    n = 40000
    rng = np.random.default_rng(1)
    t = P.seat(np.full(n, c), np.full(n, p), np.zeros(n), d, rng)
    seen = Counter(t.tolist())
    for k, w in weights.items():
        assert abs(seen[k] / n - w / total) < 0.015  # the bias of ten draws
