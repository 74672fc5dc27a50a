import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kpiweave.llm import lexical as X
from kpiweave.llm import tokens

DOCS = "doc_id bigint, text string, item string, score int"
ITEMS = "item_id bigint, text string, rank int"


def words(text):
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    return [w.translate(lower) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=50):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c, n in held:
            m = 50 + (50 * n * n_docs) // length
            score = 0
            for t in set(words(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, known, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, doc_id if known else None, -score))
    return sorted(out, key=repr)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 7) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in X.search(d, q, **more).collect()), key=repr)


def corpus(n, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünder", "née", "A1"]
    docs = []
    for i in range(n):
        size = int(rng.paretovariate(0.7) * 5) % 900
        docs.append((i, " ".join(vocabulary[int(rng.paretovariate(0.6)) % 303] for _ in range(size))))
    items = [(j, " ".join(rng.choices(vocabulary, k=12))) for j in range(12)]
    return docs, items


@pytest.mark.parametrize("per_pass", [X.PER_PASS, 40])
def test_against_brute_force_with_nulls_ties_and_repeats(spark, per_pass, monkeypatch):
    docs, items = corpus(400)
    docs += [(None, "w1 w2 w3"), (7, "w1 w2 w3"), (7, "w1 w2 w3"), (6, "w1 w2 w3"), (None, None), (900, "")]
    docs += [(i, "Copy of w5 w6 w7 and W8") for i in range(1000, 1090)]
    docs += [(2000, "w1 " * 60_000 + "w2")]
    items += [(None, "w1-w2"), (3, "w4 w9"), (50, None), (51, "..."), (52, "nowhere"), (53, "COPY w5 w6 w8")]
    assert run(spark, docs, items, per_pass=per_pass) == brute(docs, items)


def test_fewer_than_k_and_empty_tables(spark):
    docs = [(1, "a b"), (2, "b c")]
    assert run(spark, docs, [(1, "b c"), (2, "b")]) == brute(docs, [(1, "b c"), (2, "b")])
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, docs, []) == []


@pytest.mark.parametrize("seed", range(20))
def test_intervals_resolve_membership_ties_and_scores(seed):
    """The kernel, with small blocks and many ties, against plain sums."""
    rng = np.random.default_rng(seed)
    n, lists, total = 500, [], np.zeros(500, np.int64)
    for _ in range(6):
        docs = rng.permutation(n)[: rng.integers(1, n)]
        impacts = np.sort(rng.zipf(1.5, len(docs)).clip(1, 50))[::-1].astype(np.int64)
        lists.append((docs, impacts))
        total[docs] += impacts
    earlier = np.sort(rng.integers(1, 40, 10)).astype(np.int64)
    at, score, read = X.nra(lists, n, earlier, 10, first=4)
    assert (total[at] == score).all()
    bar = np.sort(np.concatenate([total[total > 0], earlier]))[-10]
    assert set(np.flatnonzero(total >= bar)) <= set(at)
    assert read <= sum(len(d) for d, _ in lists)


def test_reading_stops_before_the_lists_end():
    docs = np.arange(5000)
    impacts = np.full(5000, 1, np.int64)
    impacts[:10] = 1000
    at, score, read = X.nra([(docs, impacts), (docs, impacts)], 5000, np.zeros(0, np.int64), 10, first=16)
    assert set(at) == set(range(10)) and (score == 2000).all() and read == 32


def test_terms_of_one_hash_are_told_apart_by_letters():
    import pyarrow as pa

    table = pa.table({"item": [0, 0, 1], "term": ["alpha", "beta", "beta"]})
    terms = X.Terms.of(table)
    terms.hashes[:] = terms.hashes[0]
    w = tokens.words(pa.array(["beta gamma alpha Alpha"]), X.RULE)
    w.hashes[:] = terms.hashes[0]
    word, term = terms.places(w)
    named = [terms.data[terms.start[t] : terms.end[t]].tobytes() for t in term]
    assert sorted(zip(word.tolist(), named)) == [(0, b"beta"), (2, b"alpha"), (3, b"alpha")]
