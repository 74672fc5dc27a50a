import random
from collections import defaultdict

import pytest

from kpiweave.llm import jaccard as J
from kpiweave.llm.common import table
from kpiweave.llm.graph import components

DOCS = "doc_id bigint, text string, n bigint, rep string"


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """The definition, over all pairs that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        for g in s if i is not None else ():
            holders[g].append(k)
    pairs = {(x, y) for ks in holders.values() for n, x in enumerate(ks) for y in ks[n + 1 :]}
    for x, y in pairs:
        (a, s), (b, t) = sets[x], sets[y]
        if 100 * len(s & t) >= 80 * len(s | t):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    found = [(i, len(s), None if i is None else find(i)) for i, s in sets]
    return sorted(found, key=repr)


def near_copies(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


def test_groups_of_near_copies_chains_and_odd_rows(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(300)]
    texts = []
    for size in (5, 8, 30, 60, 200):
        base = [rng.choice(vocabulary) for _ in range(size)]
        texts += list(near_copies(rng, base, 40, max(1, size // 25)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(12):  # neighbours link, the ends do not
        texts.append(" ".join(f"new{j}" for j in range(3 * i)) + " " + " ".join(chain[3 * i :]))
    line = " ".join(f"common{i}" for i in range(25))
    texts += [f"{line} " + " ".join(rng.choice(vocabulary) for _ in range(k)) for k in range(40)]
    texts += ["a b", "A\tb", "a b c", "", " \n", "one", "One", "b a", "ä b", "Ä b", texts[0], texts[0]]
    rng.shuffle(texts)
    rows = [(3 * i + 7, t) for i, t in enumerate(texts)]
    rows += [(1, None), (None, "a b"), (None, None), (2, "a b"), rows[5], rows[5]]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], DOCS)
    assert sorted(map(tuple, J.report(docs).collect()), key=repr) == brute(rows)
    kept = J.representatives(docs)
    assert kept.columns == docs.columns
    expected = [(i, c) for i, _, c in brute(rows) if i is None or i == c]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _ in expected), key=str)


def test_texts_of_one_id_are_one_document(spark):
    rows = [(5, "a b c"), (5, "d e f"), (3, "a b c"), (9, "d e f"), (8, "x")]
    got = J.report(spark.createDataFrame([(i, t, 0, "") for i, t in rows], DOCS)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (5, 3), (5, 3), (8, 8), (9, 3)]


def test_empty_table(spark):
    assert J.report(spark.createDataFrame([], DOCS)).count() == 0


def test_given_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, J.report(docs).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_paths_and_stars(spark, n):
    path = [(i, i + 1) for i in range(n)]
    star = [(1000, 1000 + i) for i in range(1, n)] + [(1000 + n, 999)]
    edges = spark.createDataFrame(path + star + [(7000, 7000)], "a bigint, b bigint")
    root = {r.u: r.root for r in components(edges).collect()}
    assert root == {**{i: 0 for i in range(1, n + 1)}, **{1000 + i: 1000 for i in range(1, n)}, 1000 + n: 999}
