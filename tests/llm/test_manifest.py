import hashlib
import random
import zlib

import pytest

from kpiweave.llm import manifest as M

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, pos int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def tree(nodes):
    """The top and each node's siblings, per level a pair (left, right)."""
    paths = [[] for _ in nodes]
    held = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, kept = [], []
        for i in range(0, len(nodes), 8):
            run = nodes[i : i + 8]
            for j in range(len(run)):
                for leaf_at in held[i + j]:
                    paths[leaf_at].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(h("".join(run)))
            kept.append([x for part in held[i : i + 8] for x in part])
        nodes, held = above, kept
    return nodes[0], paths


def brute(docs):
    groups = {}
    for doc_id, text, lang, source, n_chars in docs:
        own = leaf(doc_id, text, lang, source, n_chars)
        other = own
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            low = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            other = leaf(doc_id, low, lang, source, n_chars)
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, own, other))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = [tree([x[2] for x in sorted(groups[g])]) for g in names]
    root, tops = tree([m[0] for m in made]) if made else (None, [])
    out = []
    for g, (subroot, paths), last in zip(names, made, tops):
        for (known, doc_id, own, other), path in zip(sorted(groups[g]), paths):
            node = other
            for left, right in path + last:
                node = h(left + node + right)
            text = "".join(a + b for a, b in path + last)
            out.append((doc_id if known else None, own, subroot, root, h(text), node, node == root))
    return sorted(out, key=repr)


def check(spark, docs):
    df = spark.createDataFrame([(d[0], d[1], d[2], d[3], d[4], "x", 1) for d in docs], DOCS)
    got = sorted((tuple(r) for r in M.report(df).collect()), key=repr)
    assert got == brute(docs)


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [
        (1, "Text", "en", "a", 4),
        (2, None, None, None, None),
        (None, "Ünder Älso", "de", "a", 10),
        (None, None, "de", "a", None),
        (3, "", "", "b", 0),
        (3, "", "", "b", 0),
        (3, "other", "", "b", 5),
        (9, "Long " * 100_000, "é", "b", 500_000),
        (-7, "1:x-", "en", "-", 4),
    ]
    check(spark, docs)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 512, 513, 4500])
def test_sizes_around_full_runs_and_blocks(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(10**6), n)
    check(spark, [(i, f"Text {i}" if i % 2 else f"text {i}", "en", "s", i) for i in ids])


@pytest.mark.parametrize("few", [M.FEW_GROUPS, 10])
def test_a_hot_group_a_hot_key_and_many_groups(spark, monkeypatch, few):
    monkeypatch.setattr(M, "FEW_GROUPS", few)
    docs = [(i, f"T{i}", "hot", "s", 1) for i in range(1100)]
    docs += [(5, f"copy {i % 700}", "hot", "s", 1) for i in range(1400)]
    docs += [(i, f"T{i}", f"lang{i}", "s", 1) for i in range(600)]
    check(spark, docs)


def test_empty_table(spark):
    assert M.report(spark.createDataFrame([], DOCS)).count() == 0


def test_the_plan_runs_no_python_and_no_unpartitioned_window(spark, sf_dir):
    plan = M.report(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
