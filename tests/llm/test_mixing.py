import random

import pytest
from pyspark.sql import functions as F

from kpiweave.llm import mixing as M

DOCS = "doc_id bigint, text string, lang string, source string, n_tokens string, n int"


def share_out(children, budget):
    """children: name -> (weight, supply). Repeats until no child is short."""
    given = {c: 0.0 for c in children}
    open_ = {c for c, (w, s) in children.items() if w > 0 and s > 0}
    left = budget
    while open_ and left > 1e-9:
        total = sum(children[c][0] for c in open_)
        short = {c for c in open_ if left * children[c][0] / total >= children[c][1] - given[c]}
        if not short:
            for c in open_:
                given[c] += left * children[c][0] / total
            break
        for c in short:
            left -= children[c][1] - given[c]
            given[c] = children[c][1]
        open_ -= short
    return given


def brute(leaves, weights, budget, max_epochs):
    """leaves: path of three -> tokens."""

    def supply(path):
        if any(weights.get(path[:d], 1.0) <= 0 for d in range(1, len(path) + 1)):
            return 0.0
        if len(path) == 3:
            return float(leaves[path] * max_epochs)
        below = {p[: len(path) + 1] for p in leaves if p[: len(path)] == path}
        return sum(supply(p) for p in below)

    def walk(path, budget):
        if len(path) == 3:
            return {path: budget}
        below = {p[: len(path) + 1] for p in leaves if p[: len(path)] == path}
        given = share_out({p: (weights.get(p, 1.0), supply(p)) for p in below}, budget)
        return {k: v for p in below for k, v in walk(p, given[p]).items()}

    return walk((), min(budget, supply(())))


@pytest.mark.parametrize("seed", range(4))
def test_budgets_equal_repeated_redistribution(spark, seed):
    rng = random.Random(seed)
    leaves = {
        (f"d{rng.randrange(3)}", rng.choice("xyz"), f"s{i}'\"é"): rng.choice([1, 5, 100, 4000])
        for i in range(25)
    }
    weights = {("d0",): 3.0, ("d1",): 0.5, ("d1", "x"): 0.0, ("d2", "y"): 7.0}
    weights |= {p: rng.uniform(0.1, 5) for p in list(leaves)[::3]}
    if seed == 3:
        weights[("d2",)] = 0.0
    rows = [(*p, t) for p, t in leaves.items()]
    table = spark.createDataFrame(rows, "domain string, lang string, source string, tokens bigint")
    for share in (0.1, 0.7, 1.4, 9.0):
        budget = share * sum(leaves.values())
        got = {tuple(r)[:3]: r.quota for r in M.leaf_budgets(table, weights, budget, 2).collect()}
        expected = brute(leaves, weights, budget, 2)
        assert got.keys() == expected.keys()
        for p in got:
            assert abs(got[p] - expected[p]) <= 0.51, (p, got[p], expected[p])


def test_prefixes_fill_the_quotas_exactly(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        source = "hot" if i % 3 else f"s{i % 7}"
        text = " ".join(["w"] * rng.randrange(0, 30))
        rows.append((i, text, rng.choice(["en", "de", None]), source, "clash", 1))
    rows += [(5000, None, "en", None, None, None), (None, "a b c", None, None, None, 1)]
    rows += [(3, "x y", "en", "hot", None, 1)] * 2 + [(9, "w " * 30000, "en", "long", None, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    for share in (0.3, 1.5):
        out = M.mix(docs, {("all", "en"): 2.0}, share).collect()
        total = sum(len((r[1] or "").split()) for r in rows)
        taken = sum(r.n_tokens * r.full_epochs + r.prefix_tokens for r in out)
        assert abs(taken - total * share) <= 25  # rounding of the leaves
        assert all(0 <= r.prefix_tokens <= r.n_tokens for r in out)
        assert all(r.n_tokens == len(r.text.split()) for r in out)
        cut = [r for r in out if 0 < r.prefix_tokens < r.n_tokens]
        assert len(cut) <= len({(r.lang, r.source) for r in out})
        again = M.mix(docs.repartition(3), {("all", "en"): 2.0}, share).collect()
        assert sorted(map(repr, again)) == sorted(map(repr, out))
    assert set(docs.columns) - {"n_tokens"} <= set(M.mix(docs, {}, 0.5).columns)


CLASHES = ["_key", "_a", "_place", "need", "quota", "id", "key", "n", "l0", "u0", "place", "a b.c"]


def test_columns_of_any_name_come_out_as_they_went_in(spark):
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(
        f"`{c}` string" for c in CLASHES
    )
    rows = [(i, "w " * (i % 9), "en", f"s{i % 3}", *[f"{c}{i}" for c in CLASHES]) for i in range(60)]
    docs = spark.createDataFrame(rows, schema)
    out = M.mix(docs, {}, 0.5)
    assert out.columns == [*docs.columns, "domain", "n_tokens", "full_epochs", "prefix_tokens"]
    given = {r[0]: r for r in rows}
    found = out.collect()
    assert found and all(tuple(r)[: len(given[r.doc_id])] == given[r.doc_id] for r in found)


def filled(rows, quota, seed=17):
    """(doc_id, text) -> full epochs and tokens of the last one, in the order of the epoch."""
    tokens = sum(n for _, _, n, _ in rows)
    epochs, need = divmod(quota, tokens)
    out = []
    for _, doc_id, n, _ in sorted((p % 2**64, *rest) for p, *rest in rows):
        taken = max(0, min(n, need))
        need -= taken
        if epochs or taken:
            out.append((doc_id, n, epochs, taken))
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [0.35, 1.6])
def test_which_rows_fill_each_prefix(spark, share):
    """Against a sort of each leaf, the last row cut at the token."""
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 9)), "en", f"s{i % 2}", None, 1) for i in range(300)]
    rows += [(7, "same text", "en", "s0", None, 1)] * 5
    docs = spark.createDataFrame(rows, DOCS)
    leaves = [("all", "en", f"s{k}", sum(len(r[1].split()) for r in rows if r[3] == f"s{k}")) for k in range(2)]
    table = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint")
    budget = share * sum(x[3] for x in leaves)
    quotas = {r.source: (r.quota, r.tokens) for r in M.leaf_budgets(table, {}, budget, 2).collect()}
    got = M.mix(docs, {}, share).collect()
    for source, (quota, tokens) in quotas.items():
        own = docs.where(F.col("source") == source)
        place = F.xxhash64(F.lit(17), F.lit(quota // tokens).cast("int"), "doc_id", F.xxhash64("text"))
        placed = own.select(place, "doc_id", F.size(F.split("text", " ")), F.xxhash64("text")).collect()
        mine = [(r.doc_id, r.n_tokens, r.full_epochs, r.prefix_tokens) for r in got if r.source == source]
        assert sorted(mine, key=repr) == filled([tuple(r) for r in placed], quota)


def test_empty_table_and_bad_weights(spark):
    empty = spark.createDataFrame([], DOCS)
    assert M.mix(empty, {}, 0.5).count() == 0
    with pytest.raises(ValueError):
        M.mix(empty, {("all",): -1.0}, 0.5)


def test_token_count(spark):
    texts = [("a\tb\n c", 3), ("", 0), (None, 0), (" \x0b ", 0), ("ä\u00a0b", 1)]
    df = spark.createDataFrame(texts, "text string, n int")
    assert df.where(M.token_count() != F.col("n")).count() == 0
