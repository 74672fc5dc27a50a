import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiweave.llm import ann as A
from kpiweave.llm.common import table

VECTORS = "vec_id bigint, embedding array<float>, label int, v string, g int"


def brute(rows, is_query, k=10):
    good = {}
    for i, v in rows:
        fine = v and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if fine:
            good[i] = min(good.get(i, list(v)), list(v))
    out = {}
    for q, a in good.items():
        if is_query(q):
            near = sorted(
                (float(np.sqrt(((np.float64(a) - np.float64(b)) ** 2).sum())), i)
                for i, b in good.items()
                if i != q and len(a) == len(b)
            )
            out[q] = near[:k]
    return out


def compare(found, expected, least):
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got.keys() == {q for q, near in expected.items() if near}
    hits = total = 0
    for q, near in expected.items():
        mine = got.get(q, [])
        assert len(mine) == len(near) and mine == sorted(mine)
        exact = dict((i, d) for d, i in near)
        for d, i in mine:
            if i in exact:
                assert abs(d - exact[i]) < 1e-12
        hits += len({i for _, i in mine} & exact.keys())
        total += len(near)
    assert hits >= least * total, (hits, total)


def test_recall_on_given_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    compare(A.report(vectors).collect(), brute(rows, lambda i: i % 100 == 0), 0.95)


@pytest.mark.parametrize("dim", [3, 128])
def test_recall_on_clusters(spark, dim):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(20, dim)) * 2
    v = (centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, dim))).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    data = spark.createDataFrame([(i, x, 0, "", 0) for i, x in rows], VECTORS)
    found = A.search(data, F.col("vec_id") % 50 == 0).collect()
    compare(found, brute(rows, lambda i: i % 50 == 0), 0.93)


def test_odd_rows_ties_and_copies(spark):
    one = [1.0, 0.0, 2.0]
    rows = [(i, one) for i in range(0, 4000, 2)]  # copies: ties go to smaller ids
    rows += [(7, [1.0, 0.5, 2.0]), (9, None), (11, [0.0] * 3), (13, [1.0, None, 1.0]), (15, [])]
    rows += [(17, [float("nan"), 1.0, 1.0]), (19, [float("inf"), 1.0, 1.0]), (None, one)]
    rows += [(21, [1.0, 2.0]), (5000, [2.0, 1.0]), (7, [1.0, 0.5, 2.0]), (23, [1.0])]
    data = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], VECTORS)
    found = A.report(data)
    assert [f"{n}:{t}" for n, t in found.dtypes] == ["query_id:bigint", "rank:int", "vec_id:bigint", "score:double"]
    expected = brute(rows, lambda i: i % 100 == 0)
    compare(found.collect(), expected, 1.0)
    own = sorted((r["rank"], r.vec_id) for r in found.collect() if r.query_id == 100)
    assert own == list(enumerate(range(0, 20, 2), 1))


def test_empty_table(spark):
    assert A.report(spark.createDataFrame([], VECTORS)).count() == 0


def test_products_of_packed_codes_are_those_of_the_signs():
    rng = np.random.default_rng(3)
    for dim in (1, 7, 64, 100, 128):
        x, q = rng.normal(size=(50, dim)), rng.normal(size=(4, dim))
        codes = A.packed(x > 0)
        low, step, bits = A.planes(q)
        signs = np.where(x > 0, 1.0, -1.0) / np.sqrt(dim)
        for j in range(4):
            found = A.code_products(codes, dim, low[j], step[j], bits[j])
            # Rounding moves each coordinate by half a step at most.
            assert np.abs(found - signs @ q[j]).max() <= step[j] / 2 * np.sqrt(dim) + 1e-9


def test_few_pairs_are_measured(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 64))
    v = (centres[rng.integers(0, 30, 20_000)] + rng.normal(size=(20_000, 64)) * 0.5).astype(np.float32)
    data = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>")
    tally = spark.sparkContext.accumulator(np.zeros(2, np.int64), A.Tally())
    found = A.search(data, F.col("vec_id") % 500 == 0, tally=tally).collect()
    estimated, measured = tally.value
    assert estimated == 40 * 20_000 and measured < 0.1 * estimated
    whole = v.astype(float)
    hits = 0
    for q in range(0, 20_000, 500):
        d = np.sqrt(((whole - whole[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {r.vec_id for r in found if r.query_id == q})
    assert hits >= 0.95 * 400


def test_copies_of_the_queries_are_not_broadcast(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(300, 8)).tolist()
    data = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>")
    plan = A.report(data)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
