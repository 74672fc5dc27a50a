import corpus_pipeline as P
from kpiweave.llm import jaccard, toxicity
from kpiweave.llm.common import ARROW_ROWS, stored, table
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as near


def test_stages_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels, items = table(spark, sf_dir, "labels"), table(spark, sf_dir, "benchmark")
    bench = [(r.item_id, r.text, None) for r in items.collect()]
    now = docs
    for name, stage in P.STAGES[:4]:
        before = {r.doc_id: r for r in now.collect()}
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns and now.dtypes == docs.dtypes
        now = spark.createDataFrame(now.collect(), docs.schema)
        after = {r.doc_id for r in now.collect()}
        if name == "toxicity":
            bad = toxicity.report(docs, labels).where("predicted = 1").collect()
            assert after == before.keys() - {r.doc_id for r in bad}
        if name == "near_duplicates":
            found = near([(i, r.text) for i, r in before.items()])
            assert after == {i for i, _, c in found if i == c}
        if name == "decontamination":
            found = contaminated([(i, r.text, None) for i, r in before.items()], bench)
            assert after == {i for i, _, hit, _ in found if not hit}
        if name == "secrets":
            assert after == before.keys()
    mixed = P.STAGES[4][1](spark, now, sf_dir)
    assert set(docs.columns) < set(mixed.columns) and mixed.count() > 0
    assert jaccard.representatives(now).count() == now.count()


def test_empty_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_run_applies_the_stages_in_order(spark, sf_dir):
    """Each stage's result is stored, its broadcasts are destroyed, and the next reads the files."""
    now = table(spark, sf_dir, "documents")
    for name, stage in P.STAGES:
        now = stored(stage(spark, now, sf_dir), f"test-{name}")
    got = P.run(spark, sf_dir)
    assert got.dtypes == now.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, now.collect()))
    assert int(spark.conf.get(ARROW_ROWS)) <= 1000
