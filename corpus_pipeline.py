"""The corpus pipeline: stages over ``documents``, each stored as Parquet and read again.

1. toxicity: documents judged toxic go.
2. near_duplicates: of each group of near copies, the document with the smallest id stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. secrets: secrets are masked in the text; no document goes.
5. mixing: tokens per domain, language and source are brought to the target weights.

Each stage's broadcasts are destroyed when its result is stored, and texts go to Python in Arrow
batches of 1,000 rows at most, a setting that the stages leave on the session.

SQL cannot express the first, fourth and fifth stage; the stages are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from kpiweave.llm import decontaminate, jaccard, mixing, secrets, toxicity
from kpiweave.llm.common import released, small_batches, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """Stages share their executors, whose memory keeps what the largest batch took."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.scan(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.production_mix(docs)


STAGES = [
    (name, _in_small_batches(stage))
    for name, stage in (
        ("toxicity", drop_toxic),
        ("near_duplicates", drop_near_copies),
        ("decontamination", drop_contaminated),
        ("secrets", mask_secrets),
        ("mixing", mix_sources),
    )
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with released():
            docs = stored(stage(spark, docs, sf_dir), name)
    return docs
