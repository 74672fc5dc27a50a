"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiweave.llm import (
    ann,
    decontaminate,
    jaccard,
    language_model,
    lexical,
    manifest,
    mixing,
    pagetext,
    pieces,
    secrets,
    substrings,
    toxicity,
    warc,
)
from kpiweave.llm.common import scratch, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path, with_payload=False).drop("url")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.hits(documents, items))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.report(table(spark, sf_dir, "embeddings"))


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.report(table(spark, sf_dir, "pages"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.production_mix(table(spark, sf_dir, "documents")).drop("text", "n_chars")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.report(table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # where the model file lies; no other query needs it

    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.report(table(spark, sf_dir, "documents"), model)


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_decontaminate": op2_decontaminate,
    "op3_nearest": op3_nearest,
    "op4_page_text": op4_page_text,
    "op5_secrets": op5_secrets,
    "op6_mixing": op6_mixing,
    "op7_language_model": op7_language_model,
    "op8_substrings": op8_substrings,
    "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_pieces": op11_pieces,
    "op12_search": op12_search,
    "op13_manifest": op13_manifest,
}
