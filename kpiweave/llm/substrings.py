"""Removal of long passages that an earlier document holds, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash of the runs of
``RUN`` words in it. Consecutive windows that share a minimiser form a super-k-mer and travel as
one packed string to the minimiser's bucket.

1. Minimisers that occur in one document only cannot hold a repeated window. A thin first scan
   finds the others.
2. A second scan packs the super-k-mers of those. Equal ones (by 128-bit digests of their words)
   fall together before and after the shuffle, with the smallest document id of each.
3. Every copy of a super-k-mer in a later document is removed whole. Only where a bucket holds
   different super-k-mers are they cut into windows, whose words are compared by 128-bit digest,
   grouped and counted exactly; that decides about the first holder of each super-k-mer.
4. The removed spans of a document meet its text; texts without any are not shuffled.

A bucket is never gathered: every step is an aggregate with partial sums or a join that Spark
can split, so a passage that a third of the documents share is no hot spot.

Defined results: null and empty texts have no words; documents without id neither lose words nor
make others lose any; windows within one id do not count against each other; rows that repeat an
id with other texts are judged each by its own text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm import bloom, tokens
from kpiweave.llm.common import stored, text_key

WINDOW = 50
RUN = 8
LONGEST = 64  # windows in one super-k-mer; a longer stretch is cut, which loses no window
SUPER = (
    "mini bigint, s1 bigint, s2 bigint, doc_id bigint, row_key bigint, start bigint,"
    " n int, packed binary"
)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def super_kmers(w: tokens.Words, window: int) -> tuple[np.ndarray, ...]:
    """Word number of the first window, number of windows and minimiser of each super-k-mer."""
    run = min(RUN, window)
    none = np.zeros(0, np.int64)
    if len(w.hashes) < window:
        return none, none, none.view(np.uint64)
    at, h = tokens.runs(w, run)
    grams = np.full(len(w.hashes), np.uint64(2**64 - 1))
    grams[at] = h
    least = _sliding_least(grams, window - run + 1)
    last = np.repeat(w.first[1:], w.counts)
    start = np.arange(len(w.hashes) - window + 1)
    start = start[start + window <= last[start]]
    if not len(start):
        return none, none, none.view(np.uint64)
    mini = least[start]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 1) | (mini[1:] != mini[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(start)))
    into = np.arange(len(start)) - np.repeat(first, size)
    first = np.flatnonzero(into % LONGEST == 0)
    return start[first], np.diff(np.append(first, len(start))), mini[first]


def _digest(words: bytes) -> tuple[int, int]:
    both = np.frombuffer(hashlib.blake2b(words, digest_size=16).digest(), np.int64)
    return int(both[0]), int(both[1])


def _minimisers(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), tokens.PLAIN)
                start, _, mini = super_kmers(w, window)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                yield pa.record_batch(
                    [mini.view(np.int64), ids[w.text_of()[start]]], names=["mini", "doc_id"]
                )

    return rows


def _packed(window: int, shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), tokens.PLAIN)
                start, n, mini = super_kmers(w, window)
                mini = mini.view(np.int64)
                take = bloom.has(shared.value, mini)
                start, n, mini = start[take], n[take], mini[take]
                of = w.text_of()[start] if len(start) else start
                low, count = start.tolist(), n.tolist()
                packed = [w.join(a, a + k + window - 1) for a, k in zip(low, count)]
                digests = np.array([_digest(p) for p in packed], np.int64).reshape(-1, 2)
                where = pa.array(of)
                columns = [mini, digests[:, 0], digests[:, 1]]
                columns += [part.column("doc_id").take(where), part.column("row_key").take(where)]
                columns += [start - w.first[of], n.astype(np.int32), pa.array(packed, pa.binary())]
                names = [f.split()[0] for f in SUPER.split(", ")]
                yield pa.record_batch([pa.array(c) for c in columns], names=names)

    return rows


def _windows(window: int):
    """The windows of packed super-k-mers, by digest."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["w1", "w2", "s1", "s2", "i", "holder"]
        for batch in batches:
            out = []
            for s1, s2, holder, packed in zip(*batch.to_pydict().values(), strict=True):
                words = packed.split(b" ")
                for i in range(len(words) - window + 1):
                    digest = _digest(b" ".join(words[i : i + window]))
                    out.append((*digest, s1, s2, i, holder))
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    return rows


def removed_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row_key, spans (first word, number of words) to remove. ``texts``: doc_id,
    row_key, text."""
    named = texts.where("doc_id IS NOT NULL")
    thin = named.mapInArrow(_minimisers(window), "mini bigint, doc_id bigint")
    holders = thin.groupBy("mini").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = bloom.build(stored(holders.where("low < high").select("mini"), "minimisers"), "mini")
    sent = texts.sparkSession.sparkContext.broadcast(shared)
    supers = stored(named.mapInArrow(_packed(window, sent), SUPER), "super-kmers")

    key = ["mini", "s1", "s2"]
    firsts = stored(supers.groupBy(*key).agg(F.min("doc_id").alias("holder")), "first-holders")
    mark = F.col("s1").bitwiseAND(255)  # a second key, so that both sides are dealt anew
    marked = firsts.withColumn("k", mark)
    seen = supers.drop("packed").withColumn("k", mark).join(marked, [*key, "k"])
    whole = seen.where("doc_id > holder").select(
        "doc_id", "row_key", "start", (F.col("n") + window - 1).cast("bigint").alias("size")
    )

    crowded = (
        firsts.groupBy("mini")
        .agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("s1", "s2") for f in (F.min, F.max)])
        .where("min_s1 < max_s1 OR min_s2 < max_s2")
        .select("mini", F.col("mini").bitwiseAND(255).alias("k"))
    )
    mixed = firsts.withColumn("k", F.col("mini").bitwiseAND(255)).join(crowded, ["mini", "k"])
    own = supers.withColumnRenamed("doc_id", "holder").join(
        mixed.drop("k"), [*key, "holder"], "left_semi"
    )
    own = stored(own.select("s1", "s2", "mini", "holder", "row_key", "start", "packed"), "mixed")
    once = own.dropDuplicates(["s1", "s2"]).select("s1", "s2", "holder", "packed")
    schema = "w1 bigint, w2 bigint, s1 bigint, s2 bigint, i bigint, holder bigint"
    cut = stored(once.mapInArrow(_windows(window), schema), "windows")
    least = cut.groupBy("w1", "w2").agg(
        F.min("holder").alias("least"), F.max(F.col("w1").bitwiseAND(255)).alias("k")
    )
    later = cut.withColumn("k", F.col("w1").bitwiseAND(255)).join(least, ["w1", "w2", "k"])
    later = later.where("least < holder").select("s1", "s2", "i")
    part = own.join(later, ["s1", "s2"]).select(
        F.col("holder").alias("doc_id"),
        "row_key",
        (F.col("start") + F.col("i")).alias("start"),
        F.lit(window).cast("bigint").alias("size"),
    )
    spans = whole.union(part).groupBy("doc_id", "row_key")
    return spans.agg(F.collect_list(F.struct("start", "size")).alias("spans"))


def _sha(w: tokens.Words, text: int, gone: np.ndarray | None = None) -> str:
    low, high = int(w.first[text]), int(w.first[text + 1])
    if gone is None:
        return hashlib.sha256(w.join(low, high)).hexdigest()
    data, s, e = w.data, w.start, w.end
    kept = (np.flatnonzero(~gone) + low).tolist()
    return hashlib.sha256(b" ".join([data[s[i] : e[i]].tobytes() for i in kept])).hexdigest()


def _untouched(touched):
    """Results of texts that keep all words; the text goes along only where it may not."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), tokens.PLAIN)
                keys = part.column("row_key").to_numpy(zero_copy_only=False)
                maybe = bloom.has(touched.value, keys)
                texts = part.column("text")
                sha = [None if m else _sha(w, i) for i, m in enumerate(maybe)]
                carried = [t.as_py() if m else None for t, m in zip(texts, maybe)]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array(w.counts.astype(np.int64)),
                        pa.array(sha, pa.string()),
                        pa.array(carried, pa.string()),
                    ],
                    names=["doc_id", "row_key", "n_words", "sha", "text"],
                )

    return rows


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    for batch in batches:
        for part in tokens.slices(batch, "text"):
            w = tokens.words(part.column("text"), tokens.PLAIN)
            removed, kept = [], []
            columns = [part.column(c).to_pylist() for c in ("sha", "spans")]
            for i, (sha, spans) in enumerate(zip(*columns, strict=True)):
                gone = np.zeros(w.first[i + 1] - w.first[i], bool)
                for span in spans or ():
                    gone[span["start"] : span["start"] + span["size"]] = True
                removed.append(int(gone.sum()))
                kept.append(sha or _sha(w, i, gone))
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    part.column("n_words"),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=names,
            )


def report(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document (doc_id, text)."""
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    texts = documents.select(ids, text_key().alias("row_key"), "text")
    spans = stored(removed_spans(texts, window), "spans")
    touched = texts.sparkSession.sparkContext.broadcast(bloom.build(spans, "row_key"))
    base = texts.mapInArrow(
        _untouched(touched),
        "doc_id bigint, row_key bigint, n_words bigint, sha string, text string",
    )
    return base.join(spans, ["doc_id", "row_key"], "left").mapInArrow(
        _finish, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    )
