"""Benchmark decontamination: prefix-filtered containment join of item windows with documents.

Every item is cut into windows of ``WINDOW`` consecutive words. A window's set of shingles
(runs of up to ``SHINGLE`` words) is ordered by rarity, counted over all documents. Whole
containment needs all of them, so the necessary prefix is the single rarest shingle: only its
occurrences in a document are looked at. Its place in the window gives the only possible start
(positional bound); the window must fit into the document from there (length bound); then the
words themselves are compared. A window with a shingle that no document has is dropped at once.

The windows are broadcast in passes of at most ``per_pass`` rows each, so what a task holds is
bounded however large the benchmark is; documents are never shuffled in a single pass, and by
their hits alone in several.

Defined results: null, empty or word-less texts have no words; items without id or words take
no part; an id that repeats names one item with all its texts; repeated documents give a row
each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm import tokens
from kpiweave.llm.common import stored, text_key

WINDOW = 10
SHINGLE = 3
PER_PASS = 500_000
RULE = tokens.ALNUM_LOWER


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, phrase, n: the distinct windows of each item (item_id, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text", 1 << 20):
                w = tokens.words(part.column("text"), RULE)
                ids, phrases, lengths = [], [], []
                for item, low, high in zip(part.column("item_id"), w.first, w.first[1:]):
                    n = min(size, int(high - low))
                    for i in range(low, high - n + 1) if n else ():
                        ids.append(item.as_py())
                        phrases.append(w.join(i, i + n).decode())
                        lengths.append(n)
                columns = [pa.array(ids, pa.int64()), pa.array(phrases, pa.string())]
                columns.append(pa.array(lengths, pa.int32()))
                yield pa.record_batch(columns, names=["item_id", "phrase", "n"])

    named = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("bigint"), "text")
    return named.mapInArrow(cut, "item_id bigint, phrase string, n int").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """phrase, k, place, h: the shingles of each distinct phrase, k words long each."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = tokens.words(batch.column("phrase"), RULE)
            size = np.minimum(w.counts, SHINGLE)
            for k in range(1, SHINGLE + 1):
                start, h = tokens.runs(w, k)
                of = w.text_of()[start]
                take = size[of] == k
                start, h, of = start[take], h[take], of[take]
                yield pa.record_batch(
                    {
                        "phrase": batch.column("phrase").take(pa.array(of)),
                        "k": pa.array(np.full(len(h), k, np.int32)),
                        "place": pa.array((start - w.first[of]).astype(np.int32)),
                        "h": pa.array(h.view(np.int64)),
                    }
                )

    phrases = windows.select("phrase").distinct()
    return phrases.mapInArrow(shingle, "phrase string, k int, place int, h bigint")


def _passes(rows: DataFrame, per_pass: int) -> list[DataFrame]:
    """``rows`` in parts of about ``per_pass`` rows by the hash h; a part is small enough to
    send to every task."""
    n = max(1, -(-rows.count() // per_pass))
    return [rows.where(F.pmod(F.xxhash64("k", "h"), F.lit(n)) == i) for i in range(n)]


def _by_size(k: np.ndarray, h: np.ndarray) -> dict[int, np.ndarray]:
    return {int(x): np.unique(h[k == x]) for x in np.unique(k)}


def _found(w: tokens.Words, wanted: dict[int, np.ndarray]) -> Iterator[tuple]:
    """k, word numbers and indexes into ``wanted[k]`` of the shingles that are wanted."""
    for k, keys in wanted.items():
        start, h = tokens.runs(w, k)
        h = h.view(np.int64)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == h)
        yield k, start[hit], at[hit]


def shingle_counts(documents: DataFrame, shingles: DataFrame, per_pass: int) -> DataFrame:
    """k, h, seen: how often each shingle occurs in all documents."""
    counts = None
    for part in _passes(shingles.select("k", "h").distinct(), per_pass):
        rows = part.toArrow()
        if not rows.num_rows:
            continue
        wanted = _by_size(rows["k"].to_numpy(), rows["h"].to_numpy())
        sent = documents.sparkSession.sparkContext.broadcast(wanted)

        def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            seen = {k: np.zeros(len(keys), np.int64) for k, keys in sent.value.items()}
            for batch in batches:
                for part in tokens.slices(batch, "text"):
                    w = tokens.words(part.column("text"), RULE)
                    for k, _, at in _found(w, sent.value):
                        seen[k] += np.bincount(at, minlength=len(seen[k]))
            for k, n in seen.items():
                some = np.flatnonzero(n)
                yield pa.record_batch(
                    [np.full(len(some), k, np.int32), sent.value[k][some], n[some]],
                    names=["k", "h", "n"],
                )

        found = documents.select("text").mapInArrow(count, "k int, h bigint, n bigint")
        counts = found if counts is None else counts.union(found)
    if counts is None:
        return shingles.select("k", "h", F.lit(0).cast("bigint").alias("seen")).limit(0)
    return counts.groupBy("k", "h").agg(F.sum("n").alias("seen"))


def rarest(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """phrase, k, h, place: the rarest shingle of each phrase that documents may hold."""
    known = shingles.join(counts, ["k", "h"], "left")
    best = F.min(F.struct("seen", "h", "place", "k")).alias("best")
    missing = F.max(F.col("seen").isNull()).alias("missing")
    kept = known.groupBy("phrase").agg(best, missing).where("NOT missing")
    return kept.select("phrase", "best.k", "best.h", "best.place")


def _scan(documents: DataFrame, rows: pa.Table) -> DataFrame:
    """Per document: doc_id, row_key, n_words, the numbers of its hit words, its items."""
    wanted = _by_size(rows["k"].to_numpy(), rows["h"].to_numpy())
    windows: dict[tuple, dict] = defaultdict(lambda: defaultdict(list))
    for row in rows.to_pylist():
        at = int(np.searchsorted(wanted[row["k"]], row["h"]))
        phrase = (row["place"], row["n"], row["phrase"].encode())
        windows[row["k"], at][phrase].append(row["item_id"])
    plain = {key: list(of.items()) for key, of in windows.items()}
    sent = documents.sparkSession.sparkContext.broadcast((wanted, plain))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, windows = sent.value
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), RULE)
                of = w.text_of()
                hits: dict[int, set] = defaultdict(set)
                items: dict[int, set] = defaultdict(set)
                for k, starts, ats in _found(w, wanted):
                    for start, at in zip(starts.tolist(), ats.tolist()):
                        doc = int(of[start])
                        for (place, n, phrase), named in windows[k, at]:
                            low = start - place
                            if low < w.first[doc] or low + n > w.first[doc + 1]:
                                continue
                            if w.join(low, low + n) == phrase:
                                base = low - int(w.first[doc])
                                hits[doc].update(range(base, base + n))
                                items[doc].update(named)
                rows = range(part.num_rows)
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array(w.counts.astype(np.int64)),
                        pa.array([sorted(hits.get(i, ())) for i in rows], pa.list_(pa.int32())),
                        pa.array([sorted(items.get(i, ())) for i in rows], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "row_key", "n_words", "hits", "items"],
                )

    schema = "doc_id bigint, row_key bigint, n_words bigint, hits array<int>, items array<bigint>"
    return documents.mapInArrow(look, schema)


def hits(
    documents: DataFrame, items: DataFrame, size: int = WINDOW, per_pass: int = PER_PASS
) -> DataFrame:
    """doc_id, row_key, n_words, hits (numbers of the hit words), items (ids, sorted): a row
    per document (doc_id, text)."""
    texts = documents.select(F.col("doc_id").cast("bigint"), "text", text_key().alias("row_key"))
    windows = stored(item_windows(items, size), "windows")
    shingles = stored(window_shingles(windows), "shingles")
    keys = stored(rarest(shingles, shingle_counts(texts, shingles, per_pass)), "rarest")
    chosen = windows.join(keys, "phrase")
    parts = [_scan(texts, part.toArrow()) for part in _passes(chosen, per_pass)]
    if len(parts) == 1:
        return parts[0]
    first = [part.withColumn("copies", F.lit(int(i == 0))) for i, part in enumerate(parts)]
    union = first[0]
    for part in first[1:]:
        union = union.union(part)
    merged = union.groupBy("doc_id", "row_key").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sum("copies").cast("int").alias("copies"),
    )
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return merged.withColumn("copy", again).drop("copy", "copies")


def report(found: DataFrame) -> DataFrame:
    """The digest columns of ``hits``."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    n_hit = F.size("hits").cast("bigint")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no window of any item, with all their columns."""
    bad = hits(documents, items).where(F.size("hits") > 0)
    marked = bad.select(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key")).distinct()
    key = text_key(documents["text"])
    same = documents["doc_id"].eqNullSafe(marked["_doc"]) & (key == marked["_key"])
    return documents.join(marked, same, "left_anti")
