"""Ranked lexical search by NRA: impact-sorted lists, read in sequence, with score intervals.

The query terms are known, so one scan turns each document into its query terms with their
frequencies. Sums over these give the statistics. The second pass goes over that narrow table:
a task cuts it into shards of ``SHARD`` documents and gives each shard a list per term, sorted by
impact. NRA reads the lists of an item in sequence, block by block. What was read is a document's
lower bound; what its unread lists can still give, at most the impact that stands next in each,
makes the upper bound. Reading goes on until no document outside the best ``k`` can reach them,
ties included, and the bounds of all that may be among them meet. The best ``k`` of a task's
earlier shards set the bar for the later ones, so a task returns ``k`` rows per item; a salted
top-k merges the tasks. Documents are never shuffled, and a task holds one shard.

Items are searched in passes of about ``PER_PASS`` item terms, which bounds what is broadcast; a
pass reads the documents once.

Defined results: null and empty texts hold no terms and are not counted; each row is a document
and each benchmark row an item, so repeated rows rank one after the other; equal scores rank by
ascending doc_id, a null doc_id first; an item without terms, or whose terms no document holds,
has no rows; no text is cut, whatever its length; columns beyond id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiweave.llm import tokens
from kpiweave.llm.common import stored

RULE = tokens.ALNUM_LOWER
K = 50
SHARD = 16_384  # documents
SHARD_POSTINGS = 4_000_000
FIRST, GROWTH = 256, 4  # a block ends at FIRST, FIRST * GROWTH, ... postings of each list
PER_PASS = 500_000
SALTS = 32


@dataclass(frozen=True)
class Terms:
    """The distinct terms of a pass, ordered by hash, and each item's terms."""

    hashes: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    items: dict[int, np.ndarray]

    @classmethod
    def of(cls, rows: pa.Table) -> Terms:
        found = rows["term"].combine_chunks().dictionary_encode()
        w = tokens.words(found.dictionary.cast(pa.string()), RULE)
        order = np.argsort(w.hashes, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        term = number[found.indices.to_numpy()]
        item = rows["item"].to_numpy()
        by = np.argsort(item, kind="stable")
        names, first = np.unique(item[by], return_index=True)
        lists = np.split(term[by], first[1:])
        items = dict(zip(names.tolist(), lists))
        return cls(w.hashes[order], w.data, w.start[order], w.end[order], items)

    def places(self, w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
        """The words that are terms, and which. A hash only proposes; the letters decide."""
        if not len(self.hashes) or not len(w.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = np.searchsorted(self.hashes, w.hashes)
        word = np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == w.hashes)
        at = low[word]
        words, terms = [], []
        while len(word):
            same = _equal(w, word, self, at)
            words.append(word[same])
            terms.append(at[same])
            # Terms of one hash stand side by side.
            word, at = word[~same], at[~same] + 1
            on = at < len(self.hashes)
            word, at = word[on], at[on]
            on = self.hashes[at] == w.hashes[word]
            word, at = word[on], at[on]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(words), np.concatenate(terms)


def _equal(w: tokens.Words, word: np.ndarray, t: Terms, at: np.ndarray) -> np.ndarray:
    size = w.end[word] - w.start[word]
    same = size == t.end[at] - t.start[at]
    # Letter by letter over all pairs: the number of rounds is the longest term.
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        left = left[size[left] > k]
        differ = w.data[w.start[word[left]] + k] != t.data[t.start[at[left]] + k]
        same[left[differ]] = False
        left = left[~differ]
        k += 1
    return same


def item_terms(items: DataFrame) -> DataFrame:
    """item (number of the row), item_id, term: each distinct term of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), RULE)
                of, rows = w.text_of(), []
                for i in range(len(w.start)):
                    rows.append(w.data[w.start[i] : w.end[i]].tobytes().decode())
                yield pa.record_batch(
                    [part.column("item").take(pa.array(of)), part.column("item_id").take(pa.array(of)), pa.array(rows, pa.string())],
                    names=["item", "item_id", "term"],
                )

    numbered = items.select(F.col("item_id").cast("bigint"), "text").withColumn(
        "item", F.monotonically_increasing_id()
    )
    numbered = stored(numbered, "items")
    return numbered.mapInArrow(cut, "item bigint, item_id bigint, term string").distinct()


def postings(documents: DataFrame, terms: Terms) -> DataFrame:
    """doc_id, n (terms with repeats), terms, tfs: a row per document that has terms."""
    sent = documents.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value
        size = max(len(terms.hashes), 1)
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), RULE)
                word, term = terms.places(w)
                key, tf = np.unique(w.text_of()[word] * size + term, return_counts=True)
                first = np.searchsorted(key, np.arange(part.num_rows + 1) * size)
                offsets = pa.array(first.astype(np.int32))
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array(w.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array((key % size).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    texts = documents.select(F.col("doc_id").cast("bigint"), "text")
    schema = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
    return texts.mapInArrow(count, schema).where("n > 0")


def weights(table: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """The weight of each term, the number of documents and of all their terms."""
    held = table.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    held = held.toArrow()  # a row per term of the pass at most
    df = np.zeros(n_terms, np.int64)
    df[held["t"].to_numpy()] = held["df"].to_numpy()
    docs, length = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    logs = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df]
    return np.array(logs, np.int64), docs, length


@dataclass
class Best:
    """The best documents of an item so far, best first."""

    score: np.ndarray
    doc: np.ndarray
    known: np.ndarray  # whether the id is not null

    @classmethod
    def none(cls) -> Best:
        return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    def merged(self, score: np.ndarray, doc: np.ndarray, known: np.ndarray, k: int) -> Best:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        known = np.concatenate([self.known, known])
        first = np.lexsort((doc, known, -score))[:k]
        return Best(score[first], doc[first], known[first])


def nra(
    lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, earlier: np.ndarray, k: int,
    first: int = FIRST,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents that may be among the best ``k`` of these and of the ``earlier`` scores, with
    their final scores, and the number of postings read. ``lists``: per term the documents and
    their impacts, the highest first; all impacts are positive."""
    lower = np.zeros(n_docs, np.int64)
    ends = [0] * len(lists)
    depth = first
    while True:
        frontier = []
        for i, (docs, impacts) in enumerate(lists):
            stop = min(depth, len(docs))
            lower[docs[ends[i] : stop]] += impacts[ends[i] : stop]
            ends[i] = stop
            frontier.append(int(impacts[stop]) if stop < len(docs) else 0)
        unread = sum(frontier)
        bounds = np.concatenate([lower[lower > 0], earlier])
        bar = int(np.partition(bounds, len(bounds) - k)[len(bounds) - k]) if len(bounds) >= k else 1
        if unread == 0:
            break
        if unread < bar:  # no document not yet seen can reach the best
            upper = lower + unread
            for end, most, (docs, _) in zip(ends, frontier, lists):
                upper[docs[:end]] -= most
            if not np.any((upper >= bar) & (upper > lower)):
                break
        depth *= GROWTH
    chosen = np.flatnonzero(lower >= bar)
    return chosen, lower[chosen], sum(ends)


class _Shard:
    """The impact-sorted lists of some documents."""

    def __init__(self, rows: pa.Table, weight: np.ndarray, docs: int, length: int):
        self.known = rows["doc_id"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        self.doc = rows["doc_id"].combine_chunks().fill_null(0).to_numpy()
        n = rows["n"].to_numpy()
        m = 50 + (50 * n * docs) // max(length, 1)
        sizes = rows["terms"].combine_chunks().value_lengths().to_numpy()
        term = rows["terms"].combine_chunks().flatten().to_numpy()
        tf = rows["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(n)), sizes)
        impact = weight[term] * ((10**9 * tf) // (1000 * tf + 20 * m[doc]))
        some = impact > 0
        term, doc, impact = term[some], doc[some], impact[some]
        order = np.lexsort((-impact, term))
        self.docs, self.impacts = doc[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(weight) + 1))

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        found = [slice(self.first[t], self.first[t + 1]) for t in terms]
        return [(self.docs[s], self.impacts[s]) for s in found if s.stop > s.start]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        for i in range(0, batch.num_rows, SHARD // 16):
            part = batch.slice(i, SHARD // 16)
            held.append(part)
            rows, size = rows + part.num_rows, size + len(part.column("terms").flatten())
            if rows >= SHARD or size >= SHARD_POSTINGS:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _search(table: DataFrame, terms: Terms, k: int) -> DataFrame:
    weight, docs, length = weights(table, len(terms.hashes))
    sent = table.sparkSession.sparkContext.broadcast((terms.items, weight))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = sent.value
        best = {item: Best.none() for item in items}
        for rows in _shards(batches):
            shard = _Shard(rows, weight, docs, length)
            for item, own in items.items():
                so_far = best[item]
                at, score, _ = nra(shard.lists(own), len(shard.doc), so_far.score, k)
                if len(at):
                    best[item] = so_far.merged(score, shard.doc[at], shard.known[at], k)
        for item, found in best.items():
            if len(found.score):
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(found.score), item)),
                        pa.array(found.doc, mask=~found.known),
                        pa.array(found.score),
                    ],
                    names=["item", "doc_id", "score"],
                )

    return table.mapInArrow(look, "item bigint, doc_id bigint, score bigint")


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per item, in two steps so that no task gets all candidates of an item."""
    order = (F.desc("score"), F.asc("doc_id"))
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
    kept = salted.withColumn("at", some).where(F.col("at") <= k).drop("at", "salt")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return kept.withColumn("rank", rank).where(F.col("rank") <= k)


def search(
    documents: DataFrame, items: DataFrame, k: int = K, per_pass: int = PER_PASS
) -> DataFrame:
    """item_id, rank, doc_id, score: the best ``k`` documents of each item."""
    terms = stored(item_terms(items), "item-terms")
    passes = -(-terms.count() // per_pass)
    found = None
    for i in range(passes):
        own = terms.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == i)
        own = Terms.of(own.select("item", "term").toArrow())
        if not own.items:
            continue
        table = stored(postings(documents, own), "postings")
        part = _search(table, own, k)
        found = part if found is None else found.union(part)
    names = terms.select("item", "item_id").distinct()
    if found is None:
        found = terms.select("item", F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    ranked = _top(found, k).join(names, "item")
    return ranked.select("item_id", "rank", "doc_id", "score")
