"""N-gram Jaccard join by vertical partitioning.

1. *Sets.* A document's set holds the hashes of its distinct five-word shingles. Documents of
   equal sets form a class (keyed by a 128-bit digest and the size); one set per class goes on.
2. *Order.* All shingle occurrences of all documents are counted in 2**18 cells. The global order
   of shingles is (count of the cell, hash), rare ones first, and it is cut into ``FRAGMENTS``
   ranges of about equal weight.
3. *Candidates.* Two sets of similarity 0.8 share a shingle of their prefixes (the first fifth in
   the global order). Within the sets that share a prefix shingle, the one where it stands first
   leads, and every other one is compared with the leader: links, not all pairs of a group.
   Sets that still lie in different components after that and meet in a prefix shingle, within
   the bounds on lengths and places, are then compared with each other.
4. *Overlap.* A pair's overlap is counted for each fragment of the order separately, from the
   two segments that lie in it, and summed per pair: ``9 * overlap >= 4 * (n1 + n2)`` links.
5. *Components* by alternating stars.

Nothing of one group meets in one task: groups are reduced by partial aggregates, and joins on
possibly hot keys have a shuffle on both sides that Spark can split.

Defined results: null and word-less texts have empty sets and link with nothing; documents
without id have no component; rows of one id count as one document, with all their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm import bloom, tokens
from kpiweave.llm.common import broadcast, stored
from kpiweave.llm.graph import components

SIZE = 5
FRAGMENTS = 4
CELL_BITS = 18
SID_BITS = 50  # a class number is (partition << 33) + row: room for 2**17 partitions
U64 = np.uint64


def shingle_sets(w: tokens.Words, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of each distinct shingle, in order of both. A text of fewer words
    is one shingle."""
    counts = w.counts
    start, h = tokens.runs(w, size)
    texts, hashes = [w.text_of()[start]], [h]
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        texts.append(short)
        hashes.append(tokens.runs_at(w, w.first[short], k))
    text, h = np.concatenate(texts), np.concatenate(hashes)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]


def _digests(text: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Size and 128-bit digest of each of ``n`` texts' sets."""
    first = np.searchsorted(text, np.arange(n + 1))
    out = [np.diff(first)]
    for salt in (0xA5A5A5A5DEADBEEF, 0x0123456789ABCDEF):
        sums = np.zeros(len(h) + 1, U64)
        np.cumsum(tokens.mix(h ^ U64(salt)), out=sums[1:])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return tuple(out)


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - CELL_BITS)).astype(np.int64)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document; at the end of the task, a row per cell with its count."""
    names = ["doc_id", "n", "d1", "d2", "cell"]
    seen = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        for part in tokens.slices(batch, "text"):
            w = tokens.words(part.column("text"), tokens.PLAIN_LOWER)
            text, h = shingle_sets(w)
            seen += np.bincount(_cells(h), minlength=len(seen))
            size, d1, d2 = _digests(text, h, part.num_rows)
            none = pa.nulls(part.num_rows, pa.int32())
            yield pa.record_batch([part.column("doc_id"), size, d1, d2, none], names=names)
    some = np.flatnonzero(seen)
    none = pa.nulls(len(some), pa.int64())
    cells = pa.array(some.astype(np.int32))
    yield pa.record_batch([none, pa.array(seen[some]), none, none, cells], names=names)


class Order:
    """The global order of shingles and its fragments."""

    def __init__(self, weights: np.ndarray, fragments: int) -> None:
        self.weights, self.fragments = weights, fragments
        by_weight = np.argsort(weights, kind="stable")
        reached = np.cumsum(weights[by_weight])
        self.fragment = np.zeros(len(weights), np.int8)
        whole = max(int(reached[-1]), 1)
        self.fragment[by_weight] = np.minimum((reached - 1) * fragments // whole, fragments - 1)

    def prefixes(self, text: np.ndarray, h: np.ndarray, n: int) -> list[np.ndarray]:
        """Each text's first shingles in the order, as many as a partner must share one of."""
        order = np.lexsort((h, self.weights[_cells(h)], text))
        first = np.searchsorted(text, np.arange(n + 1))
        size = np.diff(first)
        need = size - (4 * size + 4) // 5 + 1
        ranked = h[order].view(np.int64)
        return [ranked[a : a + k] for a, k in zip(first[:-1], np.minimum(need, size))]


def _prefix_rows(order) -> object:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), tokens.PLAIN_LOWER)
                text, h = shingle_sets(w)
                size, d1, d2 = _digests(text, h, part.num_rows)
                prefix = order.value.prefixes(text, h, part.num_rows)
                packed = pa.array(prefix, pa.list_(pa.int64()))
                yield pa.record_batch(
                    [part.column("doc_id"), size, d1, d2, packed],
                    names=["rep", "n", "d1", "d2", "prefix"],
                )

    return rows


def _wanted_rows(wanted) -> object:
    """The prefix shingles that the filter knows, a row each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            h = lists.flatten().to_numpy(zero_copy_only=False)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(batch.num_rows), size)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
            take = np.flatnonzero(bloom.has(wanted.value, h))
            where = pa.array(of[take])
            columns = [batch.column("sid").take(where), batch.column("n").take(where)]
            columns += [pa.array(pos[take].astype(np.int32)), pa.array(h[take])]
            yield pa.record_batch(columns, names=["sid", "n", "pos", "h"])

    return rows


def _segment_rows(order, wanted) -> object:
    """The segments of the sets that the filter knows, a row per fragment."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = int(order.value.fragments)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            kept = batch.filter(pa.array(bloom.has(wanted.value, ids)))
            for part in tokens.slices(kept, "text"):
                w = tokens.words(part.column("text"), tokens.PLAIN_LOWER)
                text, h = shingle_sets(w)
                summary = _digests(text, h, part.num_rows)
                cut = order.value.fragment[_cells(h)]
                segments = []
                for a, b in zip(*_ends(text, part.num_rows)):
                    own, at = h[a:b], cut[a:b]
                    segments += [own[at == f].tobytes() for f in range(parts)]
                again = np.repeat(np.arange(part.num_rows), parts)
                columns = [part.column("doc_id").take(pa.array(again))]
                columns += [pa.array(x[again]) for x in summary]
                columns.append(pa.array(np.tile(np.arange(parts, dtype=np.int32), part.num_rows)))
                columns.append(pa.array(segments, pa.binary()))
                names = ["rep", "n", "d1", "d2", "f", "segment"]
                yield pa.record_batch(columns, names=names)

    return rows


def _ends(text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.searchsorted(text, np.arange(n + 1))
    return first[:-1], first[1:]


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("left"), batch.column("right")
        found = np.zeros(batch.num_rows, np.int64)
        for i in range(batch.num_rows):
            a = np.frombuffer(left[i].as_buffer(), U64)
            b = np.frombuffer(right[i].as_buffer(), U64)
            if len(a) and len(b):  # both sorted, each without repeats
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                found[i] = np.count_nonzero(a[at] == b)
        yield pa.record_batch(
            [*(batch.column(c) for c in ("a", "b", "f", "both")), pa.array(found)],
            names=["a", "b", "f", "both", "overlap"],
        )


def _close() -> object:
    return 5 * F.least("n", "n2") >= 4 * F.greatest("n", "n2")


def _needed() -> object:
    """How many shingles the prefixes of sets of n and n2 must have in common. Past the prefix
    that ends first in the order, at most the rest of its set can still be shared."""

    def rest(n):
        return F.floor((4 * F.col(n) + 4) / 5) - 1

    return F.ceil(4 * (F.col("n") + F.col("n2")) / 9) - F.greatest(rest("n"), rest("n2"))


class Join:
    """The steps over one table of documents (doc_id, text); results are stored tables."""

    def __init__(self, documents: DataFrame, fragments: int = FRAGMENTS) -> None:
        self.texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        self.fragments = fragments
        context = documents.sparkSession.sparkContext
        made = stored(
            self.texts.mapInArrow(
                _summaries, "doc_id bigint, n bigint, d1 bigint, d2 bigint, cell int"
            ),
            "shingle-sets",
        )
        self.docs = made.where("cell IS NULL").drop("cell")
        cells = made.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        weights = np.zeros(1 << CELL_BITS, np.int64)
        weights[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        self.order = broadcast(context, Order(weights, fragments))
        used = self.docs.where("n > 0 AND doc_id IS NOT NULL")
        grouped = used.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"))
        numbered = grouped.withColumn("sid", F.monotonically_increasing_id())
        self.classes = stored(numbered, "classes")
        self.links = self._links()

    def _postings(self) -> DataFrame:
        """h, sid, n, pos, leader: prefix shingles that more than one class has."""
        rows = self.texts.where("doc_id IS NOT NULL").mapInArrow(
            _prefix_rows(self.order),
            "rep bigint, n bigint, d1 bigint, d2 bigint, prefix array<bigint>",
        )
        keyed = rows.join(self.classes, ["rep", "d1", "d2", "n"])
        own = stored(keyed.select("sid", "n", "prefix"), "prefixes")
        # Most shingles are in one set only. A first, narrow grouping finds the others.
        every = own.select("sid", F.explode("prefix").alias("h")).groupBy("h")
        spread = every.agg(F.min("sid").alias("low"), F.max("sid").alias("high"))
        shared = stored(spread.where("low < high").select("h"), "shared-shingles")
        wanted = broadcast(own.sparkSession.sparkContext, bloom.build(shared, "h"))
        flat = stored(
            own.mapInArrow(_wanted_rows(wanted), "sid bigint, n bigint, pos int, h bigint"),
            "shared-prefixes",
        )
        mark = F.col("h").bitwiseAND(255)  # a second key, see graph._least
        rank = F.shiftleft(F.least("pos", F.lit(8191)).cast("bigint"), SID_BITS) + F.col("sid")
        met = flat.groupBy("h").agg(
            F.min(rank).alias("first"),
            F.min("sid").alias("low"),
            F.max("sid").alias("high"),
            F.max(mark).alias("k"),
        )
        leaders = met.where("low < high").select(
            "h", "k", F.col("first").bitwiseAND((1 << SID_BITS) - 1).alias("leader")
        )
        return flat.withColumn("k", mark).join(leaders, ["h", "k"]).drop("k")

    def _stars(self, postings: DataFrame) -> DataFrame:
        """a, b: every set with the leaders it may link with, judged by the share of its prefix
        that they lead. This need not find all: what it leaves out, ``_crossing`` looks at."""
        met = postings.where("sid <> leader").groupBy("sid", "leader").agg(
            F.max("n").alias("n"), F.count("*").alias("common")
        )
        sizes = self.classes.select(F.col("sid").alias("leader"), F.col("n").alias("n2"))
        likely = met.join(sizes, "leader").where(_close()).where(2 * F.col("common") >= _needed())
        return likely.select(F.least("sid", "leader").alias("a"), F.greatest("sid", "leader").alias("b")).distinct()

    def _crossing(self, postings: DataFrame, parts: DataFrame) -> DataFrame:
        """a, b: all pairs in different components that may link, by the bounds on lengths, on
        places and on the shingles that their prefixes have in common."""
        root = parts.withColumnRenamed("u", "sid")
        rooted = postings.join(root, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        mark = F.col("h").bitwiseAND(255)
        mixed = (
            rooted.groupBy("h")
            .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(mark).alias("k"))
            .where("low < high")
            .select("h", "k")
        )
        left = stored(rooted.withColumn("k", mark).join(mixed, ["h", "k"]).drop("k"), "mixed")
        names = {"sid": "sid2", "n": "n2", "pos": "pos2", "root": "root2"}
        right = left.drop("leader").withColumnsRenamed(names)
        # At the first shingle that two sets share, only what follows can still be shared.
        most = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
        enough = 9 * most >= 4 * (F.col("n") + F.col("n2"))
        apart = F.col("root") < F.col("root2")
        met = left.join(right, "h").where(apart & _close() & enough)
        pairs = met.select("sid", "sid2").distinct()
        own = left.groupBy("sid").agg(F.max("n").alias("n"), F.collect_set("h").alias("hs"))
        other = own.select(F.col("sid").alias("sid2"), F.col("n").alias("n2"), F.col("hs").alias("hs2"))
        common = F.size(F.array_intersect("hs", "hs2"))
        may = pairs.join(own, "sid").join(other, "sid2").where(common >= _needed())
        return may.select(F.least("sid", "sid2").alias("a"), F.greatest("sid", "sid2").alias("b"))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """a, b of the ``pairs`` that link: overlaps per fragment, summed."""
        named = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        involved = stored(named.join(self.classes, "sid"), "involved")
        wanted = broadcast(self.texts.sparkSession.sparkContext, bloom.build(involved, "rep"))
        segments = self.texts.where("doc_id IS NOT NULL").mapInArrow(
            _segment_rows(self.order, wanted),
            "rep bigint, n bigint, d1 bigint, d2 bigint, f int, segment binary",
        )
        key = ["rep", "n", "d1", "d2", "f"]
        of = {s: self.classes.select(*[F.col(c).alias(f"{c}_{s}" if c != "sid" else s) for c in self.classes.columns]) for s in "ab"}
        close = 5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b")
        both = pairs.join(of["a"], "a").join(of["b"], "b").where(close)
        cut = stored(both, "pairs").withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(self.fragments - 1))))
        for side, name in (("a", "left"), ("b", "right")):
            renamed = segments.withColumnsRenamed(
                {**{c: f"{c}_{side}" for c in key[:-1]}, "segment": name}
            )
            cut = cut.join(renamed, [*[f"{c}_{side}" for c in key[:-1]], "f"])
        sized = cut.select("a", "b", "f", (F.col("n_a") + F.col("n_b")).alias("both"), "left", "right")
        counted = sized.mapInArrow(
            _overlaps, "a bigint, b bigint, f int, both bigint, overlap bigint"
        )
        # Repeated rows of one id bring a fragment twice: it counts once.
        once = counted.groupBy("a", "b", "f").agg(F.max("both").alias("both"), F.max("overlap").alias("overlap"))
        summed = once.groupBy("a", "b").agg(F.max("both").alias("both"), F.sum("overlap").alias("overlap"))
        return summed.where(9 * F.col("overlap") >= 4 * F.col("both")).select("a", "b")

    def _links(self) -> DataFrame:
        postings = stored(self._postings(), "postings")
        stars = stored(self._stars(postings), "stars")
        first = stored(self._verified(stars), "links")
        crossing = self._crossing(postings, components(first))
        rest = stored(crossing.join(stars, ["a", "b"], "left_anti"), "crossing")
        return stored(first.union(self._verified(rest)), "links")

    def _one_id(self) -> DataFrame:
        """a, b: classes that hold texts of the same id; few, if ids are meant to be unique."""
        used = self.docs.where("n > 0 AND doc_id IS NOT NULL")
        spread = used.groupBy("doc_id").agg(F.min("d1").alias("x"), F.max("d1").alias("y"))
        repeated = used.join(spread.where("x < y"), "doc_id").select("doc_id", "d1", "d2", "n")
        held = stored(repeated.distinct().join(self.classes, ["d1", "d2", "n"]), "repeated-ids")
        low = held.groupBy("doc_id").agg(F.min("sid").alias("a"))
        pairs = held.join(low, "doc_id").where("a < sid")
        return pairs.select("a", F.col("sid").alias("b"))

    def report(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every document."""
        same = self._one_id()
        parts = components(self.links.union(same)).withColumnRenamed("u", "sid")
        rooted = self.classes.join(parts, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        rooted = stored(rooted, "rooted")
        named = rooted.groupBy("root").agg(
            F.min("rep").alias("component_id"), F.max(F.hash("root")).alias("k")
        )
        by_class = stored(
            rooted.withColumn("k", F.hash("root")).join(named, ["root", "k"])
            .select("d1", "d2", "n", "component_id"),
            "components",
        )
        linked = self.docs.join(by_class, ["d1", "d2", "n"], "left")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return linked.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def report(documents: DataFrame) -> DataFrame:
    return Join(documents).report()


def representatives(documents: DataFrame) -> DataFrame:
    """The documents whose id is the smallest of their component, and those without id."""
    found = Join(documents).report().where("doc_id <> component_id")
    others = found.select(F.col("doc_id").alias("_other")).distinct()
    return documents.join(others, documents["doc_id"] == others["_other"], "left_anti")
