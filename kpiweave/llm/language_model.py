"""A hierarchical Pitman-Yor language model and the perplexity of texts under it.

Restaurants, from the top:

* *contexts*: one per previous word (the ``CONTEXTS`` most frequent words, one for all others, one
  for the start of a text), serving the ``HEAD`` most frequent words and one dish that stands for
  all others;
* their common *parent*, over the same dishes;
* the *rare* restaurant, serving all other words of the corpus and, like the parent, based on
  equal shares; one share stands for words never met;
* below them, restaurants for *every* previous word (``previous_words``): the contexts above are
  the base of those that share one context, and of all words outside the head.

Customers of a parent are the tables of its children. Seating is sampled by Gibbs sweeps
(``pitman_yor``); predictive probabilities are averaged over the sweeps after the first.

All words of all training texts are counted. Context restaurants are sampled in parallel given
their parent, rare words in parallel given the table totals. What is broadcast is bounded by
parameters: the head, the matrix of contexts and dishes, and counts of the ``KNOWN`` most
frequent words; the tokens of all rarer words meet their counts in a join, summed
per text and word.

Defined results: a null or empty text is the end token alone; texts without id are neither
learned from nor held out; with nothing learned, every text has probability 1 (of one word).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm import pitman_yor as py
from kpiweave.llm import previous_words as pw
from kpiweave.llm import tokens
from kpiweave.llm.common import id_remainder, stored, text_key

HEAD, CONTEXTS, KNOWN = 4096, 510, 1_000_000
SWEEPS, BURN = 3, 1
FOLDS = 10
SEED = 23
END = np.uint64(0x5EED0FE11D0C5EED)  # stands for the end of a text


def _sequences(w: tokens.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes with the end of each text, and the text number of each token."""
    hashes = np.insert(w.hashes, w.first[1:], END)
    return hashes, np.repeat(np.arange(len(w.counts)), w.counts + 1)


def _vocabulary_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h, n of the distinct words of some texts at a time."""
    for batch in batches:
        for part in tokens.slices(batch, "text", 4 << 20):
            w = tokens.words(part.column("text"), tokens.PLAIN_LOWER)
            h, count = np.unique(w.hashes, return_counts=True)
            h, n = np.append(h, END).view(np.int64), np.append(count, part.num_rows)
            yield pa.record_batch([h, n.astype(np.int64)], names=["h", "n"])



@dataclass
class Model:
    head: np.ndarray  # sorted hashes
    rank: np.ndarray  # dish of each: its place by count
    matrix: np.ndarray  # log probability of (context, dish); the last dish is "any other word"
    known: np.ndarray  # sorted hashes of frequent words
    counts: np.ndarray
    seats: np.ndarray  # their mean tables
    back: float  # mean weight of each base share in the rare restaurant
    customers: float  # in the rare restaurant
    d: float
    total: int
    distinct: int
    masses: np.ndarray  # probability of the words outside the head, by group of their hashes

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def rare(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """log10 of the probability of words outside the head, given that one comes."""
        own = np.maximum(c - self.d * t, 0) + self.back
        return np.log10(own / (py.THETA + self.customers))


def _dishes(hashes: np.ndarray, head: np.ndarray, rank: np.ndarray) -> np.ndarray:
    if not len(head):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(head, hashes), len(head) - 1)
    return np.where(head[at] == hashes, rank[at], len(head))


def _contexts(dish: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The context of each token: the dish before it, if frequent enough; the last two stand for
    other words and for the start."""
    out = np.empty(len(dish), np.int64)
    out[1:] = np.minimum(dish[:-1], CONTEXTS)
    if len(out):
        new = np.ones(len(dish), bool)
        new[1:] = text[1:] != text[:-1]
        out[new] = CONTEXTS + 1
    return out


def _pair_rows(sent):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, rank = sent.value
        wide = len(head) + 1
        seen = np.zeros((CONTEXTS + 2) * wide, np.int64)
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), tokens.PLAIN_LOWER)
                hashes, text = _sequences(w)
                dish = _dishes(hashes, head, rank)
                seen += np.bincount(_contexts(dish, text) * wide + dish, minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(some), pa.array(seen[some])], names=["cell", "n"])

    return rows


def _reseat_room(sent, d: float, sweep: int):
    def reseat(key, group):
        parent, tables = sent.value
        u = key[0].as_py()
        rng = np.random.default_rng([SEED, sweep, u])
        dish, n = group["dish"].to_numpy(), group["n"].to_numpy()
        order = np.argsort(dish)
        dish, n = dish[order], n[order]
        whole = len(n) if tables is None else tables[u]
        t = py.seat(n, parent[dish], np.full(len(n), max(whole - 1, 0)), d, rng)
        return pa.table({"u": np.full(len(n), u, np.int32), "dish": dish, "n": n, "t": t})

    return reseat


def _contexts_model(pairs: DataFrame, wide: int) -> np.ndarray:
    """Log probabilities (context, dish), averaged over sweeps. ``pairs``: cell, n."""
    spark = pairs.sparkSession
    rooms = stored(
        pairs.select((F.col("cell") / wide).cast("int").alias("u"), (F.col("cell") % wide).alias("dish"), "n"),
        "context-counts",
    )
    shape = rooms.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    d = py.discount(*shape)
    parent, tables = np.full(wide, 1 / wide), None
    mean, used = np.zeros((CONTEXTS + 2, wide)), 0
    for sweep in range(SWEEPS):
        sent = spark.sparkContext.broadcast((parent, tables))

        seated = rooms.groupBy("u").applyInArrow(
            _reseat_room(sent, d, sweep), "u int, dish bigint, n bigint, t bigint"
        )
        # At most (CONTEXTS + 2) * (HEAD + 1) rows of numbers, whatever the corpus.
        got = seated.toArrow()
        u, dish = got["u"].to_numpy(), got["dish"].to_numpy()
        n, t = got["n"].to_numpy(), got["t"].to_numpy()
        tables = np.bincount(u, t, CONTEXTS + 2)
        c = np.bincount(dish, t, wide).astype(np.int64)
        rng = np.random.default_rng([SEED, sweep])
        some = np.flatnonzero(c)
        top_d = py.discount(int((c == 1).sum()), int((c == 2).sum()))
        flat = np.full(len(some), 1 / wide)
        top = py.seat(c[some], flat, np.full(len(some), max(len(some) - 1, 0)), top_d, rng)
        seats = np.zeros(wide)
        seats[some] = top
        parent = py.predictive(c, seats, 1 / wide, c.sum(), seats.sum(), top_d)
        if sweep >= BURN:
            customers = np.bincount(u, n, CONTEXTS + 2)
            p = (py.THETA + d * tables)[:, None] * parent[None, :]
            p[u, dish] += n - d * t
            mean += p / (py.THETA + customers)[:, None]
            used += 1
    return np.log10(mean / used).astype(np.float32)


def _reseat_rare(sent, d: float, sweep: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, tables = sent.value
        for batch in batches:
            h, c, before, seats = (batch.column(x).to_numpy() for x in ("h", "n", "t", "seats"))
            if not len(h):
                continue
            rng = np.random.default_rng([SEED, sweep, int(h[0]) & 0x7FFFFFFF])
            p = np.full(len(h), share)
            t = py.seat(c, p, np.maximum(tables - before, 0), d, rng)
            seats = seats + t if sweep >= BURN else seats
            yield pa.record_batch([h, c, t, seats], names=["h", "n", "t", "seats"])

    return rows


RARE = "h bigint, n bigint, t bigint, seats double"


def train(texts: DataFrame, known: int = KNOWN) -> tuple[Model, DataFrame]:
    """The model, and h, n, seats of the words outside the head that it doesn't carry."""
    spark = texts.sparkSession
    context = spark.sparkContext
    counted = texts.mapInArrow(_vocabulary_rows, "h bigint, n bigint")
    vocabulary = stored(counted.groupBy("h").agg(F.sum("n").alias("n")), "vocabulary")
    facts = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = int(facts[0]), int(facts[1])
    top = vocabulary.orderBy(F.desc("n"), "h").limit(HEAD).toArrow()
    h = top["h"].to_numpy().view(np.uint64)
    by = np.argsort(h)
    head, rank = h[by], by
    sent = context.broadcast((head, rank))
    pairs = texts.mapInArrow(_pair_rows(sent), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    wide = len(head) + 1
    matrix = _contexts_model(pairs, wide)

    last = (int(top["n"][-1].as_py()), int(top["h"][-1].as_py())) if len(h) else (0, 0)
    outside = (F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("h") > last[1]))
    rare = vocabulary.where(outside).withColumns({"t": F.lit(1).cast("bigint"), "seats": F.lit(0.0)})
    facts = rare.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    d, customers, tables = py.discount(facts[0], facts[1]), float(facts[2]), float(facts[3])
    share, back = 1 / (tables + 1), 0.0
    for sweep in range(SWEEPS):
        sent = context.broadcast((share, tables))
        rare = stored(rare.mapInArrow(_reseat_rare(sent, d, sweep), RARE), "rare-words")
        tables = float(rare.agg(F.coalesce(F.sum("t"), F.lit(0))).first()[0])
        if sweep >= BURN:
            back += share * (py.THETA + d * tables) / (SWEEPS - BURN)
    seats = rare.select("h", "n", (F.col("seats") / (SWEEPS - BURN)).alias("seats"))
    group = F.shiftrightunsigned("h", 8).bitwiseAND(pw.GROUPS - 1).cast("int")
    own = F.greatest(F.col("n") - F.lit(d) * F.col("seats"), F.lit(0.0)) + F.lit(back)
    by_group = seats.groupBy(group.alias("g")).agg(F.sum(own).alias("own")).toArrow()
    # The share of the words never met is spread over the groups.
    masses = np.full(pw.GROUPS, back / pw.GROUPS)
    masses[by_group["g"].to_numpy()] += by_group["own"].to_numpy()
    masses /= py.THETA + customers
    sizes = seats.groupBy("n").count().orderBy("n").toArrow()  # a row per distinct count
    more = np.cumsum(sizes["count"].to_numpy()[::-1])[::-1]
    fits = np.flatnonzero(more <= known)
    least = int(sizes["n"][int(fits[0])].as_py()) if len(fits) else 1 << 62
    frequent = seats.where(F.col("n") >= least).orderBy("h").toArrow()  # at most ``known`` rows
    kh = frequent["h"].to_numpy().view(np.uint64)
    order = np.argsort(kh)
    all_h, all_n = np.concatenate([kh[order], h]), np.concatenate([frequent["n"].to_numpy()[order], top["n"].to_numpy()])
    all_s = np.concatenate([frequent["seats"].to_numpy()[order], np.zeros(len(h))])
    order = np.argsort(all_h)
    model = Model(
        head, rank, matrix, all_h[order], all_n[order], all_s[order],
        back, customers, d, total, distinct, masses,
    )
    return model, seats.where(F.col("n") < least)


PARTS = (
    "doc_id bigint, row_key bigint, held_out boolean, base boolean, h bigint, n bigint,"
    " n_known bigint, base_score double, score double, slot bigint, bucket int, tokens binary"
)
KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 3]
KINDS += [pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.binary()]


def _dealt_rows(dealer: pw.Dealer, names: list[str]) -> Iterator[pa.RecordBatch]:
    for slot, bucket, data in dealer.dealt():
        columns = [pa.nulls(1, kind) for kind in KINDS]
        columns[3] = pa.array([False])
        columns[-3:] = [pa.array([slot]), pa.array([bucket], pa.int32()), pa.array([data], pa.binary())]
        yield pa.record_batch(columns, names=names)


def _score_rows(sent, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = [f.split()[0] for f in PARTS.split(", ")]
        empty = np.zeros(0, np.int64)
        dealer = pw.Dealer(buckets, TaskContext.get().partitionId())
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                w = tokens.words(part.column("text"), tokens.PLAIN_LOWER)
                hashes, text = _sequences(w)
                n = part.num_rows
                dish = _dishes(hashes, m.head, m.rank)
                logs = m.matrix[_contexts(dish, text), dish].astype(np.float64)
                at = np.minimum(np.searchsorted(m.known, hashes), max(len(m.known) - 1, 0))
                found = m.known[at] == hashes if len(m.known) else np.zeros(len(hashes), bool)
                outside = dish == len(m.head)
                both = np.flatnonzero(found & outside)
                logs[both] += m.rare(m.counts[at[both]], m.seats[at[both]])
                base = np.zeros(len(hashes))
                base[found] = m.base(m.counts[at[found]])
                code = np.where(found, (len(m.head) + at).astype(np.uint64), hashes | pw.UNKNOWN)
                code = np.where(outside, code, dish.astype(np.uint64))
                begins = np.ones(len(text), bool)
                begins[1:] = text[1:] != text[:-1]
                room, loose = pw.rooms(code, hashes, begins, len(m.head), CONTEXTS)
                learn = part.column("learn").to_numpy(zero_copy_only=False).astype(np.int64)
                slots = dealer.add(room[loose], code[loose], text[loose], learn)
                lost = np.flatnonzero(~found)
                key = np.lexsort((hashes[lost], text[lost]))
                lost = lost[key]
                new = np.ones(len(lost), bool)
                new[1:] = (hashes[lost][1:] != hashes[lost][:-1]) | (text[lost][1:] != text[lost][:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(lost))) if len(lost) else empty
                once = lost[first]
                of = np.concatenate([np.arange(n), text[once]])
                where = pa.array(of)
                zero = np.zeros(len(once))
                columns = [part.column(c).take(where) for c in ("doc_id", "row_key", "held_out")]
                columns += [
                    pa.array(np.arange(len(of)) < n),
                    pa.array(np.concatenate([np.zeros(n, np.int64), hashes[once].view(np.int64)])),
                    pa.array(np.concatenate([w.counts + 1, times]).astype(np.int64)),
                    pa.array(np.concatenate([np.bincount(text, found, n), zero]).astype(np.int64)),
                    pa.array(np.concatenate([np.bincount(text, base, n), zero])),
                    pa.array(np.concatenate([np.bincount(text, logs, n), zero])),
                    pa.array(slots).take(where),
                    pa.nulls(len(of), pa.int32()),
                    pa.nulls(len(of), pa.binary()),
                ]
                yield pa.record_batch(columns, names=names)
                if dealer.full():
                    yield from _dealt_rows(dealer, names)
        yield from _dealt_rows(dealer, names)

    return rows


def _changes(parts: DataFrame, buckets: int, sent, m: Model, seats: DataFrame) -> DataFrame:
    """slot, change: what the restaurants per previous word change of each text's score."""
    dealt = parts.where("bucket IS NOT NULL").select("bucket", "slot", "tokens")
    dealt = dealt.repartition(buckets, "bucket").groupBy("bucket")
    answers = stored(dealt.applyInArrow(pw.answer(sent, CONTEXTS), pw.ANSWERS), "answers")
    sums = answers.where("sums IS NOT NULL").select("slot", "sums")
    sums = sums.groupBy("slot").applyInArrow(pw.added, "slot bigint, score double")
    # Words outside the broadcast model; their base is met here.
    bit = F.lit(-(1 << 63)).cast("bigint")
    bases = seats.select(F.col("h").bitwiseOR(bit).alias("h"), F.col("n").alias("c"), "seats")
    met = answers.where("h IS NOT NULL").join(bases, "h")
    own = F.greatest(F.col("c") - F.lit(m.d) * F.col("seats"), F.lit(0.0)) + F.lit(m.back)
    score = F.log10(1 + F.col("factor") * F.lit(py.THETA + m.customers) / own)
    both = sums.union(met.select("slot", score.alias("score")))
    return both.groupBy("slot").agg(F.sum("score").alias("change"))


def report(documents: DataFrame, known: int = KNOWN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    rest = id_remainder("doc_id", FOLDS)
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_key().alias("row_key"),
        F.coalesce(rest == 0, F.lit(False)).alias("held_out"),
        F.coalesce(rest != 0, F.lit(False)).alias("learn"),
        "text",
    )
    model, seats = train(texts.where("learn").select("text"), known)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    buckets = 1 + model.total // pw.BUCKET
    parts = stored(texts.mapInArrow(_score_rows(sent, buckets), PARTS), "scored")
    m = model
    met = parts.where("NOT base AND bucket IS NULL").join(seats.withColumnRenamed("n", "c"), "h", "left")
    c, t = F.coalesce("c", F.lit(0)), F.coalesce("seats", F.lit(0.0))
    own = F.greatest(c - F.lit(m.d) * t, F.lit(0.0)) + F.lit(m.back)
    base = F.log10((c + 0.1) / F.lit(m.total + 0.1 * (m.distinct + 1)))
    rare = met.select(
        "doc_id", "row_key", "held_out", "base",
        F.lit(0).cast("bigint").alias("tokens"),
        F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * base).alias("base_score"),
        (F.col("n") * F.log10(own / F.lit(py.THETA + m.customers))).alias("score"),
    )
    changes = _changes(parts, buckets, sent, model, seats)
    whole = parts.where("base").join(changes, "slot", "left").select(
        "doc_id", "row_key", "held_out", "base", F.col("n").alias("tokens"), "n_known", "base_score",
        (F.col("score") + F.coalesce("change", F.lit(0.0))).alias("score"),
    )
    # Equal rows bring equal parts: the sums are divided by the number of rows again.
    summed = whole.union(rare).groupBy("doc_id", "row_key", "held_out").agg(
        F.count_if("base").alias("copies"),
        *[F.sum(x).alias(x) for x in ("tokens", "n_known", "base_score", "score")],
    )
    per = {x: (F.col(x) / F.col("copies")) for x in ("tokens", "n_known", "base_score", "score")}
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return summed.select("*", again.alias("copy")).select(
        "doc_id",
        "held_out",
        F.round(per["tokens"]).cast("bigint").alias("n_tokens"),
        F.round(per["n_known"]).cast("bigint").alias("n_known"),
        F.lit(m.total).cast("bigint").alias("train_tokens"),
        per["base_score"].alias("base_score"),
        per["score"].alias("score"),
    )
