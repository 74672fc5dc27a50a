"""Toxic passages as maximum-scoring segments of token log-odds.

1. *Token scores.* Document frequencies of words and of word beginnings (3 to 7 letters) in toxic
   and clean training documents give log-odds with an informative Dirichlet prior, whose
   pseudo-counts follow the corpus. The lower confidence bound counts, so a word seen a few times
   by chance scores nothing. A word that is too rare takes the score of its longest beginning
   that is not, so new forms of a toxic stem are known too. All else scores ``-DRIFT``.
2. *Segments.* One pass over a document (Ruzzo and Tompa's stack) finds all maximal segments.
3. *Extreme values.* With the Karlin-Altschul scale of the scores, a segment of score S among n
   tokens has the expectation ``K n exp(-lambda S)``; those above chance are the passages, and
   what they have above chance adds up to the document's evidence.
4. *Calibration.* A logistic curve over the evidence of training documents, each scored by the
   half of the training data it is not in, turns evidence into a probability.

The training sample is bounded by ``TRAIN_ROWS`` labelled documents in hash order, which bounds
the model as well, so both are broadcast. Every document is scored whole, in one scan.

Defined results: null and empty texts have no tokens and get the score of no evidence; labels
other than 0 and 1 or without an id teach nothing, a repeated id is toxic if one of its labels
is; without any labelled toxic document all scores are low; documents without id are not held out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.common import broadcast, id_remainder, stored

TRAIN_ROWS = 20_000
FOLDS = 5  # one in so many ids is held out
SUPPORT = 5  # documents that must hold a word before it has a score of its own
PRIOR = 0.125  # weight of the prior, as a share of the training documents
CONFIDENCE = 1.64
DRIFT = 0.5
KNOWN = 100_000  # words whose scores a worker remembers
STEMS = (7, 6, 5, 4, 3)
_WORD = re.compile(r"[^\W\d_]+")
FOUND = (
    "n_tokens bigint, evidence double,"
    " passages array<struct<first: int, last: int, score: double, e_value: double>>"
)


def training_labels(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, toxic, half: at most ``rows`` labelled ids that are not held out."""
    usable = labels.where("toxic IN (0, 1)").where(id_remainder("doc_id", FOLDS) != 0)
    once = usable.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    order = F.xxhash64(F.lit("train"), "doc_id")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")
    return once.withColumn("half", half).orderBy(order, "doc_id").limit(rows)


def _keys(text: str | None) -> set[str]:
    found = set(_WORD.findall((text or "").lower()))
    stems = {w[:n] + "*" for w in found for n in STEMS if len(w) >= n}
    return found | stems


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            part = batch.slice(i, 200)
            counts: Counter = Counter()
            for text, toxic, half in zip(*part.to_pydict().values(), strict=True):
                counts.update((key, 2 * half + toxic) for key in _keys(text))
            keys = [key for key, _ in counts]
            yield pa.record_batch(
                [
                    pa.array(keys, pa.string()),
                    pa.array([c for _, c in counts], pa.int32()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["key", "cell", "n"],
            )


@dataclass(frozen=True)
class Model:
    """Scores of words and of stems (ending in ``*``); the scale of the extreme values; the
    calibration curve. ``parts`` are the models of the two halves, for calibration."""

    scores: dict[str, float]
    scale: float
    density: float
    curve: tuple[float, float]


def _scores(counts: dict[str, list[int]], docs: tuple[int, int]) -> dict[str, float]:
    """``counts``: clean and toxic documents per key. Keeps a key only where it changes the
    result: without it, the word would take another score from a shorter beginning."""
    clean, toxic = docs
    weight = PRIOR * (clean + toxic)
    own: dict[str, float] = {}
    for key, (b, a) in counts.items():
        if a + b < SUPPORT:
            continue
        prior = weight * (a + b) / (clean + toxic)
        up = math.log((a + prior) / (toxic + weight - a - prior + 1e-9))
        down = math.log((b + prior) / (clean + weight - b - prior + 1e-9))
        bound = up - down - CONFIDENCE * math.sqrt(1 / (a + prior) + 1 / (b + prior))
        own[key] = bound if bound > 0 else -DRIFT

    def parent(key: str) -> float:
        stem = key.removesuffix("*")
        longest = len(stem) - key.endswith("*")
        found = (own.get(stem[:n] + "*") for n in STEMS if n <= longest)
        return next((s for s in found if s is not None), -DRIFT)

    return {key: s for key, s in own.items() if s != parent(key)}


def _scale(scores: dict[str, float], counts: dict[str, list[int]], tokens: int) -> float:
    """The root lambda of ``sum p exp(lambda s) = 1`` over the tokens of clean documents."""
    good = [(s, counts[k][0] + PRIOR) for k, s in scores.items() if s > 0]
    if not good or not tokens:
        return 1.0
    s = np.array([x for x, _ in good])
    p = np.array([n for _, n in good]) / tokens
    p = p / max(1.0, 2 * p.sum())
    low, high = 1e-3, 8.0
    for _ in range(60):
        middle = (low + high) / 2
        total = (p * np.exp(np.minimum(middle * s, 500))).sum()
        total += (1 - p.sum()) * math.exp(-middle * DRIFT)
        low, high = (low, middle) if total > 1 else (middle, high)
    return low


class _Scorer:
    """Word scores with a bounded memory of the words met."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores, self.known = scores, {}

    def of(self, word: str) -> float:
        score = self.known.get(word)
        if score is None:
            score = self.scores.get(word)
            if score is None:
                stems = (self.scores.get(word[:n] + "*") for n in STEMS if n <= len(word))
                score = next((s for s in stems if s is not None), -DRIFT)
            if len(self.known) > KNOWN:
                self.known.clear()
            self.known[word] = score
        return score


def segments(places: list[int], scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a sequence that scores ``scores``
    at ``places`` and ``-DRIFT`` elsewhere, in linear time."""
    stack: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, first, last, back
    total, before = 0.0, -1
    for place, score in zip(places, scores, strict=True):
        left = total - DRIFT * (place - before - 1)
        total, before = left + score, place
        right, first, at = total, place, len(stack) - 1
        while True:
            while at >= 0 and stack[at][0] >= left:
                at = stack[at][4]
            if at < 0 or stack[at][1] >= right:
                break
            left, _, first, _, at_back = stack[at]
            del stack[at:]
            at = at_back
        stack.append((left, right, first, place, at))
    return [(first, last, right - left) for left, right, first, last, _ in stack]


def _judge(text: str | None, scorer: _Scorer, scale: float, density: float) -> tuple:
    words = _WORD.findall((text or "").lower())
    scored = [scorer.of(w) for w in words]
    places = [i for i, s in enumerate(scored) if s > 0]
    if not places:
        return len(words), 0.0, []
    chance, passages = math.log(density * max(len(words), 1)), []
    for first, last, score in segments(places, [scored[i] for i in places]):
        above = scale * score - chance
        if above > 0:
            passages.append((above, (first, last, score, math.exp(-above))))
    return len(words), sum(x for x, _ in passages), [p for _, p in passages]


def _calibrate(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not below zero) of a logistic curve over the square root of the
    evidence, by Newton steps with a weak ridge."""
    n, hits = len(toxic), float(toxic.sum()) if len(toxic) else 0.0
    base = math.log((hits + 0.05) / (n - hits + 0.95))
    if n == 0 or hits == 0 or hits == n:
        return base, 0.0
    x = np.column_stack([np.ones(n), np.sqrt(evidence)])
    theta = np.array([base, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (toxic - p) - 1e-2 * theta
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.clip(np.linalg.solve(curvature, gradient), -2, 2)
        theta = theta + step
        if np.abs(step).max() < 1e-9:
            break
    return (float(theta[0]), float(theta[1])) if theta[1] > 0 else (base, 0.0)


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    spark = documents.sparkSession
    chosen = stored(training_labels(labels, rows), "toxic-labels")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sample = stored(texts.join(F.broadcast(chosen), "doc_id"), "toxic-sample")
    cells = sample.select("text", "toxic", "half").mapInArrow(_count, "key string, cell int, n long")
    grouped = cells.groupBy("key").agg(
        *[F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in range(4)]
    )
    supported = grouped.where(F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3") >= SUPPORT)
    # At most rows * words / SUPPORT keys: the sample's bound is the model's.
    table = supported.toArrow()
    keys = table["key"].to_pylist()
    n = np.column_stack([table[f"n{c}"].to_numpy() for c in range(4)]) if keys else np.zeros((0, 4))
    size = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")).cast("bigint")
    totals = sample.groupBy("half", "toxic").agg(F.count("*").alias("d"), F.sum(size).alias("t"))
    docs, tokens = np.zeros(4, int), np.zeros(4, int)
    for r in totals.collect():
        docs[2 * r.half + r.toxic], tokens[2 * r.half + r.toxic] = r.d, r.t or 0

    def fit(halves: tuple[int, ...]) -> tuple[dict[str, float], float]:
        clean, toxic = [2 * h for h in halves], [2 * h + 1 for h in halves]
        pairs = np.column_stack([n[:, clean].sum(1), n[:, toxic].sum(1)]).tolist()
        counts = dict(zip(keys, pairs, strict=True))
        scores = _scores(counts, (int(docs[clean].sum()), int(docs[toxic].sum())))
        return scores, _scale(scores, counts, int(tokens[clean].sum()))

    whole, scale = fit((0, 1))
    parts = broadcast(spark.sparkContext, [fit((1,)), fit((0,))])  # of the other half

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judges = [(_Scorer(scores), lam) for scores, lam in parts.value]
        for batch in batches:
            out = []
            for text, toxic, half in zip(*batch.to_pydict().values(), strict=True):
                scorer, lam = judges[half]
                found = _judge(text, scorer, lam, 1e-12)
                scored = [lam * s for _, _, s, _ in found[2]]
                out.append((toxic, found[0], scored))
            columns = list(zip(*out)) if out else [(), (), ()]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.record_batch(arrays, names=["toxic", "n_tokens", "heights"])

    judged = (
        sample.select("text", "toxic", "half")
        .mapInArrow(cross, "toxic int, n_tokens bigint, heights array<double>")
        .toArrow()  # a row of numbers for each of at most ``rows`` documents
    )
    toxic = judged["toxic"].to_numpy().astype(float)
    length = np.maximum(judged["n_tokens"].to_numpy(), 1)
    heights = judged["heights"].to_pylist()
    # Segments of clean documents follow K n exp(-height): K from those of at least 1.
    high = sum(h >= 1 for h, y in zip(heights, toxic) if not y for h in h)
    density = max((high + 0.5) * math.e / max(length[toxic == 0].sum(), 1), 1e-9)
    chance = np.log(density * length)
    evidence = np.array(
        [sum(max(0.0, h - c) for h in hs) for hs, c in zip(heights, chance, strict=True)]
    )
    return Model(whole, scale, density, _calibrate(evidence, toxic))


def find(documents: DataFrame, model: Model) -> DataFrame:
    """The columns of ``documents`` and those of ``FOUND``: every significant passage, by the
    numbers of its first and last word, with score and expectation."""
    sent = broadcast(documents.sparkSession.sparkContext, model)
    kinds = [
        pa.int64(),
        pa.float64(),
        pa.list_(
            pa.struct(
                [
                    ("first", pa.int32()),
                    ("last", pa.int32()),
                    ("score", pa.float64()),
                    ("e_value", pa.float64()),
                ]
            )
        ),
    ]
    names = ["n_tokens", "evidence", "passages"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        scorer = _Scorer(m.scores)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = part.column("text").to_pylist()
                out = [_judge(t, scorer, m.scale, m.density) for t in texts]
                columns = list(zip(*out))
                columns[2] = [
                    [dict(zip(("first", "last", "score", "e_value"), p)) for p in ps]
                    for ps in columns[2]
                ]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *arrays], names=[*part.schema.names, *names]
                )

    clear = documents.drop(*names)
    schema = ", ".join(f"`{n}` {t}" for n, t in clear.dtypes)
    return clear.mapInArrow(judge, f"{schema}, {FOUND}")


def score(found: DataFrame, model: Model) -> DataFrame:
    """``find``'s rows with score (probability of being toxic) and predicted."""
    start, slope = model.curve
    p = 1 / (1 + F.exp(-(F.lit(start) + F.lit(slope) * F.sqrt("evidence"))))
    with_score = found.withColumn("score", p)
    return with_score.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(documents, labels)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    held = F.coalesce(id_remainder("doc_id", FOLDS) == 0, F.lit(False)).alias("held_out")
    return score(find(texts, model), model).select("doc_id", held, "score", "predicted")


def reject(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not judged toxic, with all their columns."""
    model = train(documents, labels)
    own = documents.columns
    clash = {"n_tokens", "evidence", "passages", "score", "predicted"}
    safe = {c: f"_doc_{c}" for c in own if c in clash}
    judged = score(find(documents.withColumnsRenamed(safe), model), model)
    kept = judged.where("predicted = 0")
    return kept.select(*[F.col(safe.get(c, c)).alias(c) for c in own])
