"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector, less the centroid and scaled to length 1, is rotated at random; the signs of its
coordinates, packed into words, are its code. Two scalars go with the code: the length, and the
inner product of the vector with its code. A query's rotated coordinates are rounded to ``PLANES``
bits and kept as bit planes; the inner product of code and query is then a sum of counted bits of
``code & plane``, never unpacked. With the scalars this gives an estimate of the inner product of
the vectors and a bound on its error (``BOUND`` standard deviations, and all of the rounding).
The vectors are measured exactly, in double precision, from the least lower bound of their distance
on, until that bound is above the query's k-th distance so far; the others are passed over.

Vectors are dealt once, in chunks of codes, scalars and originals; the queries, in blocks, are
sent to every group of chunks. A task keeps k neighbours per query and returns those alone.

Only the centroid is fitted on a sample (``SAMPLE`` vectors in hash order); every vector is indexed.

Defined results: ids that are null and vectors that are null, zero, empty or hold null or
non-finite components take no part; vectors meet those of their own length only; an id that
repeats names one vector, the smallest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kpiweave.llm.common import stored

BOUND = 1.9
CHUNK = 1024
GROUP = 4  # chunks
BLOCK = 1024  # queries
SAMPLE = 10_000
SEED = 11
K = 10
PLANES = 8
STEP = 16  # vectors measured at a time


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double): the vectors that take part, one per id."""
    v = F.col("embedding").cast("array<double>")
    inf = F.lit(float("inf"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    some = F.exists("v", lambda x: x != 0)
    named = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    kept = named.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good & some)
    return kept.groupBy("vec_id").agg(F.min("v").alias("v"))


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    rng = np.random.Generator(np.random.PCG64([SEED, dim]))
    q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(vectors: DataFrame, rows: int = SAMPLE) -> dict[int, np.ndarray]:
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows)
    by: dict[int, list] = {}
    for v in sample.toArrow()["v"].to_pylist():
        by.setdefault(len(v), []).append(v)
    return {dim: np.mean(np.array(vs), axis=0) for dim, vs in by.items()}


def _turned(v: np.ndarray, centroids: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and rotated unit vectors of ``v`` less the centroid."""
    dim = v.shape[1]
    rest = v - centroids.get(dim, np.zeros(dim))
    length = np.sqrt((rest * rest).sum(axis=1))
    unit = rest / np.where(length > 0, length, 1.0)[:, None]
    return length, unit @ rotation(dim)


def _packer(limit: int, pack):
    """Gathers vectors of one length and yields ``pack(dim, ids, vectors)`` for ``limit`` each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                ids, vs = held.setdefault(len(v), ([], []))
                ids.append(i)
                vs.append(v)
                if len(ids) == limit:
                    yield pack(len(v), np.array(ids), np.array(vs))
                    del held[len(v)]
        for dim, (ids, vs) in held.items():
            yield pack(dim, np.array(ids), np.array(vs))

    return rows


def _row(**values) -> pa.RecordBatch:
    return pa.record_batch(
        {
            k: pa.array([x.tobytes()], pa.binary()) if isinstance(x, np.ndarray) else pa.array([x], pa.int32() if k == "dim" else pa.int64())
            for k, x in values.items()
        }
    )


CODES = "dim int, chunk bigint, ids binary, lengths binary, inner binary, codes binary, vectors binary"
QUERIES = (
    "dim int, block bigint, q_ids binary, q_lengths binary, q_low binary, q_step binary,"
    " q_planes binary, q_vectors binary"
)
WORD = 64


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, the last one filled up with zeros."""
    octets = np.packbits(bits, axis=1)
    words = -(-bits.shape[1] // WORD)
    out = np.zeros((len(bits), words * 8), np.uint8)
    out[:, : octets.shape[1]] = octets
    return out.view(np.uint64)


def planes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value, step and bit planes of rows rounded to ``PLANES`` bits."""
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / (2**PLANES - 1)
    whole = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1.0)[:, None]).astype(np.int64)
    return low, step, np.stack([packed((whole >> j) & 1 == 1) for j in range(PLANES)], axis=1)


def code_products(codes: np.ndarray, dim: int, low: float, step: float, bits: np.ndarray) -> np.ndarray:
    """Inner products of the codes, as vectors of length 1, with one rounded query."""
    counted = np.zeros(len(codes), np.int64)
    total = 0
    for j, plane in enumerate(bits):
        counted += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j
        total += int(np.bitwise_count(plane).sum()) << j
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    positive = low * ones + step * counted  # the query's coordinates where the code has a one
    return (2 * positive - (low * dim + step * total)) / np.sqrt(dim)


def encode(vectors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """The index: rows of ``CODES``, up to ``CHUNK`` vectors each."""

    def pack(dim: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        length, turned = _turned(v, centres)
        inner = np.abs(turned).sum(axis=1) / np.sqrt(dim)
        codes = packed(turned > 0)
        return _row(dim=dim, chunk=int(ids[0]), ids=ids, lengths=length, inner=inner, codes=codes, vectors=v)

    return vectors.mapInArrow(_packer(CHUNK, pack), CODES)


def encode_queries(queries: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    def pack(dim: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        length, turned = _turned(v, centres)
        low, step, bits = planes(turned)
        return _row(
            dim=dim, block=int(ids[0]), q_ids=ids, q_lengths=length, q_low=low, q_step=step,
            q_planes=bits, q_vectors=v,
        )

    return queries.mapInArrow(_packer(BLOCK, pack), QUERIES)


class _Nearest:
    """The k nearest of each query so far, by (distance, id)."""

    def __init__(self, k: int) -> None:
        self.k, self.found = k, {}

    def limits(self, queries: list[int]) -> np.ndarray:
        have = [self.found.get(q) for q in queries]
        return np.array([np.inf if h is None or len(h[0]) < self.k else h[0][-1] for h in have])

    def add(self, query: int, distance: np.ndarray, ids: np.ndarray) -> None:
        before = self.found.get(query)
        if before is not None:
            distance = np.concatenate([before[0], distance])
            ids = np.concatenate([before[1], ids])
        best = np.lexsort((ids, distance))[: self.k]
        self.found[query] = (distance[best], ids[best])


def _search(k: int, bound: float, tally=None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(k)
        for batch in batches:
            for row in range(batch.num_rows):

                def part(name: str, kind=np.float64, row=row, batch=batch) -> np.ndarray:
                    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)

                dim = batch.column("dim")[row].as_py()
                ids, q_ids = part("ids", np.int64), part("q_ids", np.int64)
                chunk = _Chunk(
                    dim, ids, part("lengths"), part("inner"),
                    part("codes", np.uint64).reshape(len(ids), -1), part("vectors").reshape(-1, dim),
                    bound,
                )
                q_planes = part("q_planes", np.uint64).reshape(len(q_ids), PLANES, -1)
                q_vectors = part("q_vectors").reshape(-1, dim)
                scalars = zip(part("q_lengths"), part("q_low"), part("q_step"))
                measured = 0
                for j, (query, of) in enumerate(zip(q_ids.tolist(), scalars)):
                    low = chunk.bounds(*of, q_planes[j])
                    measured += _rerank(nearest, query, q_vectors[j], chunk, low)
                if tally is not None:
                    tally.add(np.array([len(ids) * len(q_ids), measured]))
        out = [(q, i, d) for q, (ds, ids) in nearest.found.items() for d, i in zip(ds, ids)]
        columns = zip(*out) if out else [()] * 3
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.record_batch(arrays, names=["query_id", "vec_id", "score"])

    return rows


class _Chunk:
    """Codes, scalars and originals of some vectors."""

    def __init__(self, dim, ids, lengths, inner, codes, vectors, bound):
        self.dim, self.ids, self.lengths = dim, ids, lengths
        self.codes, self.vectors = codes, vectors
        self.inner = np.where(inner > 0, inner, 1.0)
        spread = np.sqrt(np.maximum(1 - self.inner**2, 0)) / self.inner
        self.error = spread * bound / np.sqrt(max(dim - 1, 1))

    def bounds(self, length: float, low: float, step: float, bits: np.ndarray) -> np.ndarray:
        """A lower bound of each squared distance to a query, from its bit planes."""
        estimate = code_products(self.codes, self.dim, low, step, bits) / self.inner
        rounding = step / 2 * np.sqrt(self.dim) / self.inner
        square = self.lengths**2 + length**2
        most = estimate + self.error + rounding
        return square - 2 * self.lengths * length * most - 1e-9 * (square + 1e-12)


def _rerank(nearest: _Nearest, query: int, vector: np.ndarray, chunk: _Chunk, low: np.ndarray) -> int:
    """Measures the vectors of a chunk from the least bound on, while they may be among the
    nearest; returns how many that were."""
    limit = nearest.limits([query])[0]
    may = np.flatnonzero((low <= limit * limit) & (chunk.ids != query))
    may = may[np.argsort(low[may], kind="stable")]
    done = 0
    while done < len(may) and low[may[done]] <= limit * limit:
        part = may[done : done + STEP]
        _measure(nearest, query, part, chunk.ids, chunk.vectors, vector)
        limit = nearest.limits([query])[0]
        done += len(part)
    return done


def _measure(nearest, query, which, ids, vectors, vector) -> None:
    if len(which):
        apart = vectors[which] - vector
        nearest.add(query, np.sqrt((apart * apart).sum(axis=1)), ids[which])


class Tally(AccumulatorParam):
    """Numbers of pairs that were estimated and that were measured, for ``search``."""

    def zero(self, value):
        return np.zeros(2, np.int64)

    def addInPlace(self, a, b):
        return a + b


def search(vectors: DataFrame, is_query, k: int = K, bound: float = BOUND, tally=None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vector that ``is_query`` (a
    condition on vec_id) takes, among all others. ``vectors``: vec_id, embedding. ``tally``: an
    accumulator of ``Tally`` that counts the work."""
    own = stored(usable(vectors), "vectors")
    centres = centroids(own)
    chunks = stored(encode(own, centres), "codes")
    blocks = stored(encode_queries(own.where(is_query), centres), "queries")
    groups = max(1, -(-chunks.count() // GROUP))
    dealt = chunks.withColumn("g", F.pmod(F.xxhash64("chunk", "dim"), F.lit(groups).cast("bigint")))
    sent = blocks.withColumn("g", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    # Spark knows the size of the blocks but not that each is sent to every group: left alone, it
    # would collect all these copies in the driver to broadcast them.
    found = dealt.join(sent.hint("merge"), ["g", "dim"]).mapInArrow(
        _search(k, bound, tally), "query_id bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("vec_id") % 100 == 0)
