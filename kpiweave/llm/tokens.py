"""Words of whole Arrow batches as numpy arrays, without a Python object per word.

A batch's texts lie one after the other in one byte buffer. Word borders, word hashes and
hashes of runs of words are computed over pieces of that buffer, so memory follows the
size of a piece and the number of words, not Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes hashed at a time
U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))  # fixed: hashes agree in all tasks
_LETTER = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_UP: np.ndarray = _powers(_BASE, 1)
_DOWN: np.ndarray = _powers(_INVERSE, 1)


def _grow(n: int) -> None:
    global _UP, _DOWN
    if len(_UP) < n:
        _UP, _DOWN = _powers(_BASE, n), _powers(_INVERSE, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    for first, last in spans:
        mask[first : last + 1] = True
    return mask


_SAME = np.arange(256, dtype=np.uint8)
LOWER = _SAME.copy()
LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass(frozen=True)
class Rule:
    """Which bytes part words, and how bytes are folded before. Parting bytes are ASCII, so a
    word never cuts a UTF-8 character."""

    parting: np.ndarray
    fold: np.ndarray


BLANKS = _bytes((0x20, 0x20), (0x09, 0x0D))
#: words ``[^\x20\x09-\x0D]+``, unchanged or with A-Z lower-cased
PLAIN = Rule(BLANKS, _SAME)
PLAIN_LOWER = Rule(BLANKS, LOWER)
#: A-Z lower-cased, words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
ALNUM_LOWER = Rule(_bytes((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)), LOWER)


@dataclass
class Words:
    """Words of several texts: ``first[i] : first[i + 1]`` are the words of text i, each at
    ``data[start:end]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def join(self, low: int, high: int) -> bytes:
        """Words low..high-1, joined by one space."""
        data, s, e = self.data, self.start, self.end
        return b" ".join([data[s[i] : e[i]].tobytes() for i in range(low, high)])


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offsets, dtype=kind) if offsets else np.zeros(1, kind)
    offs = offs[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if len(offs) == 0:
        offs = np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def words(texts: pa.Array, rule: Rule) -> Words:
    raw, offsets = _buffer(texts)
    data = rule.fold[raw] if len(raw) else raw
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(rule.parting[data], out=inside[1:-1])
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    opens[borders] = inside[1:-1][borders]
    closes[borders - 1] = inside[1:-1][borders - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, start, end, first, _hashes(data, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial over random letter codes, from running sums, then mixed."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = int(np.searchsorted(end, start[i] + PIECE, side="right"))
        j = max(j, i + 1)
        low, high = int(start[i]), int(end[j - 1])
        _grow(high - low + 1)
        sums = np.empty(high - low + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_LETTER[data[low:high]] * _DOWN[: high - low], out=sums[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * _UP[s] + (e - s).astype(np.uint64))
        i = j
    return out


def runs(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (word number) and hash of each run of ``size`` consecutive words of one text."""
    n = len(w.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += w.hashes[k : k + n] * _PLACE[k]
    last = np.repeat(w.first[1:], w.counts)  # end of the text of each word
    start = np.flatnonzero(np.arange(n) + size <= last[:n])
    return start, mix(total[start] + U64(size))


def runs_at(w: Words, start: np.ndarray, size: int) -> np.ndarray:
    """The hash that ``runs`` gives to the runs of ``size`` words from each of ``start`` on."""
    total = np.zeros(len(start), dtype=np.uint64)
    for k in range(size):
        total += w.hashes[start + k] * _PLACE[k]
    return mix(total + U64(size))


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes of text, so that a part's arrays stay small.
    A longer text is a part of its own."""
    texts = batch.column(column)
    _, offsets = _buffer(texts)
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = max(j, i + 1)
        yield batch.slice(i, j - i)
        i = j
