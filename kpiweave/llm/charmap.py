"""Normalisation of text buffers by a compiled character map, with the source of every byte.

The map is a double-array trie over UTF-8 bytes. At each character the longest key that matches is
replaced by its value, other characters stay. Where keys match is found for all places of a buffer
at once, one trie step for all at a time; only overlapping matches are settled one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPACE = 0x20
MARK = "▁".encode()  # stands for a space in pieces


class CharMap:
    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], dtype="<u4").astype(np.int64)
        self.values = np.frombuffer(compiled[4 + size :], dtype=np.uint8)
        self.ends = np.flatnonzero(self.values == 0)  # each value ends with a zero byte

    def _offset(self, unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def matches(self, data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and value of the longest key at each character that has one. ``end``:
        for each byte, the end of its text."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        origin = at
        node = np.broadcast_to(self._offset(self.units[:1]), at.shape)
        length = np.zeros(len(data), np.int64)
        value = np.zeros(len(data), np.int64)
        depth = 0
        while len(at):
            there = at < end[origin]
            at, origin, node = at[there], origin[there], node[there]
            step = data[at].astype(np.int64)
            node = node ^ step
            unit = self.units[node]
            on = (unit & 0x800000FF) == step
            at, origin, node, unit = at[on] + 1, origin[on], node[on], unit[on]
            node = node ^ self._offset(unit)
            depth += 1
            leaf = (unit >> 8) & 1 == 1
            length[origin[leaf]] = depth
            value[origin[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
        start = np.flatnonzero(length)
        return start, length[start], value[start]


def _settled(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which matches hold when the text is read from the left."""
    if not np.any(start[1:] < start[:-1] + length[:-1]):
        return np.arange(len(start))
    kept, free = [], 0
    for i, (s, n) in enumerate(zip(start.tolist(), length.tolist())):
        if s >= free:
            kept.append(i)
            free = s + n
    return np.array(kept, np.int64)


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (count[i] numbers), for all i."""
    before = np.cumsum(count) - count
    return np.repeat(first - before, count) + np.arange(int(count.sum()))


@dataclass
class Normalised:
    """Texts i is ``data[first[i] : first[i + 1]]``; ``source`` is the source byte of each byte,
    ``last[i]`` the source byte at which text i ends."""

    data: np.ndarray
    source: np.ndarray
    first: np.ndarray
    last: np.ndarray


@dataclass(frozen=True)
class Rules:
    charmap: CharMap | None
    dummy_prefix: bool
    trim: bool  # runs of spaces become one, spaces at either end go
    escape: bool  # spaces become MARK


def normalise(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> Normalised:
    """``data[offsets[i] : offsets[i + 1]]`` are UTF-8 texts."""
    source = np.arange(len(data), dtype=np.int64)
    first, last = offsets.astype(np.int64), offsets[1:].astype(np.int64)
    fresh = (data & 0xC0) != 0x80  # starts what the map gives for one character or key
    other = fresh & (data != SPACE)  # the source of anything but a single space
    if rules.charmap is not None and len(data):
        end = np.repeat(offsets[1:], np.diff(offsets))
        start, length, value = rules.charmap.matches(data, end)
        held = _settled(start, length)
        start, length, value = start[held], length[held], value[held]
        size = rules.charmap.ends[np.searchsorted(rules.charmap.ends, value)] - value
        width = np.ones(len(data), np.int64)
        width[ragged(start, length)] = 0
        other[ragged(start, length)] = False
        other[start] = (size != 1) | (rules.charmap.values[value] != SPACE)
        width[start] = size
        source = np.repeat(np.arange(len(data)), width)
        out, fresh = data[source], fresh[source]
        upto = np.concatenate([[0], np.cumsum(width)])
        out[ragged(upto[start], size)] = rules.charmap.values[ragged(value, size)]
        fresh[ragged(upto[start] + 1, np.maximum(size - 1, 0))] = False
        data, first = out, upto[offsets]
    lead = offsets[:-1].astype(np.int64)  # where a text begins, behind its first spaces
    if rules.trim:
        stops = np.append(np.flatnonzero(other), offsets[-1])
        lead = np.minimum(stops[np.searchsorted(stops, lead)], last)
        data, source, first = _trimmed(data, source, first, fresh)
    data, source, first = _marked(data, source, first, rules.escape)
    if rules.dummy_prefix:
        heads = np.flatnonzero(lead < last)
        mark = np.frombuffer(MARK if rules.escape else b" ", dtype=np.uint8)
        at = np.repeat(first[heads], len(mark))
        data = np.insert(data, at, np.tile(mark, len(heads)))
        source = np.insert(source, at, np.repeat(lead[heads], len(mark)))
        first = first + np.concatenate([[0], np.cumsum(lead < last)]) * len(mark)
    if rules.trim and len(data):
        return _closed(data, source, first, last, MARK if rules.escape else b" ")
    return Normalised(data, source, first, last)


def _trimmed(data, source, first, fresh):
    """A space goes where it starts what a character gave and a space, or the text's start,
    stands before."""
    space = data == SPACE
    before = np.concatenate([[True], space[:-1]])[: len(space)]
    before[first[:-1][np.diff(first) > 0]] = True
    kept = ~(space & before & fresh)
    upto = np.concatenate([[0], np.cumsum(kept)])
    return data[kept], source[kept], upto[first]


def _marked(data, source, first, escape: bool):
    """Spaces become marks."""
    space = data == SPACE
    if not escape or not space.any():
        return data, source, first
    mark = np.frombuffer(MARK, dtype=np.uint8)
    width = np.where(space, len(mark), 1)
    upto = np.concatenate([[0], np.cumsum(width)])
    out = np.repeat(data, width)
    at = upto[:-1][space]
    out[ragged(at, np.full(len(at), len(mark)))] = np.tile(mark, len(at))
    return out, np.repeat(source, width), upto[first]


def _closed(data, source, first, last, mark: bytes) -> Normalised:
    """Marks at the end of a text go; its source ends where they begin."""
    marks = found(data, mark)
    loose = np.zeros(len(data), bool)
    for k in range(len(mark)):
        loose[k:] |= marks[: len(marks) - k]
    solid = np.maximum.accumulate(np.where(loose, -1, np.arange(len(data))))
    full = np.flatnonzero(np.diff(first) > 0)
    ends = np.maximum(solid[first[1:][full] - 1] + 1, first[:-1][full])
    cut = ends < first[1:][full]
    last = last.copy()
    last[full[cut]] = source[ends[cut]]
    kept = np.ones(len(data), bool)
    kept[ragged(ends, first[1:][full] - ends)] = False
    upto = np.concatenate([[0], np.cumsum(kept)])
    return Normalised(data[kept], source[kept], upto[first], last)


def found(data: np.ndarray, mark: bytes = MARK) -> np.ndarray:
    """For each byte, whether a mark begins there."""
    here = np.zeros(len(data), bool)
    n = len(data) - len(mark) + 1
    if n > 0:
        here[:n] = True
        for k, byte in enumerate(mark):
            here[:n] &= data[k : k + n] == byte
    return here
