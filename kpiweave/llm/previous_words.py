"""Restaurants per previous word, below the contexts of ``language_model``.

Every previous word of the corpus has a restaurant over every word, based on the probabilities that
``language_model`` gives. A frequent previous word (or the start of a text) has its own counts for
the head there; its restaurants serve the words outside the head, one for each of ``GROUPS`` groups
of them by hash, so that no restaurant holds much of the corpus.

Tokens that belong to a restaurant are dealt to buckets of restaurants as packed arrays, a bucket of
a bounded number of tokens. The task of a bucket counts its pairs, seats them over their base and
adds up, per text, what the restaurants change of the base's log10 probabilities: with ``c``
customers at ``t`` tables, base ``q`` and ``C`` customers at ``T`` tables in all, the probability is
``q * (theta + d T) / (theta + C) * (1 + (c - d t) / ((theta + d T) q))``. For words outside the broadcast
model ``q`` is known up to a factor that the caller meets in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kpiweave.llm import pitman_yor as py
from kpiweave.llm import tokens

GROUPS = 256
SENT = 1_000_000  # tokens that a task gathers before it deals them to buckets
BUCKET = 2_000_000  # tokens of the corpus per bucket, restaurants or not
TEXT_BITS = np.int64(20)  # of a slot: the text's number within what a task dealt at a time
UNKNOWN = np.uint64(1 << 63)  # the code of a word outside the broadcast model: its hash with this bit
_OTHER = np.uint32(0xFFFFFFFF)
SEED = 29

ANSWERS = "slot bigint, sums binary, h bigint, factor double"


def group(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(8)) & np.uint64(GROUPS - 1)


def rooms(code: np.ndarray, hashes: np.ndarray, first: np.ndarray, head: int, contexts: int):
    """The restaurant of each token, and whether it has one. ``code``: rank in the head, else
    ``head`` + place among the known words, else the hash with ``UNKNOWN``; ``first``: no word of
    the same text is before it."""
    before = np.empty(len(code), np.uint64)
    before[1:] = code[:-1]
    before[first] = contexts + 1
    often = first | (before < min(contexts, head))
    room = np.where(often, before * np.uint64(GROUPS) + group(hashes), before)
    single = ~often & (before < UNKNOWN)
    room[single] += np.uint64((contexts + 2) * GROUPS)
    return room, ~often | (code >= head)


def bucket_of(room: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens.mix(room) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.uint32)


def _planes(x: np.ndarray) -> bytes:
    """First bytes first, then second ones: high bytes are mostly zero and compress well."""
    return x.view(np.uint8).reshape(-1, 4).T.tobytes()


def _narrow(x: np.ndarray) -> tuple[bytes, np.ndarray]:
    wide = x >= UNKNOWN
    return _planes(np.where(wide, _OTHER, x).astype(np.uint32)), x[wide]


def pack(room: np.ndarray, word: np.ndarray, text: np.ndarray) -> bytes:
    r, more_r = _narrow(room)
    w, more_w = _narrow(word)
    head = np.array([len(room), len(more_r), len(more_w)], np.int64).tobytes()
    return head + r + w + _planes(text.astype(np.uint32)) + more_r.tobytes() + more_w.tobytes()


def unpack(data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, more_r, more_w = np.frombuffer(data, np.int64, 3)
    raw = np.frombuffer(data, np.uint8, 12 * n, 24).reshape(3, 4, n).transpose(0, 2, 1)
    flat = np.ascontiguousarray(raw).view(np.uint32).reshape(3, n)
    rest = np.frombuffer(data, np.uint64, more_r + more_w, 24 + 12 * n)
    out = []
    for x, more in ((flat[0], rest[:more_r]), (flat[1], rest[more_r:])):
        wide = x == _OTHER
        x = x.astype(np.uint64)
        x[wide] = more
        out.append(x)
    return out[0], out[1], flat[2]


class Dealer:
    """Gathers the tokens of a task's texts and deals them to buckets."""

    def __init__(self, buckets: int, task: int):
        self.buckets, self.next = buckets, task << 20
        self.clear()

    def clear(self) -> None:
        self.held, self.size, self.texts = [], 0, 0

    @property
    def base(self) -> int:
        return self.next << int(TEXT_BITS)

    def add(self, room, word, text, learn: np.ndarray) -> np.ndarray:
        """Takes tokens of texts 0, 1, ... and returns the texts' slots."""
        slots = self.base + self.texts + np.arange(len(learn))
        self.held.append((room, word, (text + self.texts) * 2 + learn[text]))
        self.size, self.texts = self.size + len(room), self.texts + len(learn)
        return slots

    def full(self) -> bool:
        return self.size >= SENT or self.texts >= 1 << 19

    def dealt(self) -> Iterator[tuple[int, int, bytes]]:
        """Slot of the first text, bucket and packed tokens."""
        if self.size:
            room, word, text = (np.concatenate(x) for x in zip(*self.held))
            bucket = bucket_of(room, self.buckets)
            order = np.argsort(bucket, kind="stable")
            room, word, text, bucket = room[order], word[order], text[order], bucket[order]
            at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            for i, j in zip(at, np.append(at[1:], len(bucket))):
                yield self.base, int(bucket[i]), pack(room[i:j], word[i:j], text[i:j])
        self.next += 1
        self.clear()


def seated(room, word, learn, m, contexts: int, rng):
    """For sorted tokens: where their pairs start; per pair its change of the log10 probability
    (without the part that needs ``q``, if ``q`` is not all known) and the factor of ``1 / q`` in it,
    NaN if all is known."""
    head = np.uint64(len(m.head))
    start = np.flatnonzero(np.append(True, (room[1:] != room[:-1]) | (word[1:] != word[:-1])))
    c = np.add.reduceat(learn, start, dtype=np.int64)
    r, w = room[start], word[start]
    begins = np.append(True, r[1:] != r[:-1])
    at, of = np.flatnonzero(begins), np.cumsum(begins) - 1
    often = r < np.uint64((contexts + 2) * GROUPS)
    in_head, known = w < head, w < UNKNOWN
    rare = known & ~in_head
    # The base of each pair: all of it, or all but the probability of a word outside the model.
    other = min(contexts, len(m.head))
    q = np.where(often, 1.0, 10.0 ** m.matrix[other].astype(float)[np.minimum(w, head).astype(np.int64)])
    place = (w[rare] - head).astype(np.int64)
    own = np.full(len(w), m.back / (py.THETA + m.customers) if m.customers else 0.0)
    own[in_head] = 1.0
    own[rare] = 10.0 ** m.rare(m.counts[place], m.seats[place])
    h = np.where(known, np.uint64(0), w)
    h[rare] = m.known[place]
    mass = np.where(often, m.masses[group(h).astype(np.int64)], 1.0)
    several = np.flatnonzero(c > 1)
    d = py.discount(int((c == 1).sum()), int((c == 2).sum()))
    tables = np.add.reduceat((c > 0).astype(np.int64), at)
    t = (c > 0).astype(np.int64)  # one customer sits at one table
    base = np.minimum(q[several] * own[several] / mass[several], 1.0)
    t[several] = py.seat(c[several], base, tables[of[several]] - 1, d, rng)
    tables, customers = np.add.reduceat(t, at), np.add.reduceat(c, at)
    open_ = py.THETA + d * tables
    change = np.log10(open_ / (py.THETA + customers))[of]
    factor = np.where(c > 0, (c - d * t) * mass / (open_[of] * q), 0.0)
    change = change + np.log1p(np.where(known, factor / np.where(known, own, 1.0), 0.0)) / np.log(10)
    return start, change, np.where(known | (c == 0), np.nan, factor), w


def gathered(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Restaurant, word, slot and whether it is learned from, of all tokens of a bucket."""
    data = [x.as_buffer() for x in rows["tokens"]]
    ends = np.cumsum([0] + [int(np.frombuffer(x, np.int64, 1)[0]) for x in data])
    room, word = np.empty(ends[-1], np.uint64), np.empty(ends[-1], np.uint64)
    slot, learn = np.empty(ends[-1], np.int64), np.empty(ends[-1], np.uint8)
    for x, base, i, j in zip(data, rows["slot"].to_numpy(), ends, ends[1:]):
        room[i:j], word[i:j], text = unpack(x)
        slot[i:j], learn[i:j] = base + (text >> 1), text & 1
    return room, word, slot, learn


def _ranked(x: np.ndarray) -> np.ndarray:
    """The same order in 32 bits: codes of known words as they are, hashes by rank behind them."""
    wide = np.flatnonzero(x >= UNKNOWN)
    out = x.copy()
    out[wide] = np.unique(x[wide], return_inverse=True)[1].astype(np.uint64) + np.uint64(1 << 31)
    return out


def answer(sent, contexts: int):
    def answers(key, rows):
        m = sent.value
        room, word, slot, learn = gathered(rows)
        # Equal pairs may come in any order: counts and seats do not depend on it.
        order = np.argsort((_ranked(room) << np.uint64(32)) | _ranked(word))
        room, word = room[order], word[order]
        slot, learn = slot[order], learn[order]
        del order  # a bucket's arrays are what a worker's memory goes to
        rng = np.random.default_rng([SEED, key[0].as_py()])
        start, change, factor, w = seated(room, word, learn, m, contexts, rng)
        times = np.diff(np.append(start, len(room)))
        del room, word, learn, start
        back = np.argsort(slot)
        slots = slot[back]
        first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
        slots = slots[first]
        sums = np.add.reduceat(np.repeat(change, times)[back], first)
        del back
        dealt = slots >> TEXT_BITS
        at = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1]))
        blobs = []
        for i, j in zip(at, np.append(at[1:], len(dealt))):
            text_no = (slots[i:j] - (dealt[i] << TEXT_BITS)).astype(np.uint32)
            blobs.append(np.int64(j - i).tobytes() + _planes(text_no) + sums[i:j].tobytes())
        lost = np.flatnonzero(~np.isnan(np.repeat(factor, times)))
        n, k = len(at), len(lost)
        return pa.table(
            {
                "slot": np.concatenate([dealt[at] << TEXT_BITS, slot[lost]]),
                "sums": pa.array(blobs + [None] * k, pa.binary()),
                "h": pa.array([None] * n + np.repeat(w, times)[lost].view(np.int64).tolist(), pa.int64()),
                "factor": pa.array([None] * n + np.repeat(factor, times)[lost].tolist(), pa.float64()),
            }
        )

    return answers


def added(rows: pa.Table) -> pa.Table:
    """slot, score of the texts that a task dealt at a time, from the sums of all buckets."""
    base = rows["slot"][0].as_py()
    text, sums = [], []
    for x in rows["sums"]:
        data = x.as_py()
        n = int(np.frombuffer(data, np.int64, 1)[0])
        raw = np.frombuffer(data, np.uint8, 4 * n, 8).reshape(4, n).T
        text.append(np.ascontiguousarray(raw).view(np.uint32).ravel().astype(np.int64))
        sums.append(np.frombuffer(data[8 + 4 * n :], np.float64))
    total = np.bincount(np.concatenate(text), np.concatenate(sums))
    return pa.table({"slot": base + np.arange(len(total)), "score": total})
