import zlib

import numpy as np
import pytest

from kpiweave.llm import language_model as L
from kpiweave.llm import pitman_yor as P
from kpiweave.llm import previous_words as W

DOCS = "doc_id bigint, text string"


def ids(held):
    return (i for i in range(10**6) if (zlib.crc32(str(i).encode()) % 10 == 0) == held)


def corpus():
    """Words enough to fill head and contexts; ra, rb, rc, rd are rarer than all of them."""
    learn, held = ids(False), ids(True)
    filler = " ".join(f"f{i}" for i in range(4500))
    rows = [(next(learn), filler) for _ in range(6)]
    rows += [(next(learn), t) for t in ("ra rb", "rd rc") * 3]
    asked = [next(held), next(held)]
    return rows + [(asked[0], "ra rb"), (asked[1], "ra rc")], asked


@pytest.mark.parametrize("known", [L.KNOWN, 1])
def test_pairs_of_rare_words_count(spark, known):
    """Without restaurants of rare words, both texts scored the same."""
    rows, (seen, unseen) = corpus()
    score = {r.doc_id: r.score for r in L.report(spark.createDataFrame(rows, DOCS), known).collect()}
    assert score[seen] > score[unseen] + 1
    assert all(np.isfinite(s) and s < 0 for s in score.values())


def test_probabilities_after_a_word_sum_to_one(spark):
    rows, _ = corpus()
    m, left = L.train(spark.createDataFrame(rows, DOCS).select("text"))
    assert left.count() == 0
    head, rng = len(m.head), np.random.default_rng(5)
    place = np.flatnonzero(~np.isin(m.known, m.head))
    rare = (head + place).astype(np.uint64)
    by_group = W.group(m.known[place])
    log_rare = m.rare(m.counts[place], m.seats[place])
    share = m.back / (P.THETA + m.customers)  # of the words never met
    other = 10 ** m.matrix[L.CONTEXTS].astype(float)

    def changes(room, word, n=60):
        """Of every word after ``n`` that were learned, in order of ``word``."""
        some = rng.integers(0, len(word), n)
        r, w = (np.append(x, x[some]) for x in (room, word))
        learn = np.append(np.zeros(len(word), np.int64), np.ones(n, np.int64))
        by = np.lexsort((w, r))
        start, change, factor, found = W.seated(r[by], w[by], learn[by], m, L.CONTEXTS, rng)
        assert len(start) == len(word) and np.isnan(factor).all()
        back = np.empty(len(word))
        back[np.lexsort((word, room))] = change
        return back

    words = np.append(np.arange(head, dtype=np.uint64), rare)
    base = np.append(other[:head], other[head] * 10**log_rare)
    room = np.full(len(words), (L.CONTEXTS + 2) * W.GROUPS + 3000, np.uint64)
    own = 10 ** changes(room, words)
    unseen = own.min()  # what is left to the base
    assert abs((base * own).sum() + other[head] * share * unseen - 1) < 1e-4

    # After a frequent word, each group of rare words keeps its mass.
    g = np.uint64(np.argmax(np.bincount(by_group.astype(int))))
    word, q = rare[by_group == g], 10 ** log_rare[by_group == g]
    own = 10 ** changes(np.full(len(word), np.uint64(7 * W.GROUPS) + g, np.uint64), word, 1)
    assert len(word) > 1
    assert abs((q * own).sum() + share / W.GROUPS * own.min() - m.masses[int(g)]) < 1e-6


def test_packed_tokens_come_back():
    rng = np.random.default_rng(3)
    room = rng.integers(0, 1 << 20, 1000).astype(np.uint64)
    word = rng.integers(0, 1 << 20, 1000).astype(np.uint64)
    room[::7] = rng.integers(0, 1 << 62, len(room[::7])).astype(np.uint64) | W.UNKNOWN
    word[::5] = rng.integers(0, 1 << 62, len(word[::5])).astype(np.uint64) | W.UNKNOWN
    text = rng.integers(0, 1 << 20, 1000)
    for found, sent in zip(W.unpack(W.pack(room, word, text)), (room, word, text)):
        assert (found == sent).all()
