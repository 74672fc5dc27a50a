import hashlib
import random

import pytest

from kpiweave.llm import substrings as S

DOCS = "doc_id bigint, text string, start string, n int"


def brute(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first: dict = {}
    for i, w in split:
        for s in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for s in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[s : s + window])] < i:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [50, 12, 5])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(400)] + ["ä", "|"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages = [words(n) for n in (window - 1, window, window + 7, 3 * window)]
    rows = []
    for i in range(120):
        text = words(rng.randrange(0, 90))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = rng.randrange(4)
            at = rng.randrange(len(text) + 1)
            text[at:at] = p[cut:]
        rows.append((i * 2, (" " if i % 2 else "\n\t").join(text)))
    same = " ".join(["again"] * 400)
    rows += [(501, same), (502, same + " end"), (503, "x " + same[: 6 * 130]), (504, same)]
    rows += [(601, None), (602, ""), (None, rows[5][1]), (604, rows[5][1]), rows[8], rows[8]]
    rows += [(8, rows[9][1]), (700, " ".join(words(20000)))]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    got = sorted(map(tuple, S.report(docs, window).collect()), key=repr)
    assert got == brute(rows, window)


def test_empty_table(spark):
    assert S.report(spark.createDataFrame([], DOCS)).count() == 0
