"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are found in whole texts: runs of ``LEAST`` or more characters that keys are made of, and,
whatever their length and characters, values that are assigned, quoted, sent as a credential in a
header or a URL, or told after a word like "password". Candidates may overlap. Each gets numbers that
describe its length, its character transitions (mean likelihood under a table of letter pairs,
changes of character class, entropy, shares of digits, symbols and hexadecimal digits), how much of
it dictionary words cover, its path, its place and the words next to it. A random forest (Spark ML),
trained on labelled findings, gives the probability of a secret.

Labelled findings are a table of the same columns with ``label``. Where none are at hand,
``weak_labels`` marks secrets by several independent forms (prefixes of known keys, quoted and
unquoted assignments to telling names, headers, URLs) and others by signs that speak against
one (dictionary words, plain numbers and names in no telling place). What neither rule decides
stays unlabelled.

The profile (dictionary and letter pairs) comes from all documents; labelled findings are a sample of
at most ``TRAIN_ROWS`` of each kind; every text is scanned whole. A word of the dictionary is in
``LEAST_DOCS`` documents and in one of ``DOC_SHARE`` at least. So the broadcast dictionary has at most
``DOC_SHARE`` times as many words as a document has different ones on average, at any corpus size.

Defined results: null and empty texts have no candidates; a null path counts as an empty one;
without labelled findings of both kinds every candidate gets the share of secrets among the
labelled ones; rows with equal id and text are scanned each; overlapping secrets are masked as one.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.common import broadcast, stored, text_key

LEAST = 16
TRAIN_ROWS = 20_000
LEAST_DOCS = 3  # that hold a word of the dictionary
DOC_SHARE = 50_000  # one document in so many at least holds it
TREES, DEPTH, SEED = 40, 8, 7
MASK = "[SECRET]"
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_\-]{{{LEAST},}}={{0,2}}")
_NAME = r"token|secret|passw(?:or)?d|passphrase|pwd|credentials?|(?:api|access|private)[ _-]?key"
#: the group "v" of each is a value in the place of a credential or of any other value
_PLACES = [
    re.compile(r)
    for r in (
        r"[\w\]][\"'`]?[ \t]*(?:=>|:=|==?|:)[ \t]*([\"'`])(?P<v>[^\n]+?)(?<!\\)\1",
        r"[?&;][\w.\-]+=(?P<v>[^\s&#\"'`<>]+)",
        r"(?<![?&;\w.\-])[\w.\-]+[\"'`]?(?:[ \t]*(?:=>|:=|==?)[ \t]*|:[ \t]+|:(?!//))(?P<v>[^\s\"'`=>:][^\s\"'`]*)",
        r"(?<!\w)([\"'`])(?P<v>[^\s\"'`]+)\1(?!\w)",
        r"://[^\s/:@]*:(?P<v>[^\s/]+)@",
        r"(?<![\w/:])[\w.+\-]+:(?P<v>[^\s/][^\s]*)@[\w.\-]+",
        r"(?i)\b(?:bearer|basic)[ \t]+(?P<v>[^\s\"'`,;]+)",
        rf"(?i)\b(?:{_NAME})s?(?:[ \t]+(?:is|was))?[ \t]+(?P<v>[^\s\"'`=:][^\s\"'`]*)",
    )
]
#: for each place, groups of strings of which a text (in lower case) holds one each, or no such value
_SIGNS = [
    ("=:", "\"'`"), ("=",), ("=:",), ("\"'`",), (["://"], "@"), (":", "@"), (["bearer", "basic"],),
    (["token", "secret", "passw", "passphrase", "pwd", "credential", "key"],),
]
_KNOWN_KEY = (
    r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w\-]{20,}"
    r"|(sk|rk)_(live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[\w\-]{10,}|AIza[\w\-]{35}|npm_[A-Za-z0-9]{36}"
    r"|SG\.[\w\-]{16,}\.[\w\-]{16,}|eyJ[\w\-]{8,}\.eyJ[\w\-]{8,}\.[\w\-]*)$"
)
_WORD = re.compile(r"[^\W\d_]+")
_TELLING = re.compile(
    r"token|secret|passw|pwd|api|key|auth|bearer|credential|private|signature", re.IGNORECASE
)
_TEST_PATH = re.compile(r"test|example|sample|doc|mock|fixture|demo", re.IGNORECASE)
FEATURES = (
    "length transitions least_transition changes entropy digits hexadecimal upper covered"
    " path_depth path_is_test telling_before telling_after assigned quoted words_around symbols blanks"
    " classes in_url header"
).split()
FINDING = "start int, size int, candidate string, features array<double>"


class Profile:
    """Dictionary words and log-likelihoods of letter pairs."""

    def __init__(self, words: frozenset[str], pairs: np.ndarray) -> None:
        self.words = words
        self.sizes = sorted({len(w) for w in words}, reverse=True)
        self.pairs = np.log(pairs / pairs.sum(axis=1, keepdims=True))

    def covered(self, text: str) -> float:
        """Share of the characters in dictionary words, longest first from the left."""
        i = hit = 0
        while i < len(text):
            for n in self.sizes:
                if n <= len(text) - i and text[i : i + n] in self.words:
                    hit += n
                    i += n
                    break
            else:
                i += 1
        return hit / len(text)


_CODE = np.full(128, 37, np.int8)
_CODE[ord("a") : ord("z") + 1] = np.arange(26)
_CODE[ord("0") : ord("9") + 1] = np.arange(26, 36)
_CODE[[ord(c) for c in "-_/+"]] = 36


def _codes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _CODE[np.minimum(raw, 127)]


def _features(text: str, low: int, high: int, path: str, profile: Profile) -> list[float]:
    value = text[low:high]
    lower, n = value.lower(), high - low
    codes = _codes(lower)
    steps = profile.pairs[codes[:-1], codes[1:]] if n > 1 else np.zeros(1)
    windows = np.convolve(steps, np.ones(8) / 8, "valid") if len(steps) >= 8 else steps
    kind = np.digitize(codes, [26, 36])
    shares = np.array(list(Counter(value).values())) / n
    before, after = text[max(0, low - 60) : low], text[high : high + 40]
    near = re.split(r"\s+", before.strip())[-4:]
    next_ = re.split(r"\s+", after.strip())[:3]
    joined = before.rstrip().rstrip("\"'`")
    return [
        float(n),
        float(steps.mean()),
        float(windows.min()),
        float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0,
        float(-(shares * np.log2(shares)).sum()),
        sum(c.isdigit() for c in value) / n,
        sum(c in "0123456789abcdef" for c in lower) / n,
        sum(c.isupper() for c in value) / n,
        profile.covered(lower),
        float(path.count("/")),
        float(bool(_TEST_PATH.search(path))),
        float(any(_TELLING.search(w) for w in near)),
        float(any(_TELLING.search(w) for w in next_)),
        float(joined.rstrip()[-1:] in ("=", ":")),
        float(before[-1:] in ("\"", "'", "`") and after[:1] == before[-1:]),
        float(np.mean([profile.covered(w.lower()) for w in [*near, *next_] if w] or [0.0])),
        sum(not c.isalnum() for c in value) / n,
        sum(c.isspace() for c in value) / n,
        float(sum(any(map(t, value)) for t in (str.islower, str.isupper, str.isdigit, _symbol))),
        float(after[:1] == "@" and before[-1:] == ":"),
        float(bool(re.search(r"(?i)\b(?:bearer|basic)\s+$", before))),
    ]


def _symbol(c: str) -> bool:
    return not c.isalnum()


def _spans(text: str) -> list[tuple[int, int]]:
    """Start and end of the candidates of a text, in order."""
    found = {m.span() for m in _CANDIDATE.finditer(text)}
    lower = text.lower()
    for place, signs in zip(_PLACES, _SIGNS, strict=True):
        if not all(any(sign in lower for sign in group) for group in signs):
            continue
        for m in place.finditer(text):
            low, high = m.span("v")
            if place is not _PLACES[0]:
                # Closing punctuation of a sentence or a bracket; "!" and the like may belong to it.
                high = low + len(text[low:high].rstrip(".,;:)]}>")) or high
            if low < high:
                found.add((low, high))
    return sorted(found)


def candidates(documents: DataFrame, profile: Profile, path: str = "source") -> DataFrame:
    """doc_id, row_key and the columns of ``FINDING`` of each candidate in ``documents``
    (doc_id, text and the path)."""
    sent = broadcast(documents.sparkSession.sparkContext, profile)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.float64())]
    names = ["doc_id", "row_key", "start", "size", "candidate", "features"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.record_batch(arrays, names=names)

        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(i) for i in range(4)]
            for doc_id, row_key, text, where in zip(*columns, strict=True):
                text = text.as_py() or ""
                for low, high in _spans(text):
                    numbers = _features(text, low, high, where.as_py() or "", sent.value)
                    value = (doc_id.as_py(), row_key.as_py(), low, high - low, text[low:high], numbers)
                    rows.append(value)
                    if len(rows) == 2000:
                        yield packed(rows)
                        rows = []
            yield packed(rows)

    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    texts = documents.select(ids, text_key().alias("row_key"), "text", F.col(path).cast("string"))
    return texts.mapInArrow(scan, f"doc_id bigint, row_key bigint, {FINDING}")


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n: of the documents of a batch that hold it."""

    def packed(seen: Counter) -> pa.RecordBatch:
        columns = [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())]
        return pa.record_batch(columns, names=["word", "n"])

    for batch in batches:
        seen: Counter = Counter()
        for text in batch.column(0):
            seen.update(set(_WORD.findall((text.as_py() or "").lower())))
            if len(seen) >= 100_000:
                yield packed(seen)
                seen = Counter()
        yield packed(seen)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cell, n: pairs of letter codes within words, weighed by documents."""
    seen = np.zeros(38 * 38, np.int64)
    for batch in batches:
        words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        codes = _codes("".join(words)).astype(np.int64)
        of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        within = np.flatnonzero(of[1:] == of[:-1])
        cells = codes[within] * 38 + codes[within + 1]
        np.add.at(seen, cells, n[of[within]])
    some = np.flatnonzero(seen)
    yield pa.record_batch([pa.array(some), pa.array(seen[some])], names=["cell", "n"])


def profile(documents: DataFrame) -> Profile:
    """From document frequencies of the words of all whole texts."""
    counted = documents.select(F.col("text").cast("string")).mapInArrow(_word_rows, "word string, n bigint")
    words = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "profile-words")
    cells = words.mapInArrow(_pair_rows, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    got = cells.toArrow()
    pairs = np.ones(38 * 38)
    pairs[got["cell"].to_numpy()] += got["n"].to_numpy()
    least = max(LEAST_DOCS, -(-documents.count() // DOC_SHARE))
    known = words.where((F.col("n") >= least) & (F.length("word") >= 3)).select("word")
    return Profile(frozenset(known.toArrow()["word"].to_pylist()), pairs.reshape(38, 38))


def _feature(name: str):
    return F.col("features")[FEATURES.index(name)]


def weak_labels(found: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` findings of each kind in hash order, with ``label``; findings that no rule
    decides are left out."""
    f = {name: _feature(name) for name in FEATURES}
    telling, placed = f["telling_before"] == 1, (f["assigned"] == 1) | (f["quoted"] == 1)
    value, size = F.col("candidate"), f["length"]
    plain = (f["blanks"] == 0) & (f["covered"] < 0.5)
    random = plain & (size >= 8) & (f["entropy"] >= 2.5) & (f["classes"] >= 2)
    mixed = random & ((f["digits"] > 0.1) | (f["classes"] >= 3))
    long = (f["blanks"] == 0) & (f["covered"] < 0.3) & (size >= LEAST) & (f["entropy"] >= 3.5)
    secret = (
        value.rlike(_KNOWN_KEY)
        | (telling & (f["assigned"] == 1) & (f["quoted"] == 1) & (f["entropy"] >= 3) & (f["digits"] > 0.1) & plain)
        | (telling & (f["assigned"] == 1) & (mixed | long))
        | ((f["header"] == 1) & (size >= 16) & mixed)
        | ((f["in_url"] == 1) & mixed)
    )
    place = telling | (f["header"] == 1) | (f["in_url"] == 1)
    words = (f["covered"] >= 0.7) & (f["digits"] == 0)
    number = value.rlike(r"^[\d.,:/+\-]+$") & ~place
    name = value.rlike(r"^[\p{L}.'\-]+$") & ~place & (size < LEAST)
    sentence = (f["blanks"] > 0) & ~place
    short = placed & ~place & (f["entropy"] < 2)
    other = words | number | name | sentence | short
    label = F.when(secret, 1.0).when(other, 0.0).alias("label")
    order = F.xxhash64(F.lit("findings"), "doc_id", "row_key", "start", "size")
    known = found.select("*", label).where("label IS NOT NULL").orderBy(order, "doc_id", "row_key", "start", "size")
    return known.where("label = 1").limit(rows).unionByName(known.where("label = 0").limit(rows))


def train(labelled: DataFrame):
    """A forest over (features, label), or the share of secrets where one kind is missing."""
    totals = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if totals[1] in (0, totals[0]):
        return totals[1] / totals[0] if totals[0] else 0.0
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    )
    ordered = labelled.select(array_to_vector("features").alias("features"), "label")
    return forest.fit(ordered)


def judge(found: DataFrame, model) -> DataFrame:
    """``found`` with the columns probability and is_secret."""
    if isinstance(model, float):
        judged = found.withColumn("probability", F.lit(model))
    else:
        vectors = found.withColumn("_v", array_to_vector("features"))
        scored = model.setFeaturesCol("_v").setProbabilityCol("_p").transform(vectors)
        judged = scored.withColumn("probability", vector_to_array("_p")[1]).select(
            *found.columns, "probability"
        )
    return judged.withColumn("is_secret", F.col("probability") >= 0.5)


def scan(documents: DataFrame, labelled: DataFrame | None = None, path: str = "source") -> DataFrame:
    """Every candidate with its probability; trained on weak labels unless given others."""
    found = stored(candidates(documents, profile(documents), path), "candidates")
    # Stored, so that all passes of the training see the same rows in the same order.
    training = stored((labelled if labelled is not None else weak_labels(found)), "labelled")
    return judge(found, train(training))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, start, size, sha256 of the value (the value itself stays out of reports),
    probability, is_secret."""
    sha = F.sha2(F.col("candidate").cast("binary"), 256).alias("value_sha256")
    return scan(documents).select("doc_id", "start", "size", sha, "probability", "is_secret")


def _masked(text: str, spans: list[dict]) -> str:
    out, at = [], 0
    for start, size in sorted({(s["start"], s["size"]) for s in spans}):
        if not out or start >= at:
            out += [text[at:start], MASK]
        at = max(at, start + size)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, judged: DataFrame) -> DataFrame:
    """All ``documents``, secrets replaced by ``MASK`` and n_chars (if any) counted anew."""
    spans = (
        judged.where("is_secret")
        .groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"))
        .agg(F.collect_list(F.struct("start", "size")).alias("_spans"))
    )
    key = text_key(documents["text"])
    same = documents["doc_id"].eqNullSafe(spans["_id"]) & (key == spans["_key"])
    at = documents.columns.index("text")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(at), batch.column(batch.num_columns - 1)
            changed = [
                t.as_py() if not s.is_valid else _masked(t.as_py(), s.as_py())
                for t, s in zip(texts, spans, strict=True)
            ]
            columns = batch.columns[:-1]
            columns[at] = pa.array(changed, texts.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    met = documents.join(spans, same, "left").select(
        *[documents[c] for c in documents.columns], spans["_spans"]
    )
    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes)
    masked = met.mapInArrow(mask, schema)
    if "n_chars" not in documents.columns:
        return masked
    kind = documents.schema["n_chars"].dataType
    counted = F.when(F.col("text").contains(MASK), F.length("text").cast(kind))
    return masked.withColumn("n_chars", F.coalesce(counted, "n_chars"))
