"""SentencePiece encoding with the source bytes of every piece, and decoding.

Texts are normalised here (``charmap``): the longest key of the model's compiled character map is
replaced at each character, and the source of every normalised byte is kept. No piece of a model
that keeps to word borders holds the mark of a space behind another character, so a text's pieces
are those of its words, each with the marks before it; words are cut further between characters that
no piece has side by side. A worker asks the library, with the model's normalisation switched off,
for the pieces of words it has not met, and puts the pieces of the texts together in numpy: ids,
and spans projected to the bytes of the source. A model with pieces across word borders is given
whole texts. Documents are not shuffled, and a worker's memory is bounded by a slice of texts and
``CACHED`` words.

Defined results: a null text is an empty one, without ids; a text is encoded whole, however long;
rows are independent of each other, so repeated rows and ties mean nothing; input columns named
like the added ones are replaced. Texts are UTF-8. Models that mark spaces behind words or have
symbols of their own (user defined) are refused.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from kpiweave.llm import tokens
from kpiweave.llm.charmap import MARK, CharMap, Rules, found, normalise, ragged

SPANS = "ids array<int>, starts array<int>, ends array<int>"
CACHED = 200_000  # words whose pieces a worker keeps
CACHED_BYTES = 16 << 20  # and their letters
SLICE = 1 << 18  # bytes of text encoded at a time; a longer text is a slice of its own
_USER_DEFINED, _BYTE = 4, 6  # types of pieces in the model file


class Model:
    """A model read from the bytes of its file, and the pieces of the words met so far."""

    def __init__(self, content: bytes):
        proto = sentencepiece_model_pb2.ModelProto.FromString(content)
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that mark spaces behind words are not supported")
        if any(p.type == _USER_DEFINED for p in proto.pieces):
            raise ValueError("models with user defined symbols are not supported")
        spec = proto.normalizer_spec
        compiled = spec.precompiled_charsmap
        self.rules = Rules(
            CharMap(compiled) if compiled else None,
            spec.add_dummy_prefix,
            spec.remove_extra_whitespaces,
            spec.escape_whitespaces,
        )
        mark = MARK.decode()
        self.by_word = all(mark not in p.piece.lstrip(mark) for p in proto.pieces)
        self.bytes_for_unknown = proto.trainer_spec.byte_fallback
        #: the byte that a piece stands for; -1 for others
        self.byte = np.array([int(p.piece[1:-1], 16) if p.type == _BYTE else -1 for p in proto.pieces])
        self.width = np.array([len(p.piece.encode()) for p in proto.pieces])
        self.width[self.byte >= 0] = 1
        self.tied = self._ties([p.piece.encode() for p in proto.pieces])
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=content)
        spec.Clear()
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self._forget()

    def _ties(self, pieces: list[bytes]) -> np.ndarray:
        """Which bytes stand side by side where two characters of some piece meet. A piece never
        spans other places, so a text may be cut there."""
        tied = np.full((256, 256), not self.bytes_for_unknown)
        for piece in pieces:
            for a, b in itertools.pairwise(piece):
                tied[a, b] |= (b & 0xC0) != 0x80
        return tied

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.first = np.zeros(1, np.int64)
        self.ids = self.widths = np.zeros(0, np.int32)

    def _cuts(self, data: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where words begin: at the start of a text, at a mark behind another character, and
        between characters that no piece has side by side."""
        begins = np.zeros(len(data), bool)
        begins[1:] = ((data[1:] & 0xC0) != 0x80) & ~self.tied[data[:-1], data[1:]]
        begins[first[:-1][np.diff(first) > 0]] = True
        if self.by_word:
            here = found(data)
            behind = np.concatenate([np.zeros(len(MARK), bool), here])[: len(here)]
            begins |= here & ~behind
        return np.flatnonzero(begins)

    def _learn(self, words: list[bytes]) -> None:
        """Adds the pieces of new words and the bytes that each piece takes."""
        if self.bytes_for_unknown:
            lists = self.plain.encode(words, num_threads=1)
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            ids = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(size.sum()))
            widths = self.width[ids].astype(np.int32)
        else:
            got = self.plain.encode(words, return_type="offset_mapping", num_threads=1)
            size = np.array([len(g["ids"]) for g in got], np.int64)
            ids = np.array([i for g in got for i in g["ids"]], np.int32)
            widths = np.array([e - s for g in got for s, e in g["offsets"]], np.int32)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size)])
        self.ids = np.concatenate([self.ids, ids])
        self.widths = np.concatenate([self.widths, widths])
        self.known_bytes += sum(map(len, words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """first, ids, starts, ends: text i has the pieces ``first[i] : first[i + 1]``, and the
        spans are bytes of the text."""
        raw, offsets = tokens._buffer(texts)
        norm = normalise(raw, offsets, self.rules)
        if len(self.known) > CACHED or self.known_bytes > CACHED_BYTES:
            self._forget()
        low = self._cuts(norm.data, norm.first)
        high = np.append(low[1:], len(norm.data))
        content, known = norm.data.tobytes(), self.known
        before = len(known)
        code = np.fromiter(
            (known.setdefault(content[a:b], len(known)) for a, b in zip(low.tolist(), high.tolist())),
            np.int64,
            len(low),
        )
        if len(known) > before:
            self._learn(list(itertools.islice(known, before, None)))
        pick = ragged(self.first[code], self.first[code + 1] - self.first[code])
        ids = self.ids[pick]
        # The pieces of all words, one after the other, cover the normalised texts.
        stop = np.cumsum(self.widths[pick], dtype=np.int64)
        begin = stop - self.widths[pick]
        first = np.searchsorted(begin, norm.first)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        stop, begin = self._characters(ids, begin, stop)
        start = norm.source[begin]
        end = norm.last[text]
        inside = stop < norm.first[text + 1]
        end[inside] = norm.source[stop[inside]]
        same = stop == begin
        end[same] = start[same]
        return first, ids, start - offsets[text], end - offsets[text]

    def decoded(self, first: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The text of each run of ids, by the library."""
        plain = ids.tolist()
        bounds = itertools.pairwise(first.tolist())
        return pa.array([self.whole.decode(plain[a:b]) for a, b in bounds], pa.string())

    def _characters(self, ids, begin, stop):
        """A character without a piece is spelt in bytes: its last byte has its span, the others
        are empty and stand at its start."""
        byte = self.byte[ids]
        if not np.any(byte >= 0):
            return stop, begin
        lead = (byte >= 0) & ((byte & 0xC0) != 0x80)
        head = np.maximum.accumulate(np.where(lead, np.arange(len(ids)), 0))
        letter = byte[head]
        size = 1 + (letter >= 0xC0) + (letter >= 0xE0) + (letter >= 0xF0)
        spelt = byte >= 0
        closing = np.arange(len(ids)) - head + 1 == size
        begin, stop = begin.copy(), stop.copy()
        begin[spelt] = begin[head][spelt]
        stop[spelt & ~closing] = begin[spelt & ~closing]
        return stop, begin


_models: dict[int, Model] = {}


def _loaded(content: bytes) -> Model:
    """One model per worker process."""
    key = hash(content)
    if key not in _models:
        _models.clear()
        _models[key] = Model(content)
    return _models[key]


def encode(
    documents: DataFrame, model: str, keep: Sequence[str] = ("doc_id",), decoded: bool = False
) -> DataFrame:
    """The columns ``keep`` with ids and, per piece, the start and end of its bytes in ``text``.
    ``model``: the path of the model file, read once by the driver. ``decoded`` adds the text of
    the ids, as ``decode`` does, in the same pass."""
    sent = documents.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    more = ("decoded",) if decoded else ()
    added = ("ids", "starts", "ends", *more)
    kept = [c for c in keep if c not in added]
    fields = [*[documents.schema[c] for c in kept], *T._parse_datatype_string(SPANS).fields]
    fields += [T.StructField(name, T.StringType()) for name in more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(sent.value)
        for batch in batches:
            for part in tokens.slices(batch, "text_", SLICE):
                first, *columns = own.encode(part.column("text_"))
                offsets = pa.array(first.astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in columns]
                if decoded:
                    lists.append(own.decoded(first, columns[0]))
                rows = [part.column(c) for c in kept]
                yield pa.record_batch([*rows, *lists], names=[*kept, *added])

    texts = documents.select(*kept, F.col("text").cast("string").alias("text_"))
    return texts.mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; null ids are none."""
    sent = encoded.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    kept = [c for c in encoded.columns if c != "decoded"]
    schema = T.StructType([*[encoded.schema[c] for c in kept], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(sent.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                lists = part.column("ids")
                first = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
                texts = own.decoded(first, lists.flatten().to_numpy())
                columns = [*[part.column(c) for c in kept], texts]
                yield pa.record_batch(columns, names=[*kept, "decoded"])

    return encoded.select(*kept).mapInArrow(run, schema)


def report(documents: DataFrame, model: str) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encode(rows, model, decoded=True).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
