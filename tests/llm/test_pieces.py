import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from kpiweave.llm import charmap, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = ["a", "B", " ", "  ", "é", "é", "▁", "\t", "\n", "　", "ﬁ", "①", "Ａ", "カ", "ｶﾞ", "𓀀", "½", "¨"]
ODD += ["​", "\x00", "\x7f", "<s>", "</s>", "<0x41>", "한", "한", "hello", "Wort", "…", "👍🏽", "­"]


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 30))) for _ in range(n)]


def model_with(rule, prefix, trim):
    """The given pieces behind another normalisation."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(open(MODEL, "rb").read())
    spec = proto.normalizer_spec
    if rule:
        made = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
        spec.precompiled_charsmap = sentencepiece_model_pb2.ModelProto.FromString(made).normalizer_spec.precompiled_charsmap
    spec.add_dummy_prefix, spec.remove_extra_whitespaces = prefix, trim
    return proto.SerializeToString()


def by_library(processor, text):
    spans = processor.encode(text.encode(), return_type="offset_mapping")
    return spans["ids"], [tuple(o) for o in spans["offsets"]]


@pytest.mark.parametrize("rule", [None, "nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("trim", [True, False])
def test_ids_and_spans_are_the_librarys(rule, prefix, trim):
    content = model_with(rule, prefix, trim)
    own, processor = pieces.Model(content), sentencepiece.SentencePieceProcessor(model_proto=content)
    texts = odd_texts(1500) + ["", " ", "   ", "a  ", "  a", "x" * 300]
    first, ids, starts, ends = own.encode(pa.array(texts))
    for i, text in enumerate(texts):
        s = slice(first[i], first[i + 1])
        want, spans = by_library(processor, text)
        assert ids[s].tolist() == want, repr(text)
        assert list(zip(starts[s].tolist(), ends[s].tolist())) == spans, repr(text)


def test_the_longest_key_wins_from_the_left():
    compiled = sentencepiece_model_pb2.ModelProto.FromString(model_with("nmt_nfkc", True, True))
    found = charmap.CharMap(compiled.normalizer_spec.precompiled_charsmap)
    data = np.frombuffer("xｶﾞﬁ".encode(), np.uint8)
    start, length, value = found.matches(data, np.full(len(data), len(data)))
    assert start.tolist() == [1, 4, 7] and length.tolist() == [6, 3, 3]
    assert charmap._settled(start, length).tolist() == [0, 2]


def test_words_beyond_the_cache_are_encoded_again(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 3)
    own = pieces.Model(open(MODEL, "rb").read())
    for seed in range(4):
        texts = odd_texts(20, seed)
        first, ids, _, _ = own.encode(pa.array(texts))
        assert [ids[first[i] : first[i + 1]].tolist() for i in range(20)] == LIBRARY.encode(texts)
        assert len(own.known) < 600


def test_a_model_without_bytes_for_unknown_characters():
    proto = sentencepiece_model_pb2.ModelProto.FromString(model_with("nmt_nfkc", True, True))
    proto.trainer_spec.byte_fallback = False
    for piece in proto.pieces:
        piece.type = 1 if piece.type == 6 else piece.type
    content = proto.SerializeToString()
    own, processor = pieces.Model(content), sentencepiece.SentencePieceProcessor(model_proto=content)
    texts = odd_texts(500)
    first, ids, starts, ends = own.encode(pa.array(texts))
    for i, text in enumerate(texts):
        s = slice(first[i], first[i + 1])
        assert (ids[s].tolist(), list(zip(starts[s].tolist(), ends[s].tolist()))) == by_library(processor, text)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_report_with_nulls_repeats_long_texts_and_clashing_names(spark):
    texts = [None, "", "a b", "a b", "word " * 60_000, "x" * 100_000, *odd_texts(200)]
    rows = [(i % 150 if i else None, t, "mine", [1]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string, ids array<int>")
    got = sorted(map(tuple, pieces.report(df, MODEL).collect()), key=repr)
    want = []
    for doc_id, text, *_ in rows:
        ids = LIBRARY.encode(text or "")
        want.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids))))
    assert got == sorted(want, key=repr)


def test_encode_keeps_chosen_columns_and_decode_all(spark):
    df = spark.createDataFrame([(1, "Hé 𓀀", "k")], "doc_id bigint, text string, ids string")
    row = pieces.encode(df, MODEL, ("doc_id", "ids", "text")).first()
    spans = [b"H\xc3\xa9 \xf0\x93\x80\x80"[a:b].decode() for a, b in zip(row.starts, row.ends)]
    assert "".join(spans) == row.text and row.ids == LIBRARY.encode("Hé 𓀀")
    again = pieces.decode(pieces.encode(df, MODEL, ("doc_id", "text")), MODEL)
    assert again.columns == ["doc_id", "text", "ids", "starts", "ends", "decoded"]
    assert again.first().decoded == "Hé 𓀀"


def test_empty_table(spark):
    assert pieces.report(spark.createDataFrame([], "doc_id bigint, text string"), MODEL).count() == 0
