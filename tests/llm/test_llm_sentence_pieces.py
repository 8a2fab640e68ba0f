import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus_for_tests import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from ledgerline.llm.sentence_pieces import (
    CharacterMap,
    PieceModel,
    digest,
    encode_decode,
    model,
)
from ledgerline.llm.shared import table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = st.text(
    st.one_of(st.sampled_from(" \n\t▁abeé<>s/0x_"), st.characters(codec="utf-8")), max_size=60
)


def spans_by_library(library, text):
    """(first byte, end) of the library's pieces in the UTF-8 form of a text."""
    pieces = library.encode(text, return_type="proto").pieces
    return [(p.begin, p.end) for p in pieces]


def check(own, library, text):
    ((ids, starts, ends),) = own.encode([text])
    assert ids.tolist() == library.encode(text)
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == spans_by_library(library, text)
    assert own.decode(ids.tolist()) == library.decode(ids.tolist())


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_equals_library(text):
    check(model(PATH), LIBRARY, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=12))
def test_decodes_any_ids_as_the_library(ids):
    assert model(PATH).decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize(
    "text",
    [
        "",
        " ",
        "   a  b ",
        "▁▁ x▁y",
        "<s>a</s><unk><0x41>",
        "a\x00b\r\n\r\n c",
        "x" * 5000,
        "ab" * 3000 + " " * 3000,
        "日本語 テスト \U0001f600\U0001f468‍\U0001f469 é",
        "long " * 20000 + "y" * 20000,
    ],
)
def test_special_texts(text):
    check(model(PATH), LIBRARY, text)


def with_rules(tmp_path, name, **changes):
    """A copy of the model with the compiled map of a rule that the library brings along."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    if name:
        normalizer = sentencepiece.SentencePieceNormalizer(rule_name=name)
        rules = sentencepiece_model_pb2.ModelProto()
        rules.ParseFromString(normalizer.serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    for key, value in changes.items():
        setattr(proto.normalizer_spec, key, value)
    path = tmp_path / "rules.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


@pytest.mark.parametrize("name", ["nmt_nfkc", "nfkc_cf", None])
@pytest.mark.parametrize("trims", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_compiled_maps_keep_places(tmp_path, name, trims, prefix):
    path = with_rules(tmp_path, name, remove_extra_whitespaces=trims, add_dummy_prefix=prefix)
    own, library = PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)

    @settings(max_examples=150, deadline=None)
    @given(TEXTS)
    def same(text):
        check(own, library, text)

    same()
    for text in (
        "ＡＢＣ ﬁne  ½ ㍿ ①②  ",
        "  é ạ̈ 한국어 ｶﾞ",
        "　x  y\t\n",
        "…‥ ﷺ end",
        "   ",
    ):
        check(own, library, text)


def test_longest_rule_wins(tmp_path):
    path = with_rules(tmp_path, "nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    rules = CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    composed, alone = "é".encode(), "ﬁ".encode()
    assert rules.longest(b"x" + composed + b"y", 1) == ("é".encode(), len(composed))
    assert rules.longest(alone, 0) == (b"fi", len(alone))
    assert rules.longest(b"plain", 0) is None


def test_other_models_are_refused(tmp_path):
    with pytest.raises(ValueError):
        PieceModel(with_rules(tmp_path, None, escape_whitespaces=False))


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    encoded = encode_decode(docs, PATH)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    digests = {r["doc_id"]: r for r in digest(encoded).collect()}
    assert set(digests) == set(texts)
    for i, text in texts.items():
        ids = LIBRARY.encode(text or "")
        row = digests[i]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = LIBRARY.decode(ids)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
        assert row["covered_bytes"] == len((text or "").encode())
    row = encoded.where("size(ids) > 20").first()
    data = texts[row["doc_id"]].encode()
    assert b"".join(data[a:b] for a, b in zip(row["starts"], row["ends"], strict=True)) == data


def test_awkward_and_empty_tables(spark):
    rows = awkward(spark)
    found = encode_decode(rows, PATH).select("doc_id", "ids", "decoded").collect()
    expected = [
        (r["doc_id"], LIBRARY.encode(r["text"] or ""), LIBRARY.decode(LIBRARY.encode(r["text"] or "")))
        for r in rows.collect()
    ]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert digest(encode_decode(empty(spark), PATH)).collect() == []


def test_forgetting_changes_nothing(monkeypatch):
    own = PieceModel(PATH)
    monkeypatch.setattr("ledgerline.llm.sentence_pieces.REMEMBERED", 3)
    random = np.random.default_rng(1)
    for _ in range(60):
        texts = [" ".join("".join(random.choice(list("abcde"), 6)) for _ in range(8)) for _ in "ab"]
        texts += ["z" * 150, ""]
        assert [e[0].tolist() for e in own.encode(texts)] == LIBRARY.encode(texts)
        assert all(len(chunk) <= 100 for chunk in own.now)
