import hashlib
import random

import numpy as np
import public_tokenizers
from corpus_for_tests import AWKWARD, awkward, empty
from tokenizers import Tokenizer

from ledgerline.llm.word_bpe import WordBpe, digest, encode_decode

PATH = public_tokenizers.path("word_bpe_49k.json")


def listed():
    rng = random.Random(5)
    odd = [
        "", "aaa", "aaaaaaaa hello", "<|endoftext|>x<|startoftext|> y <|endoftext", "ΑΣ ΟΔΟΣ İ ß ſ",
        "a\x1cb \x85c　d​e", "x" * 5000, "ab" * 700, "é ́a  b\t\tc\r\nd", "it's WE'RE 123 ½ ²",
        "😀😀 👨‍👩‍👧", " \n ", "!!!!???... ---", "<|EndOfText|>",
        "".join(rng.choice("aeionrst") for _ in range(20000)),
    ]
    odd += ["".join(rng.choice("abcdeéßΣ1 '!<|>endoftext") for _ in range(300)) for _ in range(200)]
    points = [(32, 0x250), (0x300, 0x700), (0x1F00, 0x2100), (0x3000, 0x30FF), (0x10000, 0x1FFFF)]
    odd += [
        "".join(chr(rng.randint(*rng.choice(points))) for _ in range(200)) for _ in range(200)
    ]
    odd += [
        " ".join("".join(rng.choice("aeiourstlnthéing") for _ in range(rng.randint(1, 14)))
                 for _ in range(50))
        for _ in range(200)
    ]
    return odd


def test_equals_the_library():
    bpe, library = WordBpe(PATH), Tokenizer.from_file(PATH)
    texts = listed()
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(ids, dtype="<i4").tolist()
        assert got == expected, text[:80]
        assert bpe.decode(got) == library.decode(expected, skip_special_tokens=False)


def test_pairs_against_exact_merging():
    """A pair is compatible if merging the symbols of both gives the two tokens again."""
    bpe, rng = WordBpe(PATH), random.Random(2)
    inner, final = list(bpe.inner.items()), list(bpe.final.items())
    pairs = [(rng.choice(inner), rng.choice(final)) for _ in range(4000)]
    good = bpe.compatible(np.array([a[1] for a, _ in pairs]), np.array([b[1] for _, b in pairs]))
    for ((left, a), (right, b)), compatible in zip(pairs, good, strict=True):
        merged = bpe._merge(bpe._symbol_ids(left + right))[0]
        assert compatible == (merged == [a, b])
    assert 0 < good.sum() < len(pairs)


def test_awkward_rows(spark):
    library = Tokenizer.from_file(PATH)
    out = digest(encode_decode(awkward(spark), PATH)).collect()
    expected = []
    for i, text in AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shas = [" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)]
        expected.append((i, len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in shas)))
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)
    assert encode_decode(empty(spark), PATH).collect() == []


def test_words_are_merged_beside_each_other(monkeypatch):
    """No word of common length is guessed or merged on its own; what comes out is the same."""
    bpe, library, rng = WordBpe(PATH), Tokenizer.from_file(PATH), random.Random(8)

    def alone(*_):
        raise AssertionError("a word on its own")

    monkeypatch.setattr(bpe, "_merge", alone)
    monkeypatch.setattr(bpe, "_greedy", alone)
    parts = ["tion", "th", "er", "an", "é", "ing", "Ö", "the", "日本", ",", "'s", "7"]
    texts = [
        " ".join("".join(rng.choices(parts, k=rng.randint(1, 8))) for _ in range(rng.randint(1, 60)))
        for _ in range(300)
    ]
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<i4").tolist() == expected, text


def test_words_of_any_length_meet(monkeypatch):
    """Words that go on their own and those that do not stand in their places."""
    monkeypatch.setattr("ledgerline.llm.word_bpe.BESIDE", 4)
    monkeypatch.setattr("ledgerline.llm.word_bpe.REMEMBERED", 50)
    bpe, library = WordBpe(PATH), Tokenizer.from_file(PATH)
    texts = listed()
    for start in range(0, len(texts), 40):
        some = texts[start : start + 40]
        for text, ids in zip(some, bpe.encode(some), strict=True):
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, dtype="<i4").tolist() == expected, text[:80]


def test_what_is_remembered_stays_small():
    """An executor's memory holds two workers beside the JVM, so a worker's share is small."""
    bpe = WordBpe(PATH)
    for k in range(6):
        bpe.encode([" ".join(f"w{n}" for n in range(k * 60_000, (k + 1) * 60_000))])
    assert len(bpe.now) + len(bpe.last) <= 150_000
