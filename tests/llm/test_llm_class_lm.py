import math
import re
import zlib
from collections import Counter

import numpy as np
from corpus_for_tests import AWKWARD, awkward, empty

from ledgerline.llm import class_lm
from ledgerline.llm.class_lm import Settings, score_documents

SMALL = Settings(words=60, classes=6, rounds=4)


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lower), "\n"]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check_base(rows, out):
    split = [(i, tokens(t)) for i, t in rows]
    counts = Counter(w for i, ws in split if not held_out(i) for w in ws)
    n, v = counts.total(), len(counts)
    expected = [
        (i, held_out(i), len(ws), sum(counts[w] > 0 for w in ws), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in split
    ]
    got = [
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])
        for r in out
    ]
    for a, b in zip(sorted(expected, key=repr), sorted(got, key=repr), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)


def test_base_scores_and_held_out_likelihood(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CHUNK_TOKENS", 60_000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    out = score_documents(docs).collect()
    check_base(rows, out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.99 * sum(r["base_score"] for r in held)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_awkward_rows(spark):
    out = score_documents(awkward(spark), SMALL).collect()
    check_base(AWKWARD, out)
    assert all(math.isfinite(r["score"]) for r in out)
    only_held = [(i, "x y") for i in range(100) if held_out(i)]
    out = score_documents(spark.createDataFrame(only_held, "doc_id long, text string")).collect()
    check_base(only_held, out)
    assert all(math.isfinite(r["score"]) for r in out)
    assert score_documents(empty(spark)).collect() == []


def test_exchange_finds_planted_classes(spark):
    """Two sorts of words take turns, so a class bigram is sure once they are apart."""
    rng = np.random.default_rng(1)
    pairs = Counter()
    for _ in range(4000):
        a, b = int(rng.integers(0, 20)), int(rng.integers(20, 40))
        pairs[a, b] += 1
        pairs[b, int(rng.integers(0, 20))] += 1
    s = Settings(words=40, classes=2, rounds=8)
    rows = [(a, b, n) for (a, b), n in pairs.items()] + [(s.end, 0, 5), (20, s.end, 5)]
    bigrams = spark.createDataFrame(rows, "a int, b int, n long")
    classes, left = class_lm.exchange(bigrams, s)
    assert len(set(classes[:20])) == len(set(classes[20:40])) == 1
    assert classes[0] != classes[20] and classes[s.end] == 2
    assert left.sum() == sum(r[2] for r in rows)


def test_words_beyond_the_core_have_classes_of_their_own(spark):
    """Rare words of one count and ending differ by their neighbours alone."""
    rng = np.random.default_rng(7)
    one, two = [f"r{i}ab" for i in range(30)], [f"s{i}ab" for i in range(30)]
    rows = []
    for i in range(400):
        some = rng.integers(0, 30, (10, 2))
        if i % 40 < 6 and not held_out(i):  # each rare word, but few times
            rows.append((i, " ".join(f"x {one[a]} y {two[b]}" for a, b in some)))
        else:
            rows.append((i, "x u y v " * 10))
    held = [i for i in range(400, 500) if held_out(i)]
    rows += [(held[0], "x r1ab y s1ab " * 5), (held[1], "x s1ab y r1ab " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r["score"] for r in score_documents(docs, Settings(words=4, classes=4)).collect()}
    assert out[held[0]] > out[held[1]] + 2


def test_probabilities_add_up_to_one():
    s = SMALL
    rng = np.random.default_rng(3)
    classes = rng.integers(0, s.classes, s.symbols)
    classes[s.end] = s.classes
    counts = np.zeros(s.symbols)
    counts[: s.words] = rng.integers(20, 50, s.words)
    singles = rng.integers(0, 9, class_lm.ENDINGS)
    counts[s.once : s.once + class_lm.ENDINGS] = singles
    twice = 40  # words of count two, all in the first frequency group
    counts[s.words] = 2 * twice
    left = np.zeros((s.symbols, s.classes + 1))
    left[:, 0] = counts
    n1 = int(singles.sum())
    transitions, emissions = class_lm._parameters(
        classes, left, {"n1": n1, "n2": twice, "counts": counts}, s
    )
    assert np.allclose((10**transitions).sum(axis=1), 1)
    by_class = np.zeros(s.classes + 1)
    np.add.at(by_class, classes[: s.words], 10 ** emissions[: s.words])
    by_class[classes[s.words]] += twice * 2 * 10 ** emissions[s.words]
    never = np.maximum(singles * (n1 - 1) / (2 * twice + 2), 1)
    for e in range(class_lm.ENDINGS):
        c = classes[s.once + e]
        # Without a word seen once, its share is left unused.
        by_class[c] += max(singles[e], 1) * 10 ** emissions[s.once + e]
        by_class[c] += never[e] * 10 ** emissions[s.unknown + e]
    used = np.unique(classes[: s.words])
    assert np.allclose(by_class[used], 1)
