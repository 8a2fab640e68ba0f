import random
import re
from collections import Counter

import pytest
from corpus_for_tests import awkward, empty, texts

from ledgerline.llm.decontaminate import (
    _items,
    _windows,
    contaminated,
    keep_clean,
    within_radius,
)
from ledgerline.llm.shared import written

ITEMS = "item_id long, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(listed):
    if len(listed) < 5:
        return Counter([" ".join(listed)] if listed else [])
    return Counter(" ".join(listed[i : i + 5]) for i in range(len(listed) - 4))


def weight(counts):
    return sum(len(k) * n for k, n in counts.items())


def brute_force(docs, items):
    """(best similarity, number of windows) of each text and item that reach 0.8."""
    found, windows = {}, Counter()
    for d, text in docs:
        of = words(text)
        for i, item in items:
            wanted = shingles(words(item))
            size = len(words(item))
            for start in range(max(len(of) - size, 0) + 1):
                have = shingles(of[start : start + size])
                if not (wanted & have):
                    continue
                score = 2 * weight(wanted & have) / (weight(wanted) + weight(have))
                if score >= 0.8:
                    found[d, i] = max(score, found.get((d, i), 0))
                    windows[d, i] += 1
    return {k: (score, windows[k]) for k, score in found.items()}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_against_brute_force(spark, limit):
    """With and without broadcasts; copies, changed words, cut and shifted passages."""
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(300)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(prose(n))) for i, n in enumerate([40, 40, 25, 60, 3, 1, 0, 12])]
    docs = []
    for i, (_, item) in enumerate(items):
        passage = item.split()
        docs.append(prose(30) + passage + prose(10))
        docs.append(prose(5) + passage[1:] + prose(50))
        changed = list(passage)
        if changed:
            changed[len(changed) // 2] = "changed"
        docs.append(prose(9) + changed + prose(7))
        docs.append(prose(9) + passage[: len(passage) // 2] + prose(9))
        half = len(passage) // 2
        docs.append(prose(9) + passage[half:] + passage[:half] + prose(9))
        third = len(passage) // 3
        docs.append(passage[2 * third :] + passage[third : 2 * third] + passage[:third] + prose(3))
        docs.append(prose(4) + passage[:half] + ["put", "in"] + passage[half:] + prose(4))
        docs.append(passage[half:] + passage + prose(2) + passage[:half])
    docs += [prose(80), items[0][1].split()[2:], items[3][1].upper().split() * 3]
    listed = [(i, ", ".join(d)) for i, d in enumerate(docs)]
    out = contaminated(
        spark.createDataFrame(listed, "doc_id long, text string"),
        spark.createDataFrame(items, ITEMS),
        broadcast_rows=limit,
    ).collect()
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["n_windows"]) for r in out}
    assert got == brute_force(listed, items)


def test_exchanged_halves_are_found(spark):
    item = [f"i{k}" for k in range(40)]
    text = " ".join(["x"] * 7 + item[20:] + item[:20] + ["y"] * 7)
    out = contaminated(
        spark.createDataFrame([(1, text)], "doc_id long, text string"),
        spark.createDataFrame([(1, " ".join(item))], ITEMS),
    ).collect()
    assert [(r["start"], round(r["similarity"], 3)) for r in out] == [(7, 0.889)]


def test_shingles_that_all_items_hold_make_no_windows(spark):
    common = " ".join(f"c{k}" for k in range(12))
    items = [(i, common + " " + " ".join(f"i{i}.{k}" for k in range(20))) for i in range(30)]
    docs = [(i, f"a{i} " + common + f" b{i} " * 30) for i in range(30)] + [(99, items[3][1])]
    texts_ = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "text", "doc_id", "unhex(md5(text)) as text_id"
    )
    found = _windows(texts_, written(_items(spark.createDataFrame(items, ITEMS)), "i"), 0.8, 10)
    assert found.select("item").distinct().count() == 1 and found.count() < 20


def test_rows_are_kept_by_their_own_text(spark):
    item = " ".join(f"i{k}" for k in range(30))
    rows = [(1, "clean text of its own"), (1, item), (None, "a " + item), (None, "clean"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as _held", "2 as text_id", "3 as row", "4 as item", "5 as words"
    )
    kept = keep_clean(docs, spark.createDataFrame([(1, item)], ITEMS))
    assert kept.columns == docs.columns
    assert sorted((tuple(r)[:3] for r in kept.collect()), key=repr) == sorted(
        [(1, "clean text of its own", 1), (None, "clean", 1), (2, None, 1)], key=repr
    )


def test_all_fingerprints_within_the_radius_are_found(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(4)]

    def near(value, bits):
        for b in rng.sample(range(64), bits):
            value ^= 1 << b
        return value

    left = [(i, 30, near(base[i % 4], i % 30)) for i in range(90)]
    right = [(i, 30, b) for i, b in enumerate(base)] + [(9, 31, base[0])]
    signed = lambda rows: [(a, b, v - (v >> 63 << 64)) for a, b, v in rows]
    out = within_radius(
        spark.createDataFrame(signed(left), "window long, length int, print long"),
        spark.createDataFrame(signed(right), "item long, length int, print long"),
        20,
    )
    expected = {
        (a, c, (v ^ w).bit_count())
        for a, n, v in left
        for c, m, w in right
        if n == m and (v ^ w).bit_count() <= 20
    }
    assert {tuple(r) for r in out.collect()} == expected


def test_awkward_rows(spark):
    items = spark.createDataFrame(
        [(1, "q r s t u v"), (1, "q r s t u v"), (None, "a b c"), (3, None), (4, "")], ITEMS
    )
    out = contaminated(awkward(spark), items).collect()
    found = sorted(((r["doc_id"], r["item_id"], r["similarity"]) for r in out), key=repr)
    assert found == [(3, 1, 1.0), (5, None, 1.0)]
    assert contaminated(awkward(spark), spark.createDataFrame([], ITEMS)).collect() == []
    assert contaminated(empty(spark), items).collect() == []
    kept = keep_clean(awkward(spark), items)
    assert kept.columns == awkward(spark).columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [
        1, 2, 2, 7, 9, 11,
    ]
    assert kept.where("doc_id is null").count() == 2


def test_clean_texts_that_share_one_shingle_stay(spark):
    item = " ".join(f"i{k}" for k in range(40))
    docs = texts(spark, ["x y z " + " ".join(f"i{k}" for k in range(5, 12)) + " other end"])
    assert contaminated(docs, spark.createDataFrame([(1, item)], ITEMS)).collect() == []


def test_shingles_are_made_without_copies_of_all_words(spark):
    from pyspark.sql import functions as F

    from ledgerline.llm.decontaminate import _places
    from ledgerline.llm.shared import plain_words

    rows = [(1, "A b, c-D é f"), (2, "..."), (3, "")]
    docs = spark.createDataFrame(rows, "text_id long, text string")
    places = _places(docs.select("text_id", plain_words(F.col("text")).alias("words")), [5])
    assert sorted((r.text_id, r.n_words, r["at"]) for r in places.collect()) == [(1, 6, 0), (1, 6, 1)]
    plan = places._jdf.queryExecution().sparkPlan().toString()
    (made,) = [line for line in plan.split("\n") if "Generate explode" in line]
    # What goes along with each shingle.
    assert re.search(r", \[text_id#\d+L?, n_words#\d+\], false, ", made)
    words = docs.select(F.explode(plain_words(F.col("text"))).alias("w")).collect()
    assert [r["w"] for r in words] == ["a", "b", "c", "d", "é", "f"]
