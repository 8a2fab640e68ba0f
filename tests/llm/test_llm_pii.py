import hashlib
import random
import re
import time

from corpus_for_tests import AWKWARD, awkward, empty, texts
from pyspark.sql import functions as F

from ledgerline.llm.pii import _scan, personal_data, redact

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_force(text):
    return [
        (k, m.start(), m.end())
        for k, p in BASE.items()
        for m in re.finditer(p, text or "")
        if holds(k, m.group())
    ]


def check(docs, listed):
    out = {r["doc_id"]: r for r in personal_data(docs).collect()}
    for i, text in enumerate(listed):
        found = brute_force(text)
        joined = ",".join("%s:%d:%d" % f for f in found)
        assert out[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), text
        assert [out[i][f"n_{k}"] for k in BASE] == [sum(f[0] == k for f in found) for k in BASE]
        assert set(joined.split(",")) - {""} <= set(out[i]["spans"].split(","))
    return out


def test_base_matches(spark):
    rng = random.Random(3)
    listed = [
        "1.2.3.4.5.6.7.8 999.1.1.1.1.1 a@b.c_d@e.f",
        "4111 1111 1111 1111 x 4111-1111-1111-1111",
        "\U0001f600é +1 (459) 555-9246, +1 2",
        "4111111111111111 4111111111111111",
        "a@b.c@d.e @x.y a@@b.c",
        None,
        "",
        "9" * 500,
        "x" * 20000 + "@a.b",
        "1.1.1.1" * 40,
        "a.b-" * 3000,
        "00000000000000",
        "000.001.0255.255 256.1.1.1",
    ]
    for letters, n in (("0123456789 -.+()@ab", 400), ("0123456789 -.", 120)):
        listed += [
            "".join(rng.choice(letters) for _ in range(rng.randint(1, n))) for _ in range(300)
        ]
    check(texts(spark, listed), listed)


def test_contexts_find_unseen_identifiers(spark):
    listed = [f"my phone: +1 459 555 92{i:02} please" for i in range(30)]
    listed += ["my phone: 0459 555 9246 please", "my phone: nothing please", "take 0459 555 92 now"]
    docs = texts(spark, listed)
    out = check(docs, listed)
    assert out[30]["spans"] == "phone:10:23" and out[30]["n_phone"] == 0
    assert out[31]["spans"] == out[32]["spans"] == ""
    masked = redact(docs.withColumn("n_chars", F.lit(0)).withColumn("kind", F.lit("k")))
    assert masked.columns == ["doc_id", "text", "n_chars", "kind"]
    rows = {r["doc_id"]: r for r in masked.collect()}
    assert rows[0]["text"] == rows[30]["text"] == "my phone: <phone> please"
    assert rows[0]["n_chars"] == 24 and rows[31]["text"] == listed[31]


def test_overlapping_spans_are_replaced_together(spark):
    docs = texts(spark, ["a +4111111111111111 b", "1.2.3.4 c"]).withColumn("n_chars", F.lit(1))
    rows = {r["doc_id"]: r["text"] for r in redact(docs).collect()}
    assert "4111" not in rows[0] and rows[0].startswith("a ") and rows[0].endswith(" b")
    assert rows[1] == "<ip> c"


def test_awkward_rows(spark):
    out = personal_data(awkward(spark)).collect()
    assert len(out) == len(AWKWARD) and {r["spans"] for r in out} == {""}
    assert personal_data(empty(spark)).collect() == []
    same = redact(awkward(spark).withColumn("n_chars", F.lit(0)))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in same.collect()) == sorted(
        (i or 0, t or "") for i, t in AWKWARD
    )


def test_unseen_identifiers_of_a_fitting_form_do_not_count_against_a_pattern(spark):
    listed = [f"my phone: +1 459 555 92{i:02} please" for i in range(30)]
    listed += [f"my phone: 0459 555 92{i:02} please" for i in range(40)]
    # Three phones do not make a context of addresses one of phones.
    listed += [f"host at 10.0.0.{i} now" for i in range(30)]
    listed += [f"host at +1 459 777 920{i} now" for i in range(3)] + ["host at 0459 777 9200 now"]
    out = check(texts(spark, listed), listed)
    assert {out[i]["spans"] for i in range(30, 70)} == {"phone:10:23"}
    assert out[len(listed) - 1]["spans"] == ""


def test_found_identifiers_support_new_patterns_to_the_end_of_a_chain(spark):
    """Seeds stand in the first context only; each context shares its values with the next."""
    listed = [f"c0x: +1 459 555 92{i:02} e0" for i in range(5)]
    for step in range(8):
        for i in range(4):
            number = f"0459 6{step}5 92{i:02}"
            listed += [f"c{step}x: {number} e{step}", f"c{step + 1}x: {number} e{step + 1}"]
    out = check(texts(spark, listed), listed)
    assert {out[i]["spans"] for i in range(5, len(listed))} == {"phone:5:18"}


def last_words(before):
    """The last word of a text before an instance, and the one before that, by the plain rule."""
    two = re.search(r"(\S+)\s+\S*\s*$", before, re.ASCII)
    one = re.search(r"(\S+)\s*$", before, re.ASCII)
    return [m.group(1).lower() if m else "" for m in (two, one)]


def test_words_before_an_instance(spark):
    rng = random.Random(8)
    listed = ["", " ", "a", "a ", " a ", "a b", "a b ", "\na\tb\n", "ÄB \U0001f600 "]
    listed += ["".join(rng.choice(" \nab:É") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    docs = texts(spark, [t + "(0459 555 9246" for t in listed])
    out = _scan(docs).select("doc_id", F.inline("instances").alias("at", "near"))
    rows = out.collect()
    assert len(rows) == len(listed)
    for r in rows:
        before = (listed[r["doc_id"]] + "(")[: r["at"]["start"]]
        assert [r["near"]["left2"], r["near"]["left"]] == last_words(before)


def test_time_grows_with_the_text(spark):
    """A million characters without a blank, and as many words, before an instance."""
    run = "QWxhZGRpbjpvcGVu" * 70_000
    listed = [run + " phone: 0459 555 9246", "word " * 200_000 + "0459 555 9246", run + "0459 555 9246"]
    started = time.monotonic()
    out = personal_data(texts(spark, listed)).collect()
    assert time.monotonic() - started < 60 and len(out) == 3


def test_free_column_names(spark):
    docs = texts(spark, ["call +1 459 555 9246", None]).selectExpr(
        "doc_id", "text", "7 as _id", "8 as _hash", "1 as _spans", "2 as row", "3 as spans", "4 as text_hash",
        "5 as whole", "6 as n_chars"
    )
    out = redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [
        (0, "call <phone>", 7, 8, 1, 2, 3, 4, 5, 12), (1, None, 7, 8, 1, 2, 3, 4, 5, None)
    ]
