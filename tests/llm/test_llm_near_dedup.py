import random
import re

import pytest
import xxhash
from corpus_for_tests import AWKWARD, awkward, empty, texts
from pyspark.sql import functions as F

from ledgerline.llm.components import (
    _large_star,
    _small_star,
    _with_least,
    connected_components,
)
from ledgerline.llm.near_dedup import fingerprint_links, keep_one, near_duplicates
from ledgerline.llm.shared import written


def brute_print(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if 0 < len(words) < 3:
        grams = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [brute_print(r["text"]) for r in rows]
    component = brute_components(prints, 2)
    expected = {
        (r["doc_id"], f"{p:016x}", rows[c]["doc_id"])
        for r, p, c in zip(rows, prints, component)
    }
    assert {tuple(r) for r in near_duplicates(docs).collect()} == expected


def test_awkward_rows(spark):
    out = [tuple(r) for r in near_duplicates(awkward(spark)).collect()]
    assert len(out) == len(AWKWARD)
    prints = [brute_print(t) for _, t in AWKWARD]
    component = brute_components(prints, 2)
    ids = [i for i, _ in AWKWARD]
    least = {
        c: min((i for i, d in zip(ids, component) if d == c and i is not None), default=None)
        for c in component
    }
    expected = [(i, f"{p:016x}", least[c]) for i, p, c in zip(ids, prints, component)]
    assert sorted(out, key=repr) == sorted(expected, key=repr)
    assert near_duplicates(empty(spark)).collect() == []


@pytest.mark.parametrize("radius", [1, 2])
def test_links_connect_what_brute_force_does(spark, radius):
    """A third of the fingerprints lie in one dense cluster, a chain runs through another."""
    rng = random.Random(radius)
    centre, chain = rng.getrandbits(64), [rng.getrandbits(64)]
    values = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(12)) for _ in range(120)}
    for b in range(0, 40, 2):
        chain.append(chain[-1] ^ (3 << b))
    values = sorted(values | set(chain) | {rng.getrandbits(64) for _ in range(150)} | {0, 2**64 - 1})
    df = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fp long").repartition(5)
    found = connected_components(fingerprint_links(df, radius)).collect()
    parts = {}
    for r in found:
        parts.setdefault(r["component"], set()).add(r["node"] % 2**64)
    expected = {}
    for v, c in zip(values, brute_components(values, radius)):
        expected.setdefault(c, set()).add(v)
    assert sorted(map(sorted, parts.values())) == sorted(
        sorted(p) for p in expected.values() if len(p) > 1
    )


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7)]
    out = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in out} == {
        **{i: 0 for i in range(41)},
        100: 100,
        **{200 + i: 100 for i in range(30)},
    }
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_round_without_hubs_plans_its_edges_once(spark, plan):
    """Both directions of the edges are two scans; joins with themselves made eight."""
    edges = written(spark.range(40).selectExpr("id AS u", "id + 1 AS v"), "edges")
    text = plan(_small_star(_large_star(edges, False), False))
    assert text.count("FileScan parquet") == 2
    assert "Join" not in text


def test_components_of_hubs(spark):
    """A node of more edges than HUB, and one that becomes a hub only as rounds go on."""
    star = [(5000, i) for i in range(1, 1500)]
    tree = [(10_000 + i, 10_000 + (i - 1) // 3) for i in range(1, 1500)]
    edges = spark.createDataFrame(star + tree, "u long, v long")
    out = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert out == {
        5000: 1, **{i: 1 for i in range(1, 1500)}, **{10_000 + i: 10_000 for i in range(1500)}
    }
    names = "u", "v", "m"
    found = [sorted(_with_least(edges, hubs).select(*names).collect()) for hubs in (False, True)]
    assert found[0] == found[1]


def test_one_document_of_each_group_stays(spark):
    line = " ".join(f"w{i}" for i in range(400))
    docs = texts(spark, [line, "quite another text here", line, line + " end"]).withColumn(
        "lang", F.lit("en")
    )
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    groups = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert {r["doc_id"] for r in kept.collect()} == set(groups.values()) >= {0, 1}
    assert keep_one(awkward(spark)).where("doc_id is null").count() == 2
