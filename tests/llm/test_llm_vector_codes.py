import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from corpus_for_tests import empty
from pyspark.sql import functions as F

from ledgerline.llm.shared import table
from ledgerline.llm.vector_codes import (
    Settings,
    code_report,
    compress,
    hilbert_keys,
    nearest,
    shortlist,
)

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, entries=256, rounds=4):
    """{(vec_id, code, error, label_error)} and the digest, by the rule itself."""
    kept = [
        (i, [math.floor(1024 * x) for x in v], label, tuple(v))
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[3]))
    dimension = next(len(r[1]) for r in kept if r[1] and len(r[1]) % 4 == 0)
    kept = [r for r in kept if len(r[1]) == dimension]
    w = dimension // 4
    pieces = [[r[1][p * w : (p + 1) * w] for r in kept] for p in range(4)]
    books = [part[:entries] for part in pieces]

    def assign(p):
        out = []
        for x in pieces[p]:
            d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for x, (e, _) in zip(pieces[p], assign(p), strict=True):
                members[e].append(x)
            books[p] = [
                [sum(c) // len(members[e]) for c in zip(*members[e], strict=True)]
                if e in members
                else old
                for e, old in enumerate(books[p])
            ]
    final = [assign(p) for p in range(4)]
    by_label = defaultdict(int)
    coded = []
    for at, r in enumerate(kept):
        error = sum(final[p][at][1] for p in range(4))
        coded.append((r[0], "".join(f"{final[p][at][0]:02x}" for p in range(4)), error, r[2]))
        by_label[r[2]] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode())
    return sorted(((*r[:3], by_label[r[3]]) for r in coded), key=repr), digest.hexdigest()


def collected(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[4] for r in rows}) == 1
    return sorted((r[:4] for r in rows), key=repr), rows[0][4]


def test_curve_visits_neighbours():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
        cells = np.stack([a.ravel() for a in axes], axis=1)
        keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shortlist_loses_no_nearest_entry():
    random = np.random.default_rng(3)
    shortened = 0
    for _ in range(200):
        entries = random.integers(-200, 200, (40, 4))
        points = random.integers(-200, 200, 4) + random.integers(0, 60, (30, 4))
        few = shortlist(
            points.min(axis=0), points.max(axis=0), points.sum(axis=0), len(points), entries
        )
        shortened += len(few) < 40
        code, squared = nearest(points, entries[few])
        every = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (few[code] == every.argmin(axis=1)).all()
        assert (squared == every.min(axis=1)).all()
    assert shortened > 150


def test_exact_beyond_doubles():
    points = np.array([[2**29, 3], [2**29 - 1, 3]])
    entries = np.array([[2**29, 3], [-(2**29), 1], [2**29 - 1, 3]])
    code, squared = nearest(points, entries)
    assert code.tolist() == [0, 2] and squared.tolist() == [0, 0]


@pytest.mark.parametrize("sf", ["0.001"])
def test_equals_brute_force_on_given_table(spark, sf):
    vectors = table(spark, f"/root/testdata/sf{sf}", "embeddings")
    listed = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()][:400]
    some = spark.createDataFrame(listed, SCHEMA)
    assert collected(code_report(some)) == brute_force(listed)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    listed = [
        (4, [0.5, -0.25, 1.0, 2.0], 1),
        (4, [0.5, -0.25, 1.0, 2.0], 1),
        (4, [0.5, 0.25, -1.0, 2.0], None),
        (None, [0.1, 0.2, 0.3, 0.4], None),
        (1, None, 1),
        (2, [0.1, None, 0.3, 0.4], 1),
        (3, [0.1, nan, 0.3, 0.4], 2),
        (5, [0.1, 0.2, -inf, 0.4], 2),
        (6, [], 2),
        (0, [1.0, 2.0], 2),
        (7, [0.0] * 8, 3),
        (8, [1e4, -1e4, 0.0, 7.0], None),
    ]
    vectors = spark.createDataFrame(listed, SCHEMA).withColumns(
        {"row": F.lit("x"), "code": F.lit(1), "part": F.lit(2), "vector": F.lit(None)}
    )
    assert collected(code_report(vectors)) == brute_force(listed)
    with pytest.raises(OverflowError):
        code_report(spark.createDataFrame([(1, [1e30] * 4, 1)], SCHEMA))


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert code_report(nothing).collect() == []
    assert compress(nothing).codebooks.size == 0
    assert empty(spark).count() == 0


def test_copies_of_a_vector_and_blocks_of_any_size(spark):
    random = np.random.default_rng(5)
    listed = [(int(i), random.normal(size=8).round(2).tolist(), int(i) % 3) for i in range(300)]
    listed += [(1000 + i, listed[7][1], None) for i in range(700)]
    vectors = spark.createDataFrame(listed, SCHEMA).repartition(5)
    expected = brute_force([(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()])
    for block in (512, 7):
        assert collected(code_report(vectors, Settings(block=block))) == expected


def test_fewer_entries_and_rounds(spark):
    vectors = table(spark, SF, "embeddings").limit(300)
    listed = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    some = spark.createDataFrame(listed, SCHEMA)
    rows, codebooks = compress(some, Settings(entries=10, rounds=2))
    assert codebooks.shape == (4, 10, 16)
    expected, _ = brute_force(listed, entries=10, rounds=2)
    found = {(r["vec_id"], r["error"]) for r in rows.collect()}
    assert found == {(r[0], r[2]) for r in expected}
