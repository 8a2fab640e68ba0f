import random
from collections import Counter

import pytest

from ledgerline.operators.reconcile import compare_by_identifier, reconcile

SCHEMA = "id bigint, a string, b string, x double"


def brute_force(sent, stored):
    s, t = Counter(r[0] for r in sent), Counter(r[0] for r in stored)
    lost = Counter(sent) - Counter(stored)
    return (
        len(sent), len(stored), len(set(s) - set(t)), len(set(t) - set(s)),
        sum(n > 1 for n in t.values()), len({r[0] for r in lost} & set(t)),
    )


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, exact, seed):
    rng = random.Random(seed)
    sent = [
        (0 if rng.random() < 0.3 else rng.randrange(200), rng.choice("pq"), rng.choice(["p", None]),
         float(rng.randrange(3)))
        for _ in range(600)
    ]
    stored = [r for r in sent if rng.random() > 0.2]
    stored += [(r[0], "z", r[2], r[3]) for r in rng.sample(sent, 20)] + rng.sample(sent, 20)
    stored += [(1000 + i, "n", None, None) for i in range(5)]
    out = reconcile(
        spark.createDataFrame(sent, SCHEMA), spark.createDataFrame(stored, SCHEMA), "id", exact
    )
    assert tuple(out.first()) == brute_force(sent, stored)


def test_values_that_move_between_nullable_columns_are_a_change(spark):
    sent = spark.createDataFrame([(1, "v", None, 1.0)], SCHEMA)
    stored = spark.createDataFrame([(1, None, "v", 1.0)], SCHEMA)
    assert reconcile(sent, stored, "id").first()["n_changed"] == 1


def test_empty_sides(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tuple(reconcile(empty, empty, "id").first()) == (0, 0, 0, 0, 0, 0)
    one = spark.createDataFrame([(1, "v", None, 1.0)], SCHEMA)
    assert tuple(reconcile(one, empty, "id").first()) == (1, 0, 1, 0, 0, 0)


def test_columns_are_matched_by_name(spark):
    sent = spark.createDataFrame([(1, "v", "w", 1.0)], SCHEMA)
    assert reconcile(sent, sent.select("x", "b", "a", "id"), "id").first()["n_changed"] == 0


def test_no_join_and_combined_shuffles(spark, plan):
    df = spark.createDataFrame([(1, "v", "w", 1.0)], SCHEMA)
    text = plan(compare_by_identifier(df, df, "id"))
    assert "Join" not in text and text.count("Exchange") == 2 and "partial_sum" in text
