import zlib

import numpy as np
from corpus_for_tests import AWKWARD, awkward, empty

from ledgerline.llm.quality import (
    Model,
    Settings,
    document_statistics,
    fit,
    fourier,
    isotonic,
    keep_good,
    score_quality,
    statistics_of,
)

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_what_scores_depend_on(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = {r["doc_id"]: r for r in score_quality(docs, labels).collect()}
    assert len(out) == docs.count()
    for i, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [
        (out[r["doc_id"]], r["quality"]) for r in labels.collect() if out[r["doc_id"]]["held_out"]
    ]
    assert np.mean([o["predicted"] == q for o, q in held]) > 0.93
    good = [o["score"] for o, q in held if q]
    bad = [o["score"] for o, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r["text"], set()).add(out[r["doc_id"]]["score"])
    assert all(len(scores) == 1 for scores in texts.values())
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["predicted"]}


def test_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(5, 1), (5, 1), (7, 0), (None, 1), (2, None), (11, 0)], "doc_id long, quality int"
    )
    out = score_quality(awkward(spark), labels).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in out)
    assert not any(r["held_out"] for r in out if r["doc_id"] is None)
    none = score_quality(awkward(spark), labels.limit(0)).collect()
    assert {round(r["score"], 2) for r in none} <= {0.49, 0.5, 0.51}
    assert score_quality(empty(spark), labels).collect() == []
    predicted = [r["predicted"] for r in out]
    assert keep_good(awkward(spark), labels).count() == sum(predicted)
    assert keep_good(empty(spark), labels).collect() == []


def test_every_row_is_judged_by_its_own_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in score_quality(docs, labels).where("predicted = 1").collect()}
    # Other rows than the labelled ones get no id or one id, and columns of any name.
    known = {r["doc_id"] for r in labels.collect()}
    wanted = docs.join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    changed = wanted.selectExpr(
        "case when doc_id % 2 = 0 then -1L end as doc_id", "text", "doc_id as _kept", "1 as stats"
    ).unionByName(
        docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi").selectExpr(
            "doc_id", "text", "doc_id as _kept", "1 as stats"
        )
    )
    kept = keep_good(changed, labels)
    assert kept.columns == changed.columns
    assert {r["_kept"] for r in kept.collect()} == good and len(good - known) > 50


def test_weights_solve_the_normal_equations(spark):
    """Against the whole matrix of features of the training rows, and one fold left out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    settings = Settings(features=24, ridge=1e-2)
    model = fit(document_statistics(docs), labels, settings)
    of = {r["doc_id"]: statistics_of(r["text"] or "") for r in docs.collect()}
    train = [
        (of[r["doc_id"]], r["quality"])
        for r in labels.collect()
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2
    ]
    x, y = np.array([s for s, _ in train]), np.array([q for _, q in train], dtype=float)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(
        model.scale[x.std(axis=0) > 1e-6], x.std(axis=0)[x.std(axis=0) > 1e-6]
    )
    z = fourier(x, model)
    penalty = np.eye(25) * settings.ridge * len(y)
    penalty[-1, -1] = 1e-9
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)
    # Features whose products come near the kernel they stand for.
    wide = Model(Settings(features=6000), model.mean, model.scale, np.zeros(6001))
    some = x[:40]
    near = fourier(some, wide)[:, :-1]
    s = np.clip((some - model.mean) / model.scale, -5, 5)
    apart = ((s[:, None] - s[None]) ** 2).sum(axis=2) / s.shape[1]
    assert np.abs(near @ near.T - np.exp(-apart / 2)).max() < 0.1


def test_isotonic_pools_violators():
    x, y = isotonic([1, 2, 3, 4], [1, 1, 2, 1], [0, 1, 0, 1])
    assert x == [1, 8 / 3, 4] and y == [0, 1 / 3, 1]
    assert isotonic([], [], []) == ([], [])
