"""Deletions: records of their own, that win by event time and stay in the history."""

import pytest

from ledgerline import FeatureGroup, FeatureStore, OfflineStore, ValidationError

FEATURES = (("id", "Integral"), ("at", "String"), ("v", "Fractional"))
GROUP = FeatureGroup("g", "id", "at", FEATURES, online=True, offline=OfflineStore())
RAW = "id string, at string, v string"


def rows(spark, *listed):
    return spark.createDataFrame([(str(i), f"2024-01-{d:02}", str(v)) for i, d, v in listed], RAW)


def gone(spark, *listed):
    return spark.createDataFrame([(f"2024-01-{d:02}", str(i)) for i, d in listed], "at string, id string")


def online(store):
    return {r["id"]: r["v"] for r in store.online(GROUP).read().collect()}


@pytest.fixture()
def store(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), buckets=4)
    store.ingest(rows(spark, (1, 1, 1), (2, 5, 2), (3, 9, 3)), GROUP)
    return store


@pytest.mark.parametrize("compacted", [False, True])
def test_deletions_win_by_event_time(spark, store, compacted):
    store.delete(gone(spark, (1, 3), (2, 3), (3, 9), (4, 3)), GROUP)
    if compacted:
        store.online(GROUP).compact()
    # The record of 2 is later; that of 3 is as late, and the deletion came after it.
    assert online(store) == {2: 2.0}
    # An earlier record that arrives later stays deleted, a later one is there again.
    store.ingest(rows(spark, (1, 2, 10), (4, 4, 40)), GROUP)
    assert online(store) == {2: 2.0, 4: 40.0}
    table = store.online(GROUP)
    assert [r["id"] for r in table.get(1, 2).collect()] == [2]
    wanted = spark.createDataFrame([(1,), (2,), (4,), (9,)], "id long")
    assert {r["id"] for r in table.lookup(wanted).collect()} == {2, 4}
    assert table.read().columns == ["id", "at", "v"]


def test_the_history_keeps_records_and_deletions(spark, store):
    store.delete(gone(spark, (1, 3), (1, 3)), GROUP)
    history = store.history(GROUP)
    assert sorted((r["id"], r["is_deleted"]) for r in history.collect()) == [
        (1, False), (1, True), (1, True), (2, False), (3, False)
    ]
    deletion = history.filter("is_deleted").first()
    assert (deletion["v"], deletion["at"], deletion["day"]) == (None, "2024-01-03", "03")


def test_a_replay_of_a_deletion_changes_nothing(spark, store):
    store.delete(gone(spark, (1, 1)), GROUP, ["OnlineStore"], sequence=2**62)
    store.ingest(rows(spark, (1, 1, 5)), GROUP, ["OnlineStore"], sequence=2**62 + 1)
    store.delete(gone(spark, (1, 1)), GROUP, ["OnlineStore"], sequence=2**62)
    assert online(store)[1] == 5.0


def test_only_keys_and_valid_rows(spark, store, tmp_path):
    with pytest.raises(ValidationError, match="id, at and no others"):
        store.delete(rows(spark, (1, 1, 1)), GROUP)
    bad = spark.createDataFrame([("1", "2024-01-01"), ("2", "never")], "id string, at string")
    with pytest.raises(ValidationError) as caught:
        store.delete(bad, GROUP)
    assert caught.value.total == 1 and online(store) == {1: 1.0, 2: 2.0, 3: 3.0}
    assert store.history(GROUP).filter("is_deleted").count() == 0
    external = FeatureStore(spark, str(tmp_path / "e"), put=lambda *_: None)
    with pytest.raises(ValidationError, match="external"):
        external.delete(gone(spark, (1, 1)), GROUP)
    external.delete(gone(spark, (1, 1)), GROUP, ["OfflineStore"])
    assert external.history(GROUP).count() == 1


def test_a_table_from_before_deletions_is_read(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), buckets=1)
    table = store.online(GROUP)
    table._point_to(0, "ignore")
    old = spark.createDataFrame([(1, "2024-01-01", 1.0, 0, 0)],
                                "id long, at string, v double, ledgerline_sequence long, ledgerline_bucket long")
    old.write.partitionBy("ledgerline_bucket").parquet(f"{tmp_path}/online/g/v=0")
    assert online(store) == {1: 1.0}
    store.delete(gone(spark, (1, 2)), GROUP)
    assert online(store) == {}
