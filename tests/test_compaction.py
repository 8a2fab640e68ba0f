"""Small files of a history are packed; rows, large files and other folders stay as they are."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgerline import FeatureGroup, FeatureStore, OfflineStore
from ledgerline.errors import FeatureStoreError
from ledgerline.sinks import compaction
from ledgerline.sinks.compaction import compact_history, finish_compaction, packed

FEATURES = (("id", "Integral"), ("at", "Fractional"), ("v", "String"))
HOURS = FeatureGroup("g", "id", "at", FEATURES, offline=OfflineStore())
DATES = FeatureGroup("d", "id", "at", FEATURES, offline=OfflineStore("Iceberg"))
SCHEMA = "id long, at double, v string"
MEGABYTE = 2**20


@pytest.fixture(params=[HOURS, DATES], ids=["hours", "dates"])
def history(request, spark, tmp_path):
    """Five batches of three hours (or days); one hour has one batch only."""
    group, store = request.param, FeatureStore(spark, str(tmp_path))
    for batch in range(5):
        rows = [
            (100 * batch + i, 90000.0 * (i % 3) + 7 * i, f"v{i}")
            for i in range(30)
            if batch == 2 or i % 3 != 1
        ]
        store.ingest(spark.createDataFrame(rows, SCHEMA).coalesce(1), group)
    return store, group, tmp_path / "offline" / group.name


def files(path):
    return sorted(str(f.relative_to(path)) for f in path.rglob("*.parquet"))


def content(store, group):
    return sorted(map(tuple, store.history(group).collect()), key=repr)


def test_rows_stay_and_files_are_packed(history):
    store, group, path = history
    rows, before = content(store, group), files(path)
    assert len(before) == 11 and store.compact_history(group) == (10, 2)
    after = files(path)
    assert content(store, group) == rows and len(after) == 3
    # The folder with one file keeps it.
    assert len(set(before) & set(after)) == 1
    assert store.compact_history(group) == (0, 0) and files(path) == after


def test_files_of_half_the_size_stay(history):
    store, group, path = history
    sizes = sorted(f.stat().st_size for f in path.rglob("*.parquet"))
    before = files(path)
    assert store.compact_history(group, target=2 * sizes[0]) == (0, 0) and files(path) == before


def test_a_date_is_sorted_within_its_files(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    for batch in range(3):
        rows = [(i, float(1000 - 7 * i - batch), "v") for i in range(20)]
        store.ingest(spark.createDataFrame(rows, SCHEMA).coalesce(1), DATES)
    assert store.compact_history(DATES) == (3, 1)
    (file,) = (tmp_path / "offline" / "d").rglob("*.parquet")
    times = [r["at"] for r in spark.read.parquet(str(file)).collect()]
    assert times == sorted(times)


@pytest.mark.parametrize("cut", range(6))
def test_a_compaction_that_was_cut_off_is_finished(history, spark, monkeypatch, cut):
    store, group, path = history
    rows, before = content(store, group), files(path)
    move, left = compaction._Folder.move, [cut]

    def failing(self, *args):
        if not left[0]:
            raise ConnectionError("cut off")
        left[0] -= 1
        move(self, *args)

    monkeypatch.setattr(compaction._Folder, "move", failing)
    with pytest.raises(ConnectionError):
        compact_history(spark, group, str(path))
    monkeypatch.undo()
    finish_compaction(spark, str(path))
    assert content(store, group) == rows
    assert (files(path) == before) == (cut == 0)
    assert not [p for p in path.iterdir() if p.name.startswith("_")]
    finish_compaction(spark, str(path))


def test_a_stream_and_an_empty_history(spark, tmp_path):
    (tmp_path / "s" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(FeatureStoreError, match="stream"):
        compact_history(spark, HOURS, str(tmp_path / "s"))
    (tmp_path / "e").mkdir()
    assert compact_history(spark, HOURS, str(tmp_path / "e")) == (0, 0)


@given(st.dictionaries(st.integers(), st.integers(1, 49), max_size=60))
def test_bins_hold_what_fits(sizes):
    sizes = {str(k): v for k, v in sizes.items()}
    bins = packed(sizes, 100)
    names = [n for b in bins for n in b]
    assert len(names) == len(set(names)) and set(names) <= set(sizes)
    assert all(len(b) > 1 and sum(sizes[n] for n in b) <= 100 for b in bins)
    # What is left out would not fit together either, beyond one file.
    assert sum(v for k, v in sizes.items() if k not in names) <= 100
    assert len(bins) <= 1 + 2 * sum(sizes.values()) / 100
