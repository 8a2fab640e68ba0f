"""Every row that goes in comes out of some store, and replays or other settings lose none."""

import pytest
from pyspark.sql import functions as F

from ledgerline import (
    FeatureGroup,
    FeatureStore,
    OfflineStore,
    RecordIngestionError,
    ValidationError,
)
from ledgerline.errors import FeatureStoreError
from ledgerline.operators.partitions import spread_for_puts
from ledgerline.operators.reconcile import reconcile
from ledgerline.sinks.keyed import KeyedTable
from ledgerline.streaming.ingest import _sequence_of, merge_stream

FEATURES = (("id", "Integral"), ("at", "String"), ("v", "Fractional"))
GROUP = FeatureGroup("g", "id", "at", FEATURES, online=True, offline=OfflineStore())
DATED = FeatureGroup("d", "id", "at", FEATURES, offline=OfflineStore("Iceberg"))
RAW = "id string, at string, v string"


def raw(spark, start=0, n=40):
    """Every fifth row is faulty; a third has one event time."""
    rows = [
        (str(i), "2024-01-01T00:00:00Z" if i % 3 else f"2024-02-{1 + i % 9:02}T05:00:00Z",
         "bad" if i % 5 == 2 else f"{i}.5")
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(rows, RAW)


def all_of(queries):
    for query in queries:
        query.awaitTermination()


def ids(df):
    return {int(r["id"]) for r in df.select("id").collect()}


def as_stream(spark, df, path):
    df.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


# Counts in and out of every sink ------------------------------------------------


def test_batch_into_both_stores(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    with pytest.raises(RecordIngestionError, match="8 records failed"):
        store.ingest(raw(spark), GROUP)
    kept = ids(store.online(GROUP).read())
    assert kept == ids(store.history(GROUP)) and kept.isdisjoint(ids(store.failed_records()))
    assert kept | ids(store.failed_records()) == set(range(40))


def test_merge_keeps_faulty_rows_once(spark, tmp_path):
    source, table = str(tmp_path / "in"), KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=4)
    for start in (0, 40):
        stream = as_stream(spark, raw(spark, start), source)
        all_of(merge_stream(stream, table, str(tmp_path / "q"), str(tmp_path / "c")))
    stream = spark.readStream.schema(RAW).parquet(source)
    all_of(merge_stream(stream, table, str(tmp_path / "q"), str(tmp_path / "c")))
    faulty = spark.read.parquet(str(tmp_path / "q"))
    assert faulty.count() == 16 and ids(faulty) | ids(table.read()) == set(range(80))
    assert {r[0] for r in faulty.select("dataTypeValidationErrors").collect()} == {"v not valid"}


@pytest.mark.parametrize("group", [GROUP, DATED], ids=["hours", "dates"])
def test_streams_and_batches_make_one_history(spark, tmp_path, group):
    store = FeatureStore(spark, str(tmp_path / "s"))
    store.ingest(raw(spark, 0, 40).filter("v <> 'bad'"), group, ["OfflineStore"])
    for name, start in (("one", 40), ("two", 80)):
        stream = as_stream(spark, raw(spark, start), str(tmp_path / name))
        all_of(store.ingest_stream(stream, group, name, ["OfflineStore"]))
    history = store.history(group)
    faulty = ids(store.quarantined(group, "one")) | ids(store.quarantined(group, "two"))
    left_out = {i for i in range(40) if i % 5 == 2}
    assert history.count() == 96 and ids(history) | faulty == set(range(120)) - left_out
    if group is DATED:
        dates = {r[0] for r in history.select("at_trunc").distinct().collect()}
        assert None not in dates and "2024-01-01" in dates


def test_stream_into_both_stores(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"), buckets=4)
    queries = store.ingest_stream(as_stream(spark, raw(spark), str(tmp_path / "in")), GROUP)
    all_of(queries)
    assert len(queries) == 3
    assert ids(store.online(GROUP).read()) == ids(store.history(GROUP))
    assert store.quarantined(GROUP).count() == 8
    assert ids(store.history(GROUP)) | ids(store.quarantined(GROUP)) == set(range(40))


def test_an_input_that_cannot_be_repeated_does_not_split_the_stores(spark, tmp_path):
    random = spark.range(200).select(
        F.col("id").cast("string").alias("id"),
        F.lit("2024-01-01T00:00:00Z").alias("at"),
        F.when(F.rand() < 0.5, "bad").otherwise(F.rand().cast("string")).alias("v"),
    )
    store = FeatureStore(spark, str(tmp_path))
    with pytest.raises(RecordIngestionError):
        store.ingest(random, GROUP)
    online = store.online(GROUP).read().select("id", "v")
    assert online.exceptAll(store.history(GROUP).select("id", "v")).count() == 0
    assert ids(online) | ids(store.failed_records()) == set(range(200))
    assert online.count() + store.failed_records().count() == 200


# The keyed table ------------------------------------------------------------------


def keyed(spark, tmp_path, buckets=None):
    return KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets)


def record(spark, i, v, at="2024-01-01"):
    return spark.createDataFrame([(i, at, v)], "id bigint, at string, v double")


def test_buckets_stay_with_the_table(spark, tmp_path):
    keyed(spark, tmp_path, 16).put(record(spark, 1, 1.0))
    assert keyed(spark, tmp_path).buckets == 16
    keyed(spark, tmp_path).put(record(spark, 2, 1.0))
    assert ids(keyed(spark, tmp_path, 16).read()) == {1, 2}
    with pytest.raises(FeatureStoreError, match="16 buckets, not 64"):
        keyed(spark, tmp_path, 64).put(record(spark, 3, 1.0))


def test_a_replay_after_another_put_changes_nothing(spark, tmp_path):
    table, folder = keyed(spark, tmp_path, 4), str(tmp_path / "sequences")
    for batch, value in ((0, 1.0), (1, 2.0), (0, 1.0)):
        table.put(record(spark, 1, value), _sequence_of(spark, folder, batch))
    assert table.read().first()["v"] == 2.0
    store = FeatureStore(spark, str(tmp_path / "s"))
    for sequence, value in ((1, "1"), (2, "2"), (1, "1")):
        row = spark.createDataFrame([("1", "2024-01-01", value)], RAW)
        store.ingest(row, GROUP, ["OnlineStore"], sequence=sequence)
    assert store.online(GROUP).read().first()["v"] == 2.0


def test_compaction_removes_old_versions_and_refuses_a_put(spark, tmp_path):
    table = keyed(spark, tmp_path, 4)
    for i in range(3):
        table.put(record(spark, i, 1.0))
        table.compact()
    assert {p.name for p in (tmp_path / "t").glob("v=*")} == {"v=2", "v=3"}
    assert ids(table.read()) == {0, 1, 2}
    with table._putting():
        with pytest.raises(FeatureStoreError, match="puts are under way"):
            table.compact()
    with table._compacting():
        with pytest.raises(FeatureStoreError, match="being compacted"):
            table.put(record(spark, 9, 1.0))
    (tmp_path / "t" / "_compacting").touch()
    table.unlock()
    table.put(record(spark, 9, 1.0))
    assert ids(table.read()) == {0, 1, 2, 9}


def test_an_identifier_wanted_often_is_one_row_of_the_join(spark, conf, tmp_path, plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = keyed(spark, tmp_path, 4)
    table.put(spark.range(50).selectExpr("id", "'2024-01-01' as at", "1.0D as v"))
    wanted = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 60))
    looked = table.lookup(wanted)
    assert ids(looked) == {i for i in range(50) if i % 3}
    # The distinct identifiers: combined before the shuffle that the join needs anyway.
    text = plan(looked).split("LeftSemi")[1]
    assert "functions=[]" in text and text.count("Exchange hashpartitioning") == 2


def test_rows_of_a_bucket_are_sorted_by_identifier(spark, tmp_path):
    table = keyed(spark, tmp_path, 2)
    table.put(spark.range(500, 0, -1).selectExpr("id", "'2024-01-01' as at", "1.0D as v"))
    for file in (tmp_path / "t" / "v=0").rglob("*.parquet"):
        found = [r["id"] for r in spark.read.parquet(str(file)).collect()]
        assert found == sorted(found)


# Puts -------------------------------------------------------------------------------


def test_a_put_knows_its_group_and_stores(spark, tmp_path):
    folder = tmp_path / "sent"
    folder.mkdir()

    def put(_, record, target):
        import json
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
            json.dump(target, file)

    store = FeatureStore(spark, str(tmp_path / "s"), put=put)
    other = FeatureGroup("other", "id", "at", FEATURES, online=True)
    good = raw(spark, 3, 1)
    store.ingest(good, GROUP)
    store.ingest(good, other, ["OnlineStore"])
    import json

    found = sorted((json.loads(f.read_text()) for f in folder.iterdir()), key=str)
    assert found == [
        {"group": "g", "target_stores": None},
        {"group": "other", "target_stores": ["OnlineStore"]},
    ]


def test_rows_can_be_checked_before_an_external_put(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), put=lambda _, record, target: None)
    store.ingest(raw(spark), GROUP, ["OnlineStore"])
    with pytest.raises(RecordIngestionError, match="8 records failed"):
        store.ingest(raw(spark), GROUP, ["OnlineStore"], check_records=True)


def test_spreading_for_puts_never_joins_partitions_nor_runs_what_is_above(spark, conf):
    conf("spark.sql.shuffle.partitions", "2")
    assert spread_for_puts(spark.range(0, 900, numPartitions=300)).rdd.getNumPartitions() == 300
    assert spread_for_puts(spark.range(0, 9, numPartitions=1)).rdd.getNumPartitions() == 4
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    shuffled = spark.range(100).mapInArrow(count, "id long").groupBy("id").count()
    out = spread_for_puts(shuffled)
    assert seen.value == 0 and out is shuffled


# Catalogue, formats, slices -----------------------------------------------------------


def test_a_named_catalogue_has_to_be_configured(spark, tmp_path):
    group = FeatureGroup("l", "id", "at", FEATURES, offline=OfflineStore("Iceberg", catalog="Lake",
                         database="d", table="t"))
    store = FeatureStore(spark, str(tmp_path))
    for call in (lambda: store.ingest(raw(spark, 3, 1), group), lambda: store.history(group)):
        with pytest.raises(ValidationError, match="does not configure"):
            call()
    assert not (tmp_path / "offline").exists()


def test_registering_again_replaces(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    store.register(GROUP, DATED)
    changed = FeatureGroup("g", "id", "at", FEATURES[:2], online=True)
    store.register(changed)
    assert store.group("g") == changed and store.group("d") == DATED
    assert store.catalog().count() == 2
    with pytest.raises(ValidationError, match="registered twice"):
        store.register(GROUP, GROUP)


def test_slices_leave_no_scratch_after_an_error(spark, monkeypatch, tmp_path):
    shared = tmp_path / "shared" / "ledgerline"
    monkeypatch.setattr(
        "ledgerline.plans.store.scratch_dir", lambda _, purpose: str(shared / purpose)
    )
    store = FeatureStore(spark, str(tmp_path / "s"))
    monkeypatch.setattr(store, "_ingest_history", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.ingest_by_time(raw(spark).filter("v <> 'bad'"), GROUP, "day", ["OfflineStore"])
    assert list(shared.iterdir()) == []


def test_many_failing_slices_are_one_folder(spark, tmp_path, plan):
    rows = [(str(i), f"2024-{1 + i // 28:02}-{1 + i % 28:02}", "bad") for i in range(60)]
    store = FeatureStore(spark, str(tmp_path), put=lambda _, record, target: 1 / 0)
    with pytest.raises(RecordIngestionError, match="60 records failed"):
        store.ingest_by_time(spark.createDataFrame(rows, RAW), GROUP, "day", ["OnlineStore"])
    assert len(list((tmp_path / "failures" / "g").iterdir())) == 1
    assert "Union" not in plan(store.failed_records()) and store.failed_records().count() == 60


# Reconciliation over types --------------------------------------------------------------


@pytest.mark.parametrize("exact", [False, True])
def test_types_that_widen_are_unchanged(spark, exact):
    kinds = {"byte": "long", "short": "long", "int": "long", "long": "long", "float": "double",
             "double": "double", "string": "string"}
    for given, stored in kinds.items():
        sent = spark.range(10).select("id", F.col("id").cast(given).alias("v"))
        kept = sent.withColumn("v", F.col("v").cast(stored))
        assert tuple(reconcile(sent, kept, "id", exact).first()) == (10, 10, 0, 0, 0, 0)
    sent = spark.range(10).select(F.col("id").cast("int").alias("id"), F.lit(0.1).cast("float").alias("v"))
    kept = sent.select(F.col("id").cast("long").alias("id"), F.lit(0.1).alias("v"))
    assert reconcile(sent, kept, "id", exact).first()["n_changed"] == 10


def test_a_merge_stream_waits_for_a_compaction(spark, tmp_path):
    table = keyed(spark, tmp_path, 4)
    table.put(record(spark, 99, 1.0))
    stream = as_stream(spark, raw(spark), str(tmp_path / "in"))
    with table._compacting():
        queries = merge_stream(stream, table, str(tmp_path / "q"), str(tmp_path / "c"))
        queries[1].awaitTermination()
        assert not queries[0].awaitTermination(3) and queries[0].exception() is None
        with pytest.raises(FeatureStoreError, match="being compacted"):
            table.put(record(spark, 98, 1.0), wait=1)
    all_of(queries)
    assert ids(table.read()) == {99} | {i for i in range(40) if i % 5 != 2}


def test_names_of_columns_do_not_look_like_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(10).selectExpr("id", "1 as Exchange", "2 as InMemoryTableScan").coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    assert spread_for_puts(one).rdd.getNumPartitions() == 4
    assert spread_for_puts(one.groupBy("id").count()).columns == ["id", "count"]
    cached = spark.read.parquet(path).cache()
    assert spread_for_puts(cached) is cached
    cached.unpersist()


def test_sequence_zero_is_a_sequence(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "s"))
    for sequence, value in ((5, "5"), (0, "0")):
        row = spark.createDataFrame([("1", "2024-01-01", value)], RAW)
        store.ingest(row, GROUP, ["OnlineStore"], sequence=sequence)
    assert store.online(GROUP).read().first()["v"] == 5.0
