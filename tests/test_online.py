import pytest
from pyspark.sql import functions as F

from ledgerline import (
    FeatureGroup,
    FeatureStore,
    OfflineStore,
    RecordIngestionError,
    ValidationError,
)
from ledgerline.functions.records import exploded_records, record_column
from ledgerline.operators.outcomes import failed_record_count, put_outcomes
from ledgerline.operators.partitions import bounded_repartition, parallelism
from groups_for_tests import ONE_VISIT, VISIT_SCHEMA, visits

GROUP = FeatureGroup(
    "people", "id", "at",
    (("id", "Integral"), ("at", "String"), ("n", "Integral"), ("x", "Fractional")),
    online=True, offline=OfflineStore(),
)
SCHEMA = "id bigint, at string, n bigint, x double"


def people(spark, n=40, partitions=4):
    return spark.range(0, n, numPartitions=partitions).select(
        "id", F.lit("2024-01-01T00:00:00Z").alias("at"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"), F.lit(1.5).alias("x"),
    )


def recording_put(folder):
    """A put that leaves one line per record in a file of its client."""

    def open_client():
        import uuid

        return open(f"{folder}/{uuid.uuid4().hex}", "a")

    def put(client, record, target):
        import json

        client.write(json.dumps([list(v.values()) for v in record]) + "\n")

    return put, open_client


def sent(folder):
    import json

    return [json.loads(line) for f in folder.iterdir() for line in f.read_text().splitlines()]


def failing(every, error=ValueError("test error")):
    def put(_, record, target):
        if int(record[0]["value_as_string"]) % every == 0:
            raise error

    return put


def test_record_holds_ordered_texts_without_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, "b", 100.0, True), (None, 2.5, None, 1e10, False)],
        "a bigint, b float, c string, d double, e boolean",
    )
    rows = [[tuple(p) for p in r[0]] for r in df.select(record_column(df.columns)).collect()]
    assert rows == [
        [("a", "1"), ("c", "b"), ("d", "100.0"), ("e", "true")],
        [("b", "2.5"), ("d", "1.0E10"), ("e", "false")],
    ]
    positions = exploded_records(df, "a").filter("a = 1").select("position").collect()
    assert [r[0] for r in positions] == [0, 1, 2, 3]


def test_one_put_with_exactly_the_record(spark, tmp_path):
    folder = tmp_path / "sent"
    folder.mkdir()
    put, open_client = recording_put(folder)
    store = FeatureStore(spark, str(tmp_path / "store"), put=put, open_client=open_client)
    store.ingest(spark.createDataFrame(ONE_VISIT, VISIT_SCHEMA), visits(), ["OnlineStore"])
    assert sent(folder) == [
        [["visitor", "guest 7"], ["seen-at", "2023-11-02T17:40:09Z"]]
    ]
    assert store.failed_records().count() == 0
    assert not (tmp_path / "store" / "offline").exists()


def test_failed_puts_are_kept_and_counted(spark, tmp_path):
    def put(client, record, target):
        raise RuntimeError("test error")

    store = FeatureStore(spark, str(tmp_path), put=put)
    assert store.failed_records() is None
    with pytest.raises(RecordIngestionError) as caught:
        store.ingest(spark.createDataFrame(ONE_VISIT, VISIT_SCHEMA), visits(), ["OnlineStore"])
    assert str(caught.value) == (
        "Stream ingestion finished, however 1 records failed to be ingested. "
        "Please inspect failed stream ingestion data frame for more info."
    )
    assert [tuple(r) for r in store.failed_records().collect()] == [(*ONE_VISIT[0], "test error")]


def test_outcomes_keep_rows_types_and_nulls(spark):
    outcomes = put_outcomes(people(spark), failing(10))
    assert outcomes.dtypes == people(spark).dtypes + [("online_ingestion_error", "string")]
    rows = {r["id"]: r for r in outcomes.collect()}
    assert len(rows) == 40 and rows[1]["n"] is None and rows[2]["n"] == 2
    failed = [i for i, r in rows.items() if r["online_ingestion_error"]]
    assert sorted(failed) == [0, 10, 20, 30]
    assert failed_record_count(outcomes).first()[0] == 4


def test_error_without_message_is_still_a_failure(spark):
    outcomes = put_outcomes(people(spark), failing(20, KeyError()))
    errors = {r[0] for r in outcomes.select("online_ingestion_error").collect()}
    assert errors == {None, "KeyError"}


def test_one_client_per_partition_and_no_second_put(spark, tmp_path):
    folder = tmp_path / "sent"
    folder.mkdir()
    put, open_client = recording_put(folder)
    store = FeatureStore(spark, str(tmp_path / "store"), put=put, open_client=open_client)
    store.ingest(people(spark), GROUP)
    assert len(sent(folder)) == 40 and len(list(folder.iterdir())) == 4
    store.failed_records().count()
    assert len(sent(folder)) == 40
    assert store.history(GROUP).count() == 40


def test_history_gets_what_the_put_accepted(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), put=failing(10))
    with pytest.raises(RecordIngestionError, match="4 records failed"):
        store.ingest(people(spark), GROUP, ["OnlineStore", "OfflineStore"])
    assert store.history(GROUP).count() == 36
    assert store.failed_records().count() == 4


def test_keyed_table_takes_valid_rows_and_keeps_the_others(spark, tmp_path):
    rows = [("1", "2024-01-01", "3.7", "1"), ("2", "never", "1", "1"), ("3", "2024-01-01", None, "x")]
    df = spark.createDataFrame(rows, "id string, at string, n string, x string")
    store = FeatureStore(spark, str(tmp_path), buckets=4)
    with pytest.raises(RecordIngestionError, match="2 records failed"):
        store.ingest(df, GROUP)
    assert [tuple(r) for r in store.online(GROUP).read().collect()] == [(1, "2024-01-01", 3, 1.0)]
    assert store.history(GROUP).count() == 1
    errors = {r["id"]: r["online_ingestion_error"] for r in store.failed_records().collect()}
    assert errors == {"2": "at not valid", "3": "x not valid"}
    store.ingest(df.filter("id = '1'"), GROUP, ["OfflineStore"])
    assert store.failed_records() is None


def test_nothing_failed(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), buckets=4)
    store.ingest(people(spark), GROUP, ["OnlineStore"])
    assert store.failed_records().count() == 0
    assert "online_ingestion_error" in store.failed_records().columns


def test_other_types_go_online_as_texts(spark, tmp_path):
    """A record holds texts, so only the offline path refuses a type as such."""
    group = FeatureGroup("f", "id", "at", (("id", "Integral"), ("at", "String"), ("b", "String")),
                         online=True, offline=OfflineStore())
    df = spark.sql("select 1 as id, date'2024-01-02' as at, true as b")
    store = FeatureStore(spark, str(tmp_path), buckets=4)
    store.ingest(df, group)
    assert tuple(store.online(group).read().first()) == (1, "2024-01-02", "true")
    with pytest.raises(ValidationError, match="unsupported data type"):
        store.ingest(df, group, ["OfflineStore"])


def test_every_row_faulty(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), buckets=4)
    df = people(spark).withColumn("at", F.lit("never"))
    with pytest.raises(RecordIngestionError, match="40 records failed"):
        store.ingest(df, GROUP, ["OnlineStore"])
    assert store.online(GROUP).read().count() == 0


def test_partitions_are_bounded(spark, conf):
    wide = parallelism(spark)
    conf("spark.sql.shuffle.partitions", str(wide * 2))
    for given, expected in [(1, wide), (wide, wide), (wide * 2, wide * 2), (wide * 2 + 1, wide)]:
        df = spark.range(0, 1000, numPartitions=given)
        out = bounded_repartition(df)
        assert out.rdd.getNumPartitions() == expected
        assert sorted(r[0] for r in out.collect()) == list(range(1000))


def test_joining_partitions_needs_no_shuffle(spark, plan):
    df = spark.range(0, 1000, numPartitions=50)
    assert "Exchange" not in plan(bounded_repartition(df))
    assert "Exchange" in plan(bounded_repartition(df, num_partitions=1))


def test_input_can_be_staged(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), buckets=4)
    random = people(spark).withColumn("x", F.rand())
    store.ingest(random, GROUP, stage_input=True)
    kept = store.history(GROUP).select("id", "x")
    assert kept.exceptAll(store.online(GROUP).read().select("id", "x")).count() == 0
