import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline import FeatureGroup, FeatureStore, OfflineStore, ValidationError
from ledgerline.functions.history import AUDIT_COLUMNS, hour_columns
from ledgerline.sinks import history as sink
from ledgerline.sources.history import read_date, read_dates, read_hour, read_hours, table_name
from groups_for_tests import ONE_VISIT, VISIT_SCHEMA, visits

GROUP = FeatureGroup(
    name="points",
    record_identifier="id",
    event_time="at",
    features=(("id", "Integral"), ("at", "String"), ("x", "Fractional")),
    offline=OfflineStore("Hive"),
)


def files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


@pytest.fixture()
def points(spark):
    """Three hours over two days; one hour holds most rows."""
    hour = F.when(F.col("id") % 10 < 8, "2024-01-02T03").when(
        F.col("id") % 10 == 8, "2024-01-02T04"
    ).otherwise(F.lit("2024-01-03T03"))
    return spark.range(0, 20000, numPartitions=8).select(
        "id", F.concat(hour, F.lit(":15:00Z")).alias("at"), F.rand(1).alias("x")
    )


@pytest.mark.parametrize("table_format", ["Hive", None])
def test_one_record_round_trip(spark, tmp_path, table_format):
    group = visits(table_format=table_format)
    store = FeatureStore(spark, str(tmp_path))
    df = spark.createDataFrame(ONE_VISIT, VISIT_SCHEMA)
    store.ingest(df, group, ["OfflineStore"])
    row = store.history(group).first()
    assert (row["visitor"], row["seen-at"]) == ONE_VISIT[0]
    assert all(row[c] is not None for c in AUDIT_COLUMNS) and row["is_deleted"] is False
    assert row["write_time"] == row["api_invocation_time"]
    assert (row["year"], row["month"], row["day"], row["hour"]) == ("2023", "11", "02", "17")
    assert os.path.isdir(
        tmp_path / "offline" / "visits" / "year=2023" / "month=11" / "day=02" / "hour=17"
    )


def test_date_layout_and_append(spark, tmp_path, points):
    path = str(tmp_path / "h")
    sink.append_dates(points, GROUP, path)
    sink.append_dates(points.filter("id < 10"), GROUP, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [
        "at_trunc=2024-01-02", "at_trunc=2024-01-03"
    ]
    assert read_dates(spark, GROUP, path).count() == 20010
    day = read_date(spark, GROUP, path, "2024-01-03")
    assert day.count() == 2001
    for file in files(path):
        times = pq.read_table(file, partitioning=None).column("at").to_pylist()
        assert times == sorted(times)


def test_date_of_a_numeric_event_time(spark, tmp_path):
    group = FeatureGroup("n", "id", "at", (("id", "Integral"), ("at", "Fractional")),
                         offline=OfflineStore("Iceberg"))
    store = FeatureStore(spark, str(tmp_path))
    store.ingest(spark.createDataFrame([(1, 1631091971.5)], "id bigint, at double"), group)
    assert store.history(group).first()["at_trunc"] == "2021-09-08"


def test_files_are_plain_and_unmarked(spark, tmp_path, points):
    path = str(tmp_path / "h")
    sink.append_hours(points, GROUP, path)
    names = [n for _, _, found in os.walk(path) for n in found]
    assert not any(n.startswith(("_SUCCESS", "_metadata", "_common_metadata")) for n in names)
    for file in files(path):
        meta = pq.ParquetFile(file).metadata
        assert meta.row_group(0).column(0).compression == "UNCOMPRESSED"


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_hot_hour_is_split_and_whole(spark, conf, tmp_path, points, aqe):
    conf("spark.sql.adaptive.enabled", aqe)
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40KB")
    path = str(tmp_path / "h")
    sink.append_hours(points, GROUP, path)
    hot = files(f"{path}/year=2024/month=01/day=02/hour=03")
    assert len(hot) > 1
    stored = read_hours(spark, GROUP, path)
    assert stored.count() == 20000 and stored.select("id").distinct().count() == 20000
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in hot]
    assert sum(sizes) == 16000 and max(sizes) < 16000 * 0.7


def test_one_shuffle_and_its_kind(spark, conf, points, plan):
    adaptive = plan(sink.cluster_by(points, ["at"]))
    assert adaptive.count("Exchange") == 1 and "REBALANCE_PARTITIONS_BY_COL" in adaptive
    conf("spark.sql.adaptive.enabled", "false")
    static = plan(sink.cluster_by(points, ["at"]))
    assert static.count("Exchange") == 1 and "rangepartitioning" in static


@pytest.mark.parametrize("append", [sink.append_hours, sink.append_dates])
def test_clustered_input_is_not_shuffled(spark, tmp_path, points, append, monkeypatch):
    monkeypatch.setattr(sink, "cluster_by", lambda *_: pytest.fail("shuffled"))
    append(points, GROUP, str(tmp_path / "h"), clustered=True)
    assert spark.read.parquet(str(tmp_path / "h")).count() == 20000


def test_date_layout_splits_a_hot_date(spark, conf, tmp_path, points):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40KB")
    path = str(tmp_path / "h")
    sink.append_dates(points, GROUP, path)
    assert len(files(f"{path}/at_trunc=2024-01-02")) > 1
    assert read_dates(spark, GROUP, path).count() == 20000


def test_reading_one_hour_touches_its_directory_only(spark, tmp_path, points, plan):
    path = str(tmp_path / "h")
    sink.append_hours(points, GROUP, path)
    hour = read_hour(spark, GROUP, path, "2024", "01", "02", "04")
    assert hour.count() == 2000 and set(hour.dtypes) >= {("month", "string"), ("hour", "string")}
    assert all("hour=04" in f for f in hour.inputFiles())
    assert read_hour(spark, GROUP, path, "2024", "01", "02", "05").count() == 0
    pruned = read_hours(spark, GROUP, path).filter("year = '2024' and hour = '04'")
    assert pruned.count() == 2000
    assert "PartitionFilters: [isnotnull(year" in plan(pruned.select("id"))


def test_subset_of_features_in_another_order(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    store.ingest(
        spark.createDataFrame([("2024-01-01", "5")], "at string, id string"), GROUP
    )
    row = store.history(GROUP).first()
    assert (row["id"], row["at"], row["x"]) == (5, "2024-01-01", None)


def test_nothing_is_written_when_one_row_is_invalid(spark, tmp_path, points):
    store = FeatureStore(spark, str(tmp_path))
    bad = points.withColumn("x", F.when(F.col("id") == 7, float("nan")).otherwise(F.col("x")))
    with pytest.raises(ValidationError) as caught:
        store.ingest(bad, GROUP, ["OfflineStore"])
    assert "records values equal to NaN" in str(caught.value)
    assert [tuple(r) for r in caught.value.report] == [(7, "x not valid")]
    assert not (tmp_path / "offline").exists()


def test_unknown_table_format_is_refused(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    df = spark.createDataFrame(ONE_VISIT, VISIT_SCHEMA)
    for stores in (["OfflineStore"], None):
        with pytest.raises(ValueError, match="Table format 'Other' is not supported"):
            store.ingest(df, visits(table_format="Other"), stores)


def test_date_column_may_not_be_a_feature(spark, tmp_path):
    group = FeatureGroup("g", "id", "at", (("id", "String"), ("at", "String"), ("at_trunc", "String")),
                         offline=OfflineStore("Iceberg"))
    df = spark.createDataFrame([("1", "2024-01-01")], "id string, at string")
    with pytest.raises(ValidationError, match="reserved feature name 'at_trunc'"):
        FeatureStore(spark, str(tmp_path)).ingest(df, group)


def test_offline_store_has_to_be_enabled(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    df = spark.createDataFrame(ONE_VISIT, VISIT_SCHEMA)
    with pytest.raises(ValidationError, match="OfflineStore of FeatureGroup: 'visits' is not"):
        store.ingest(df, visits(online=None, offline=False))


def test_table_append_goes_to_the_lower_case_table(spark, conf, monkeypatch):
    """No v2 catalogue is at hand, so the writer is recorded instead of run."""
    group = visits(table_format="Iceberg", catalog="Lake", database="Db", table="My-Table")
    conf("spark.sql.catalog.lake", "some.CatalogClass")
    calls = []

    class Writer:
        def option(self, *args):
            calls.append(args)
            return self

        def append(self):
            calls.append("append")

    df = spark.createDataFrame(ONE_VISIT, VISIT_SCHEMA)
    monkeypatch.setattr(type(df), "writeTo", lambda self, name: calls.append(name) or Writer())
    sink.append_history(df, group, "unused")
    assert calls == ["lake.db.`my-table`", ("compression", "none"), "append"]
    assert table_name(group.offline) == "lake.db.`my-table`"


def test_hour_columns_are_padded_texts(spark):
    df = spark.createDataFrame([(1704207600,), (0,), (-62135596800,)], "s bigint").select(
        *hour_columns(F.timestamp_seconds("s")).values()
    )
    assert [tuple(r) for r in df.collect()] == [
        ("2024", "01", "02", "15"), ("1970", "01", "01", "00"), ("0001", "01", "01", "00")
    ]
