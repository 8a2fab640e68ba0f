"""Reads of a range of event time: the right rows, from no other folders."""

import re
from datetime import UTC, date, datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline import FeatureGroup, FeatureStore, OfflineStore
from ledgerline.sources.history import covering_folders, moment, read_range

NUMBERS = (("id", "Integral"), ("at", "Fractional"))
TEXTS = (("id", "Integral"), ("at", "String"))
GROUPS = {
    "hours of numbers": FeatureGroup("a", "id", "at", NUMBERS, offline=OfflineStore()),
    "hours of texts": FeatureGroup("b", "id", "at", TEXTS, offline=OfflineStore()),
    "dates of numbers": FeatureGroup("c", "id", "at", NUMBERS, offline=OfflineStore("Iceberg")),
    "dates of texts": FeatureGroup("e", "id", "at", TEXTS, offline=OfflineStore("Iceberg")),
}
BEGIN = datetime(2023, 12, 30, tzinfo=UTC)


def times(n=400):
    """Every 97 minutes from the end of a year on, some on the hour, some at midnight."""
    out = [BEGIN + timedelta(minutes=97 * i) for i in range(n)]
    return out + [BEGIN + timedelta(hours=i) for i in (0, 23, 24, 48, 72)]


def as_text(i, value):
    """The same time in the form of some zone, or a form whose date is no date."""
    if i % 7 == 0 and value.minute == 0 and value.hour == 0 and value.day < 10:
        return f"{value.year}-{value.month}-{value.day}"
    zone = timezone(timedelta(hours=(-12, -5, 0, 0, 9, 14)[i % 6]))
    return value.astimezone(zone).isoformat()


@pytest.fixture(scope="module", params=GROUPS)
def store(request, spark, tmp_path_factory):
    group = GROUPS[request.param]
    store = FeatureStore(spark, str(tmp_path_factory.mktemp("ranges")))
    texts = group.feature_types["at"] == "String"
    rows = [(i, as_text(i, t) if texts else t.timestamp()) for i, t in enumerate(times())]
    store.ingest(spark.createDataFrame(rows, "id long, at " + ("string" if texts else "double")), group)
    return store, group


RANGES = [
    ("2024-01-01", "2024-01-08"),
    ("2023-12-31T23:59:59.999999Z", "2024-01-01T00:00:00.000001Z"),
    ("2024-01-02T03:20:00Z", "2024-01-02T03:40:00Z"),
    ("2024-01-02T03:20:00+09:00", "2024-01-12T17:01:00-05:00"),
    ("2023-12-30T05:00:00", "2023-12-30T06:00:00"),
    ("2023-01-01", "2030-01-01"),
    ("2024-01-03T12:00:00Z", "2024-01-02T12:00:00Z"),
    ("2024-01-03", "2024-01-03"),
    ("2031-01-01", "2032-01-01"),
    ("0001-01-01", "9999-12-31T23:59:59.999999"),
]


@pytest.mark.parametrize("start, end", RANGES)
def test_range_equals_a_filter(store, start, end):
    store, group = store
    wanted = [
        i
        for i, t in enumerate(times())
        if moment(start) <= t.replace(tzinfo=None) < moment(end)
    ]
    rows = store.history_between(group, start, end)
    assert sorted(r["id"] for r in rows.collect()) == wanted


def scanned(df):
    """The files that a frame reads, and its physical plan as text."""
    return df.inputFiles(), df._jdf.queryExecution().executedPlan().toString()


def test_only_covering_hours_are_read(spark, tmp_path):
    store, group = FeatureStore(spark, str(tmp_path)), GROUPS["hours of numbers"]
    rows = [(i, t.timestamp()) for i, t in enumerate(times())]
    store.ingest(spark.createDataFrame(rows, "id long, at double"), group)
    whole = store.history_between(group, "2024-01-02T04:00:00Z", "2024-01-04T02:00:00Z")
    files, plan = scanned(whole)
    hours = {
        datetime(*map(int, re.search(r"year=(\d+)/month=(\d+)/day=(\d+)/hour=(\d+)", f).groups()))
        for f in files
    }
    assert min(hours) >= datetime(2024, 1, 2, 4) and max(hours) < datetime(2024, 1, 4, 2)
    # On the hour at both ends, no row is compared.
    assert not re.search(r"\bFilter\b", plan)
    cut, plan = scanned(store.history_between(group, "2024-01-02T04:10:00Z", "2024-01-04T02:00:00Z"))
    assert re.search(r"\bFilter\b", plan) and set(cut) <= set(files)


def test_only_covering_dates_are_read(spark, tmp_path):
    store, group = FeatureStore(spark, str(tmp_path)), GROUPS["dates of numbers"]
    rows = [(i, t.timestamp()) for i, t in enumerate(times())]
    store.ingest(spark.createDataFrame(rows, "id long, at double"), group)
    df = store.history_between(group, "2024-01-02T04:00:00Z", "2024-01-04T02:00:00Z")
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.collect()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(at_trunc" in scan
    read = {r["at_trunc"] for r in df.select("at_trunc").distinct().collect()}
    assert read == {"2024-01-02", "2024-01-03", "2024-01-04"}


@settings(max_examples=300, deadline=None)
@given(
    st.datetimes(datetime(2019, 1, 1), datetime(2026, 1, 1)),
    st.timedeltas(timedelta(0), timedelta(days=900)),
)
def test_folders_cover_each_hour_once(start, length):
    end = start + length
    first = start.replace(minute=0, second=0, microsecond=0)
    folders, covered = covering_folders(start, end), []
    now = first
    for folder in folders:
        values = [int(part.split("=")[1]) for part in folder.split("/")]
        assert datetime(*(values + [1, 1, 0][len(values) - 1 :])[:4]) == now
        step = ["year", "month", "day", "hour"][len(values) - 1]
        if step == "year":
            now = now.replace(year=now.year + 1)
        elif step == "month":
            now = now.replace(year=now.year + now.month // 12, month=now.month % 12 + 1)
        else:
            now += timedelta(days=1) if step == "day" else timedelta(hours=1)
        covered.append(now)
    assert now >= end and now - end < timedelta(hours=1) or start == end
    assert len(folders) < 150


def test_times_are_utc_unless_they_say_otherwise():
    noon = datetime(2024, 1, 1, 12)
    for value in (noon, noon.replace(tzinfo=UTC), "2024-01-01T12:00:00", "2024-01-01T14:00:00+02:00"):
        assert moment(value) == noon
    assert moment(date(2024, 1, 1)) == datetime(2024, 1, 1)


def test_missing_history_and_hour(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_range(
            spark, GROUPS["hours of texts"], str(tmp_path / "no"), "2024-01-01", "2024-01-02"
        ).collect()


def test_streams_are_part_of_a_range(spark, tmp_path):
    store, group = FeatureStore(spark, str(tmp_path / "s")), GROUPS["hours of texts"]
    rows = spark.createDataFrame([(i, f"2024-01-0{1 + i}T10:00:00Z") for i in range(5)], "id long, at string")
    store.ingest(rows, group)
    rows.withColumn("id", rows.id + 10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for query in store.ingest_stream(stream, group):
        query.awaitTermination()
    found = store.history_between(group, "2024-01-02T10:00:00Z", "2024-01-04T10:00:00Z")
    assert sorted(r["id"] for r in found.collect()) == [1, 2, 11, 12]


def test_streams_lie_beside_the_path_of_a_group(spark, tmp_path):
    group = FeatureGroup("b", "id", "at", TEXTS, offline=OfflineStore(path=str(tmp_path / "h")))
    rows = spark.createDataFrame([(1, "2024-01-01")], "id long, at string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for query in FeatureStore(spark, str(tmp_path / "one")).ingest_stream(stream, group):
        query.awaitTermination()
    other = FeatureStore(spark, str(tmp_path / "two"))
    other.ingest(rows.withColumn("id", rows.id + 1), group)
    assert sorted(r["id"] for r in other.history(group).collect()) == [1, 2]
