"""Records that a stream has sent and another has not stored, each reported once."""

from ledgerline import FeatureGroup, OfflineStore
from ledgerline.streaming.missing import missing_stream

FEATURES = (("id", "Integral"), ("at", "Fractional"), ("v", "String"))
GROUP = FeatureGroup("g", "id", "at", FEATURES, offline=OfflineStore())
SCHEMA = "id long, at double, v string"
HOUR = 3600.0


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(path)


def run(spark, tmp_path, delay="1 hour"):
    sent, stored = (spark.readStream.schema(SCHEMA).parquet(str(tmp_path / s)) for s in ("sent", "stored"))
    out = str(tmp_path / "missing")
    missing_stream(sent, stored, GROUP, out, str(tmp_path / "c"), delay).awaitTermination()
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(out).collect()))


def hours(first, last, without=()):
    return [(i, HOUR * i, f"v{i}") for i in range(first, last) if i not in without]


def test_missing_records_once_over_restarts(spark, tmp_path):
    add(spark, str(tmp_path / "sent"), hours(0, 20))
    add(spark, str(tmp_path / "stored"), hours(0, 20, {3, 7, 19}))
    # The latest time stored is that of 18: what is older than 17 is judged.
    assert run(spark, tmp_path) == hours(3, 4) + hours(7, 8)
    assert run(spark, tmp_path) == hours(3, 4) + hours(7, 8)
    # 19 is stored late but in time; 23 is not.
    add(spark, str(tmp_path / "sent"), hours(20, 40))
    add(spark, str(tmp_path / "stored"), hours(19, 40, {23}))
    assert run(spark, tmp_path) == hours(3, 4) + hours(7, 8) + hours(23, 24)


def test_one_identifier_at_many_times_and_many_rows_of_one(spark, tmp_path):
    sent = [(1, HOUR * i, "a") for i in range(10)] + [(2, HOUR * 2, "b")] * 3
    add(spark, str(tmp_path / "sent"), sent)
    add(spark, str(tmp_path / "stored"), [(1, HOUR * i, "other") for i in range(10) if i != 4] * 2)
    assert run(spark, tmp_path) == [(1, HOUR * 4, "a")] + [(2, HOUR * 2, "b")] * 3
