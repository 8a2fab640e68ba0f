import random

import pytest
from pyspark.sql import functions as F

from ledgerline import FeatureGroup
from ledgerline.operators.latest import latest_per_record
from ledgerline.sinks.keyed import KeyedTable

GROUP = FeatureGroup(
    "k", "id", "at", (("id", "Integral"), ("at", "Fractional"), ("seq", "Integral"), ("v", "String"))
)
TEXT_TIME = FeatureGroup("t", "id", "at", (("id", "String"), ("at", "String"), ("v", "String")))
SCHEMA = "id bigint, at double, seq bigint, v string"


def random_rows(n, seed, keys=30):
    """A third of the rows has one identifier."""
    rng = random.Random(seed)
    return [
        (0 if rng.random() < 0.33 else rng.randrange(keys), float(rng.randrange(50)), i,
         rng.choice(["a", "b", None]))
        for i in range(n)
    ]


def brute_force(rows):
    best = {}
    for row in rows:
        if row[0] not in best or (row[1], row[2]) > (best[row[0]][1], best[row[0]][2]):
            best[row[0]] = row
    return set(best.values())


def test_latest_against_brute_force(spark):
    rows = random_rows(3000, 1)
    out = latest_per_record(spark.createDataFrame(rows, SCHEMA).repartition(6), GROUP, "seq")
    assert out.columns == ["id", "at", "seq", "v"]
    assert {tuple(r) for r in out.collect()} == brute_force(rows)


def test_latest_combines_before_the_shuffle(spark, plan):
    df = spark.createDataFrame(random_rows(10, 1), SCHEMA)
    text = plan(latest_per_record(df, GROUP))
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_text_event_times_compare_as_times(spark):
    rows = [("a", "2024-01-01T10:00:00+02:00", "early"), ("a", "2024-01-01T09:00:00Z", "late")]
    out = latest_per_record(spark.createDataFrame(rows, "id string, at string, v string"), TEXT_TIME)
    assert out.first()["v"] == "late"


def test_puts_merge_and_replay_changes_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=4)
    first, second = random_rows(500, 2), random_rows(500, 3)
    second = [(r[0], r[1], r[2] + 500, r[3]) for r in second]
    for rows in (first, second, first):
        table.put(spark.createDataFrame(rows, SCHEMA), sequence="seq")
    expected = brute_force(first + second)
    assert {tuple(r) for r in table.read().collect()} == expected
    table.compact()
    assert table.version() == 1
    assert {tuple(r) for r in table.read().collect()} == expected
    assert table._log().count() == len(expected)
    table.put(spark.createDataFrame([(0, 99.0, 9999, "new")], SCHEMA), sequence="seq")
    assert {tuple(r) for r in table.get(0).collect()} == {(0, 99.0, 9999, "new")}


def test_equal_event_times_are_decided_by_the_put(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=4)
    for sequence, value in [(2, "second"), (1, "first")]:
        table.put(spark.createDataFrame([(1, 5.0, 0, value)], SCHEMA), sequence)
    assert table.read().first()["v"] == "second"


def test_put_takes_a_subset_of_the_features(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=4)
    table.put(spark.createDataFrame([(5.0, 1)], "at double, id bigint"))
    assert tuple(table.read().first()) == (1, 5.0, None, None)


def test_lookups(spark, tmp_path, plan):
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=8)
    rows = random_rows(2000, 4, keys=200)
    table.put(spark.createDataFrame(rows, SCHEMA), sequence="seq")
    expected = brute_force(rows)
    one = table.get(7)
    assert {tuple(r) for r in one.collect()} == {r for r in expected if r[0] == 7}
    assert "ledgerline_bucket" in plan(one).split("PartitionFilters:")[1].split("]")[0]
    ids = spark.createDataFrame([(i,) for i in (1, 1, 2, 500)], "wanted bigint")
    found = {tuple(r) for r in table.lookup(ids).collect()}
    assert found == {r for r in expected if r[0] in (1, 2)}


def test_lookup_without_broadcast_shuffles_once_per_side(spark, conf, tmp_path, plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=4)
    table.put(spark.createDataFrame(random_rows(300, 5), SCHEMA), sequence="seq")
    looked = table.lookup(spark.range(5).select(F.col("id")))
    assert plan(looked).count("Exchange hashpartitioning") == 2
    assert looked.count() == 5


def scanned_rows(df):
    """How many rows the scans of a frame gave, once it has been collected."""
    df.collect()
    total, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif name == "FileSourceScanExec":
            total += plan.metrics().apply("numOutputRows").value()
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return total


def test_a_get_reads_few_row_groups_of_many_puts(spark, tmp_path):
    """Each put spans all identifiers; only one holds the wanted one."""
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=1)
    puts = 30
    for k in range(puts):
        ids = spark.range(k, 6000 * puts, puts).select(
            "id", F.lit(1.0).alias("at"), F.lit(0).cast("long").alias("seq"), F.lit("v").alias("v")
        )
        table.put(ids.coalesce(1))
    one = table.get(puts * 17 + 3)
    assert scanned_rows(one) <= 2 * 6000
    assert [r["id"] for r in one.collect()] == [puts * 17 + 3]
    assert scanned_rows(table.get(-5)) <= 6000 and table.get(-5).collect() == []
    sizes = [f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet") if "v=" in str(f)]
    assert max(sizes) < 200_000


def bucket_files(path):
    out = {}
    for f in path.rglob("*.parquet"):
        if "v=" in str(f):
            out.setdefault(f.parent.name, set()).add(f.name)
    return out


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=8)
    rows = random_rows(800, 5)
    table.put(spark.createDataFrame(rows, SCHEMA), sequence="seq")
    # A single put leaves nothing to do.
    before = bucket_files(tmp_path / "t")
    assert table.compact_touched() == 0 and bucket_files(tmp_path / "t") == before
    more = [(0, 99.0, 9001, "new"), (1, 99.0, 9002, "new"), (0, -1.0, 9003, "old")]
    for row in more:
        table.put(spark.createDataFrame([row], SCHEMA), sequence="seq")
    touched = {b for b, f in bucket_files(tmp_path / "t").items() if f != before.get(b)}
    assert table.compact_touched() == len(touched) <= 2
    after = bucket_files(tmp_path / "t")
    assert all(after[b] == before[b] for b in set(before) - touched)
    assert all(not after[b] & before[b] for b in touched)
    assert {tuple(r) for r in table.read().collect()} == brute_force(rows + more)
    assert table._log().count() == len(brute_force(rows + more))
    assert table.compact_touched() == 0 and table.version() == 0
    table.compact()
    assert table.compact_touched() == 0
    assert {tuple(r) for r in table.read().collect()} == brute_force(rows + more)


def test_a_hot_bucket_of_several_files_is_not_touched(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    table = KeyedTable(spark, str(tmp_path / "t"), GROUP, buckets=1)
    table.put(spark.range(20000).selectExpr("id", "1.0D as at", "id as seq", "uuid() as v"))
    assert len(next(iter(bucket_files(tmp_path / "t").values()))) > 1
    assert table.compact_touched() == 0
