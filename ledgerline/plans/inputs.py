"""The given tables as feature data, with the groups they belong to."""

from pyspark.sql import functions as F

from ledgerline.groups import HOUR_FORMAT, TABLE_FORMAT, FeatureGroup, OfflineStore
from ledgerline.session import pin_utc

# Prices above it are given as a word in ``raw_parts``.
DEAR = 50000
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"

EVENTS = FeatureGroup(
    name="events",
    record_identifier="event_id",
    event_time="event_time",
    features=(
        ("event_id", "Integral"),
        ("event_time", "String"),
        ("user_id", "Integral"),
        ("event_type", "String"),
        ("value", "Fractional"),
        ("props", "String"),
    ),
    online=True,
    offline=OfflineStore(HOUR_FORMAT),
)
EVENTS_BY_DATE = FeatureGroup(
    name="events_by_date",
    record_identifier=EVENTS.record_identifier,
    event_time=EVENTS.event_time,
    features=EVENTS.features,
    offline=OfflineStore(TABLE_FORMAT),
)
USERS = FeatureGroup(
    name="users",
    record_identifier="user_id",
    event_time="event_time",
    features=(
        ("user_id", "Integral"),
        ("event_time", "Fractional"),
        ("event_id", "Integral"),
        ("event_type", "String"),
        ("value", "Fractional"),
    ),
    online=True,
)
USERS_KEPT = FeatureGroup(
    name="users_kept",
    record_identifier=USERS.record_identifier,
    event_time=USERS.event_time,
    features=USERS.features,
    online=True,
    offline=OfflineStore(HOUR_FORMAT),
)
# Noon of 20 January 2024, in seconds.
DELETED_AT = 1705752000.0
ORDERS = FeatureGroup(
    name="orders",
    record_identifier="o_orderkey",
    event_time="event_time",
    features=(
        ("o_orderkey", "Integral"),
        ("event_time", "String"),
        ("o_custkey", "Integral"),
        ("o_orderstatus", "String"),
        ("o_totalprice", "Fractional"),
    ),
    offline=OfflineStore(HOUR_FORMAT),
)
PARTS = FeatureGroup(
    name="parts",
    record_identifier="l_partkey",
    event_time="event_time",
    features=(
        ("l_partkey", "Integral"),
        ("event_time", "Fractional"),
        ("line", "Integral"),
        ("l_quantity", "Fractional"),
        ("l_extendedprice", "Fractional"),
        ("l_returnflag", "String"),
    ),
    online=True,
)


def table(spark, sf_dir, name):
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_events(df):
    """Rows of the events table with a text event time; also works on a stream."""
    return df.select(
        "event_id",
        F.date_format("ts", ISO_TIME).alias("event_time"),
        "user_id",
        "event_type",
        "value",
        "props",
    )


def events(spark, sf_dir):
    return as_events(table(spark, sf_dir, "events"))


def as_raw_events(df):
    """Events as texts, with faults that depend on the identifier."""
    key = F.col("event_id")
    return as_events(df).select(
        key.cast("string").alias("event_id"),
        F.when(key % 101 == 0, "not-a-time")
        .when(key % 103 == 0, None)
        .otherwise(F.col("event_time"))
        .alias("event_time"),
        F.when(key % 83 == 0, "3.7")
        .when(key % 73 == 0, None)
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        F.when(key % 79 == 0, "NaN").otherwise(F.col("event_type")).alias("event_type"),
        F.when(key % 97 == 0, "abc")
        .when(key % 89 == 0, "NaN")
        .otherwise(F.col("value").cast("string"))
        .alias("value"),
        "props",
    )


def raw_events(spark, sf_dir):
    return as_raw_events(table(spark, sf_dir, "events"))


def _stream_of_events(spark, sf_dir):
    """The events table as a stream. The glob lets one file and a folder of files both do."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def event_stream(spark, sf_dir):
    return as_events(_stream_of_events(spark, sf_dir))


def raw_event_stream(spark, sf_dir):
    return as_raw_events(_stream_of_events(spark, sf_dir))


def users(spark, sf_dir):
    """Events keyed by user, with the event time in whole seconds since the epoch."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("double").alias("event_time"),
        "event_id",
        "event_type",
        "value",
    )


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", ISO_TIME).alias("event_time"),
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
    )


def narrow_orders(spark, sf_dir):
    """Orders in types that widen when they are stored: int to long, float to double.

    Keys fit an int up to scale factor 350.
    """
    return orders(spark, sf_dir).withColumns(
        {
            "o_orderkey": F.col("o_orderkey").cast("int"),
            "o_custkey": F.col("o_custkey").cast("int"),
            "o_totalprice": F.col("o_totalprice").cast("float"),
        }
    )


def parts(spark, sf_dir):
    """Order lines keyed by part, with the shipping day in seconds since the epoch."""
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("double").alias("event_time"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line"),
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
    )


def raw_parts(spark, sf_dir):
    """Order lines as texts; some quantities have no digits, some prices are NaN or a word."""
    key = F.col("line")
    return parts(spark, sf_dir).select(
        F.col("l_partkey").cast("string").alias("l_partkey"),
        F.col("event_time").cast("bigint").cast("string").alias("event_time"),
        key.cast("string").alias("line"),
        F.when(key % 37 == 0, "none")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("l_quantity"),
        F.when(key % 41 == 0, "NaN")
        .when(F.col("l_extendedprice") > DEAR, "dear")
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("l_extendedprice"),
        "l_returnflag",
    )


def lossy_orders(df):
    """Orders as a faulty copy would hold them.

    Cheap pending ones are lost; some others are changed, repeated, or there under a key
    that was never sent.
    """
    key = F.col("o_orderkey")
    lost = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000)
    copied = df.filter(~lost).withColumn(
        "o_totalprice",
        F.when(key % 90 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    copies = F.array_compact(
        F.array(
            key,
            F.when(key % 70 == 2, key),
            F.when(key % 110 == 3, -key - 1),
        )
    )
    return copied.withColumn("o_orderkey", F.explode(copies))


def damaged_events(df):
    """Events as a faulty copy would hold them: some are lost, some doubled, some changed.

    Those of early hours of the day only, so that other hours are equal.
    """
    key = F.col("event_id")
    early = F.substring("event_time", 12, 2) < "06"
    changed = df.withColumns(
        {
            "event_type": F.when(early & (key % 31 == 3), "retyped").otherwise(F.col("event_type")),
            "user_id": F.when(early & (key % 37 == 4), -key).otherwise(F.col("user_id")),
        }
    )
    lost, doubled = early & (key % 29 == 1), early & (key % 41 == 2)
    copies = F.when(lost, 0).when(doubled, 2).otherwise(1)
    return changed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("copy")


def event_schemas(spark, sf_dir):
    """The column names each event would arrive with, some of them faulty."""
    key = F.col("event_id")
    names = F.array_compact(
        F.array(
            F.lit("event_id"),
            F.when(key % 7 != 0, "event_time"),
            F.lit("user_id"),
            F.when(key % 19 == 0, "Event_Type"),
            F.lit("event_type"),
            F.when(key % 11 == 0, "value;").otherwise(F.lit("value")),
            F.when(key % 13 == 0, "hour"),
            F.when(key % 17 == 0, F.concat(F.lit("k"), F.get_json_object("props", "$.k"))),
        )
    )
    return table(spark, sf_dir, "events").select("event_id", names.alias("names"))


def customer_groups(spark, sf_dir):
    """One feature group per customer, in the shape of the catalogue."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("group-"), key.cast("string")).alias("name"),
        F.when(key % 7 == 0, "Creating")
        .when(key % 11 == 0, "CreateFailed")
        .otherwise(F.lit("Created"))
        .alias("status"),
        F.lit("id").alias("record_identifier"),
        F.lit("at").alias("event_time"),
        F.array(
            F.struct(F.lit("id").alias("name"), F.lit("Integral").alias("type")),
            F.struct(F.lit("at").alias("name"), F.lit("String").alias("type")),
        ).alias("features"),
        F.when(key % 3 != 0, F.struct((key % 5 != 0).alias("enabled"))).alias("online"),
        F.when(
            key % 4 != 0,
            F.struct(
                F.when(key % 4 == 1, HOUR_FORMAT)
                .when(key % 4 == 2, TABLE_FORMAT)
                .alias("table_format"),
                F.lit(None).cast("string").alias("path"),
                F.lit(None).cast("string").alias("catalog"),
                F.lower("c_mktsegment").alias("database"),
                F.col("c_name").alias("table"),
            ),
        ).alias("offline"),
    )


def customer_resource_ids(spark, sf_dir):
    """One resource identifier per customer, some malformed."""
    key = F.col("c_custkey")
    account = F.lpad(key.cast("string"), 12, "0")
    resource_id = (
        F.when(key % 13 == 0, F.concat(F.lit("group-"), key.cast("string")))
        .when(
            key % 17 == 0,
            F.concat(F.lit("arn:cloud:features:region-1:"), key.cast("string"),
                     F.lit(":feature-group/short-account")),
        )
        .when(
            key % 19 == 0,
            F.concat(F.lit("arn:cloud:features:region-1:"), account, F.lit(":feature-group/")),
        )
        .when(
            key % 23 == 0,
            F.concat(F.lit("arn:cloud:features:region-1:"), account,
                     F.lit(":feature-group/outer/inner")),
        )
        .otherwise(
            F.concat(
                F.when(key % 2 == 0, "arn:cloud:features:region-").otherwise(
                    F.lit("arn:cloud-cn:features:region-")
                ),
                F.col("c_nationkey").cast("string"),
                F.lit(":"),
                account,
                F.lit(":feature-group/"),
                F.col("c_name"),
            )
        )
    )
    return table(spark, sf_dir, "customer").select("c_custkey", resource_id.alias("resource_id"))
