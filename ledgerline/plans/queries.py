"""The registered queries: each takes (spark, sf_dir) and reads whole tables."""

from pyspark.sql import functions as F

from ledgerline.errors import RecordIngestionError, ValidationError
from ledgerline.functions import named
from ledgerline.functions.history import (
    AUDIT_COLUMNS,
    with_audit_columns,
    with_hour_columns,
)
from ledgerline.functions.records import exploded_records
from ledgerline.functions.resource_ids import parse_resource_ids
from ledgerline.operators import checks, outcomes
from ledgerline.operators.definitions import definition_report
from ledgerline.operators.latest import latest_per_record
from ledgerline.operators.names import schema_name_report as name_report
from ledgerline.operators.partitions import bounded_repartition as bounded
from ledgerline.operators.reconcile import reconcile
from ledgerline.plans import inputs
from ledgerline.plans.inputs import EVENTS, EVENTS_BY_DATE, ORDERS, PARTS, USERS
from ledgerline.plans.store import FeatureStore
from ledgerline.session import scratch_dir
from ledgerline.sinks.history import append_hours
from ledgerline.sinks.keyed import KeyedTable
from ledgerline.sources.catalog import usable_groups
from ledgerline.sources.delimited import read_csv
from ledgerline.sources.history import read_date, read_hour, read_hours
from ledgerline.streaming.ingest import ingest_stream, merge_stream
from ledgerline.streaming.missing import missing_stream

LOOKUP_BUCKETS = 16


def _store(spark, purpose, **options):
    return FeatureStore(spark, scratch_dir(spark, purpose), buckets=LOOKUP_BUCKETS, **options)


def _shown(df):
    """User ids as texts: a nullable long turns to floats in some result readers."""
    return df.withColumn("user_id", F.col("user_id").cast("string"))


def _fails_on_hundreds(group):
    """A put that refuses every identifier divisible by one hundred."""
    identifier = group.record_identifier

    def put(_, record, target):
        for value in record:
            if value["feature_name"] == identifier and int(value["value_as_string"]) % 100 == 0:
                raise ValueError("refused " + value["value_as_string"])

    return put


# Definitions, names, groups --------------------------------------------------


def feature_definitions(spark, sf_dir):
    return definition_report(inputs.table(spark, sf_dir, "part"))


def schema_name_report(spark, sf_dir):
    return name_report(inputs.event_schemas(spark, sf_dir), "event_id", "names", EVENTS)


def group_catalog(spark, sf_dir):
    return usable_groups(inputs.customer_groups(spark, sf_dir)).select(
        "name",
        F.concat_ws(",", "target_stores").alias("target_stores"),
        "online_enabled",
        "offline_enabled",
        "is_hour_table",
        "is_v2_table",
    )


def resource_id_parse(spark, sf_dir):
    return parse_resource_ids(inputs.customer_resource_ids(spark, sf_dir), "resource_id")


# Row checks and casts --------------------------------------------------------


def row_validation_errors(spark, sf_dir):
    return checks.row_validation_errors(inputs.raw_events(spark, sf_dir), EVENTS)


def invalid_rows(spark, sf_dir):
    return checks.invalid_rows(inputs.raw_events(spark, sf_dir), EVENTS)


def invalid_row_report(spark, sf_dir):
    return checks.invalid_row_report(inputs.raw_events(spark, sf_dir), EVENTS)


def validated_cast(spark, sf_dir):
    raw = inputs.raw_events(spark, sf_dir)
    return _shown(checks.cast_features(checks.valid_rows(raw, EVENTS), EVENTS))


def orders_validated_cast(spark, sf_dir):
    return checks.validated_cast(inputs.orders(spark, sf_dir), ORDERS)


def lineitem_row_errors(spark, sf_dir):
    """Number of order lines per error text."""
    errors = checks.row_validation_errors(inputs.raw_parts(spark, sf_dir), PARTS)
    return errors.groupBy("dataTypeValidationErrors").agg(F.count("*").alias("n_rows"))


# History ---------------------------------------------------------------------


def audit_columns(spark, sf_dir):
    return with_audit_columns(inputs.events(spark, sf_dir)).select(
        "event_id",
        "is_deleted",
        (F.col("write_time") == F.col("api_invocation_time")).alias("same_time"),
    )


def event_time_partitions(spark, sf_dir):
    return with_hour_columns(inputs.events(spark, sf_dir), EVENTS).select(
        "event_id", "year", "month", "day", "hour"
    )


def numeric_event_time_partitions(spark, sf_dir):
    return with_hour_columns(inputs.users(spark, sf_dir), USERS).select(
        "event_id", "year", "month", "day", "hour"
    )


def offline_partitioned_write(spark, sf_dir):
    store = _store(spark, "offline_partitioned_write")
    store.ingest(inputs.events(spark, sf_dir), EVENTS, ["OfflineStore"])
    return store.history(EVENTS).drop(*AUDIT_COLUMNS)


def offline_partition_read(spark, sf_dir):
    path = scratch_dir(spark, "offline_partition_read")
    append_hours(inputs.events(spark, sf_dir), EVENTS, path)
    return read_hour(spark, EVENTS, path, "2024", "01", "15", "10").drop(*AUDIT_COLUMNS)


def offline_date_append(spark, sf_dir):
    store = _store(spark, "offline_date_append")
    store.ingest(inputs.events(spark, sf_dir), EVENTS_BY_DATE)
    return store.history(EVENTS_BY_DATE).drop(*AUDIT_COLUMNS)


def offline_date_read(spark, sf_dir):
    store = _store(spark, "offline_date_read")
    store.ingest(inputs.events(spark, sf_dir), EVENTS_BY_DATE)
    path = store.history_path(EVENTS_BY_DATE)
    return read_date(spark, EVENTS_BY_DATE, path, "2024-01-15").drop(*AUDIT_COLUMNS)


def time_sliced_ingest(spark, sf_dir):
    store = _store(spark, "time_sliced_ingest")
    store.ingest_by_time(inputs.events(spark, sf_dir), EVENTS, "week", ["OfflineStore"])
    return store.history(EVENTS).drop(*AUDIT_COLUMNS)


class _CutOff(FeatureStore):
    """Ends in its third slice, after a part of the rows has been appended."""

    appended = 0

    def _append(self, df, *args, **options):
        self.appended += 1
        if self.appended == 3:
            super()._append(df.filter("event_id % 3 = 0"), *args, **options)
            raise ConnectionError("cut off")
        super()._append(df, *args, **options)


def restarted_ingest(spark, sf_dir):
    """Weeks of events, cut off in the third and run again with the same token."""
    root = scratch_dir(spark, "restarted_ingest")
    arguments = inputs.events(spark, sf_dir), EVENTS, "week", ["OfflineStore"]
    try:
        _CutOff(spark, root).ingest_by_time(*arguments, token="events")
    except ConnectionError:
        pass
    store = FeatureStore(spark, root)
    store.ingest_by_time(*arguments, token="events")
    return store.history(EVENTS).drop(*AUDIT_COLUMNS)


def refused_then_ingested(spark, sf_dir):
    """Texts with faults, refused as a whole in the one pass that reads them; then the valid ones."""
    store = _store(spark, "refused_then_ingested")
    raw = inputs.raw_events(spark, sf_dir)
    try:
        store.ingest(raw, EVENTS, ["OfflineStore"])
    except ValidationError:
        pass
    store.ingest(checks.valid_rows(raw, EVENTS), EVENTS, ["OfflineStore"])
    return _shown(store.history(EVENTS).drop(*AUDIT_COLUMNS))


def history_range(spark, sf_dir):
    """Eight days, cut within an hour at both ends, from a history by hour and one by date."""
    store = _store(spark, "history_range")
    events = inputs.events(spark, sf_dir)
    parts = []
    for group in (EVENTS, EVENTS_BY_DATE):
        store.ingest(events, group, ["OfflineStore"])
        rows = store.history_between(group, "2024-01-09T05:30:00Z", "2024-01-17T12:15:00Z")
        parts.append(
            rows.select(*[named(c) for c in events.columns], F.lit(group.name).alias("layout"))
        )
    return parts[0].unionByName(parts[1])


# Records ---------------------------------------------------------------------


def record_projection(spark, sf_dir):
    return exploded_records(inputs.raw_events(spark, sf_dir), "event_id")


def online_put_outcomes(spark, sf_dir):
    rows = bounded(inputs.events(spark, sf_dir))
    return outcomes.put_outcomes(rows, _fails_on_hundreds(EVENTS))


def failed_records(spark, sf_dir):
    store = _store(spark, "failed_records", put=_fails_on_hundreds(EVENTS))
    try:
        store.ingest(inputs.events(spark, sf_dir), EVENTS, ["OnlineStore"])
    except RecordIngestionError:
        pass
    return store.failed_records()


def failed_record_count(spark, sf_dir):
    return outcomes.failed_record_count(online_put_outcomes(spark, sf_dir))


def online_ingest(spark, sf_dir):
    """Texts with faults into both stores; the history holds what the put accepted."""
    store = _store(spark, "online_ingest")
    try:
        store.ingest(inputs.raw_events(spark, sf_dir), EVENTS)
    except RecordIngestionError:
        pass
    stored = store.online(EVENTS).read().select("event_id", F.lit("online").alias("store"))
    kept = store.history(EVENTS).select("event_id", F.lit("offline").alias("store"))
    failed = store.failed_records().select(
        F.col("event_id").cast("bigint"), F.lit("failed").alias("store")
    )
    return stored.unionByName(kept).unionByName(failed)


def accepted_history(spark, sf_dir):
    """Both stores with an external put: the history holds what the put accepted."""
    store = _store(spark, "accepted_history", put=_fails_on_hundreds(EVENTS))
    try:
        store.ingest(inputs.events(spark, sf_dir), EVENTS)
    except RecordIngestionError:
        pass
    return store.history(EVENTS).drop(*AUDIT_COLUMNS)


def online_merge(spark, sf_dir):
    """Two puts that overlap in users, then one row per user after a rewrite."""
    keyed = _store(spark, "online_merge").online(USERS)
    rows = inputs.users(spark, sf_dir)
    clicks = F.col("event_type").eqNullSafe("click")
    for part in (rows.filter(clicks), rows.filter(~clicks)):
        keyed.put(part, sequence="event_id")
    keyed.compact()
    return keyed.read()


def online_touched_merge(spark, sf_dir):
    """All users, then again those of a few buckets, of which only these are rewritten."""
    keyed = _store(spark, "online_touched_merge").online(USERS)
    rows = inputs.users(spark, sf_dir)
    late = F.col("event_time") >= inputs.DELETED_AT
    keyed.put(rows.filter(~late), sequence="event_id")
    few = F.pmod(F.xxhash64("user_id"), F.lit(LOOKUP_BUCKETS)) < 4
    keyed.put(rows.filter(late & few), sequence="event_id")
    keyed.compact_touched()
    keyed.put(rows.filter(late & ~few), sequence="event_id")
    keyed.compact_touched()
    return keyed.read()


def deleted_records(spark, sf_dir):
    """Every fifth user is deleted as of a day: who is left online, what the history holds."""
    store, group = _store(spark, "deleted_records"), inputs.USERS_KEPT
    users = inputs.users(spark, sf_dir).filter("user_id is not null")
    store.ingest(users, group)
    fifth = users.filter("user_id % 5 = 0").select("user_id").distinct()
    store.delete(fifth.withColumn("event_time", F.lit(inputs.DELETED_AT)), group)
    store.online(group).compact()
    online = store.online(group).read().select("user_id", "event_id", F.lit("online").alias("store"))
    history = store.history(group).select(
        "user_id",
        F.coalesce("event_id", F.lit(-1)).alias("event_id"),
        F.when(F.col("is_deleted"), "deletion").otherwise(F.lit("history")).alias("store"),
    )
    return online.unionByName(history)


def lineitem_latest(spark, sf_dir):
    return latest_per_record(inputs.parts(spark, sf_dir), PARTS, sequence="line")


def latest_records(spark, sf_dir):
    return latest_per_record(inputs.users(spark, sf_dir), USERS, sequence="event_id")


def online_lookup(spark, sf_dir):
    store = _store(spark, "online_lookup")
    keyed = store.online(USERS)
    keyed.put(inputs.users(spark, sf_dir), sequence="event_id")
    wanted = (
        inputs.table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select("o_custkey")
    )
    return keyed.lookup(wanted)


def bounded_repartition(spark, sf_dir):
    return bounded(inputs.orders(spark, sf_dir))


# Whole jobs ------------------------------------------------------------------


def ingest_reconciliation(spark, sf_dir):
    sent = inputs.orders(spark, sf_dir)
    return reconcile(sent, inputs.lossy_orders(sent), "o_orderkey")


def lineitem_reconciliation(spark, sf_dir):
    """Order lines against a copy without the returned ones, by part."""
    sent = inputs.parts(spark, sf_dir)
    return reconcile(sent, sent.filter("l_returnflag <> 'R'"), PARTS.record_identifier)


def stored_reconciliation(spark, sf_dir):
    """What the history holds after an ingest, against what was sent."""
    store = _store(spark, "stored_reconciliation")
    sent = inputs.events(spark, sf_dir)
    store.ingest(sent, EVENTS, ["OfflineStore"])
    stored = store.history(EVENTS).select(*[named(c) for c in sent.columns])
    return reconcile(sent, stored, "event_id")


def history_differences(spark, sf_dir):
    """Events against a history with some lost, doubled, retyped, or given to another user."""
    store = _store(spark, "history_differences")
    sent = inputs.events(spark, sf_dir)
    store.ingest(inputs.damaged_events(sent), EVENTS, ["OfflineStore"])
    return store.differences(sent, EVENTS)


def _streamed(spark, sf_dir, purpose):
    base = scratch_dir(spark, purpose)
    paths = f"{base}/history", f"{base}/quarantine"
    stream = inputs.raw_event_stream(spark, sf_dir)
    for query in ingest_stream(stream, EVENTS, *paths, checkpoint=f"{base}/checkpoint"):
        query.awaitTermination()
    return paths


def streaming_ingest(spark, sf_dir):
    history, _ = _streamed(spark, sf_dir, "streaming_ingest")
    return _shown(read_hours(spark, EVENTS, history).drop(*AUDIT_COLUMNS))


def streaming_quarantine(spark, sf_dir):
    _, quarantine = _streamed(spark, sf_dir, "streaming_quarantine")
    return spark.read.parquet(quarantine)


def _merged(spark, sf_dir, purpose):
    """The raw event stream into a keyed table of events, and its quarantine."""
    base = scratch_dir(spark, purpose)
    keyed = KeyedTable(spark, f"{base}/table", EVENTS, LOOKUP_BUCKETS)
    stream = inputs.raw_event_stream(spark, sf_dir)
    for query in merge_stream(stream, keyed, f"{base}/quarantine", f"{base}/checkpoint"):
        query.awaitTermination()
    return keyed, f"{base}/quarantine"


def streaming_merge(spark, sf_dir):
    keyed, _ = _merged(spark, sf_dir, "streaming_merge")
    return _shown(keyed.read())


def streaming_merge_quarantine(spark, sf_dir):
    """Every event of the stream: stored, or kept with its error."""
    keyed, quarantine = _merged(spark, sf_dir, "streaming_merge_quarantine")
    stored = keyed.read().select(
        F.col("event_id").cast("string").alias("event_id"), F.lit("").alias("error")
    )
    faulty = spark.read.parquet(quarantine).select(
        "event_id", F.col("dataTypeValidationErrors").alias("error")
    )
    return stored.unionByName(faulty)


def streaming_date_ingest(spark, sf_dir):
    """Half of the events in a batch, half as a stream, into one history by date."""
    store = _store(spark, "streaming_date_ingest")
    even = F.col("event_id") % 2 == 0
    store.ingest(inputs.events(spark, sf_dir).filter(even), EVENTS_BY_DATE)
    stream = inputs.event_stream(spark, sf_dir).filter(~F.coalesce(even, F.lit(False)))
    for query in store.ingest_stream(stream, EVENTS_BY_DATE):
        query.awaitTermination()
    return store.history(EVENTS_BY_DATE).drop(*AUDIT_COLUMNS)


def compacted_history(spark, sf_dir):
    """Three batches leave three small files an hour; packed, the rows are the same."""
    store = _store(spark, "compacted_history")
    events = inputs.events(spark, sf_dir)
    for part in range(3):
        store.ingest(events.filter(F.col("event_id") % 3 == part), EVENTS, ["OfflineStore"])
    store.compact_history(EVENTS)
    return store.history(EVENTS).drop(*AUDIT_COLUMNS)


def streamed_missing(spark, sf_dir):
    """Events that a stream sends and a history, read as a stream, has not got two days later."""
    store = _store(spark, "streamed_missing")
    events = inputs.events(spark, sf_dir)
    store.ingest(inputs.damaged_events(events), EVENTS, ["OfflineStore"])
    stored = spark.readStream.schema(store.history(EVENTS).schema).parquet(store.history_path(EVENTS))
    base = scratch_dir(spark, "streamed_missing")
    paths = f"{base}/missing", f"{base}/checkpoint"
    sent = inputs.event_stream(spark, sf_dir)
    missing_stream(sent, stored, EVENTS, *paths, delay="2 days").awaitTermination()
    return spark.read.schema(events.schema).parquet(paths[0])


def streamed_put_failures(spark, sf_dir):
    """What a put refuses of a stream of events."""
    store = _store(spark, "streamed_put_failures", put=_fails_on_hundreds(EVENTS))
    stream = inputs.event_stream(spark, sf_dir)
    for query in store.ingest_stream(stream, EVENTS, target_stores=["OnlineStore"]):
        query.awaitTermination()
    return store.quarantined(EVENTS)


def widened_reconciliation(spark, sf_dir):
    """Orders with int keys and float prices against the longs and doubles stored of them."""
    store = _store(spark, "widened_reconciliation")
    sent = inputs.narrow_orders(spark, sf_dir)
    store.ingest(sent.filter("o_orderkey % 50 <> 7"), ORDERS)
    stored = store.history(ORDERS).select(*[named(c) for c in sent.columns])
    return reconcile(sent, stored, "o_orderkey")


def csv_inferred_source(spark, sf_dir):
    path = scratch_dir(spark, "csv_inferred_source")
    inputs.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path)


def flagship(spark, sf_dir):
    """Check, cast and append events to the history, then read the history back."""
    return offline_partitioned_write(spark, sf_dir)


QUERIES = {
    "feature_definitions": feature_definitions,
    "schema_name_report": schema_name_report,
    "group_catalog": group_catalog,
    "resource_id_parse": resource_id_parse,
    "row_validation_errors": row_validation_errors,
    "invalid_rows": invalid_rows,
    "invalid_row_report": invalid_row_report,
    "validated_cast": validated_cast,
    "orders_validated_cast": orders_validated_cast,
    "audit_columns": audit_columns,
    "event_time_partitions": event_time_partitions,
    "numeric_event_time_partitions": numeric_event_time_partitions,
    "offline_partitioned_write": offline_partitioned_write,
    "offline_partition_read": offline_partition_read,
    "offline_date_append": offline_date_append,
    "offline_date_read": offline_date_read,
    "time_sliced_ingest": time_sliced_ingest,
    "record_projection": record_projection,
    "online_put_outcomes": online_put_outcomes,
    "failed_records": failed_records,
    "failed_record_count": failed_record_count,
    "online_ingest": online_ingest,
    "latest_per_record": latest_records,
    "online_lookup": online_lookup,
    "bounded_repartition": bounded_repartition,
    "ingest_reconciliation": ingest_reconciliation,
    "stored_reconciliation": stored_reconciliation,
    "streaming_ingest": streaming_ingest,
    "streaming_quarantine": streaming_quarantine,
    "csv_inferred_source": csv_inferred_source,
    "lineitem_row_errors": lineitem_row_errors,
    "lineitem_latest": lineitem_latest,
    "lineitem_reconciliation": lineitem_reconciliation,
    "accepted_history": accepted_history,
    "online_merge": online_merge,
    "streaming_merge": streaming_merge,
    "streaming_merge_quarantine": streaming_merge_quarantine,
    "streaming_date_ingest": streaming_date_ingest,
    "widened_reconciliation": widened_reconciliation,
    "restarted_ingest": restarted_ingest,
    "refused_then_ingested": refused_then_ingested,
    "history_range": history_range,
    "streamed_put_failures": streamed_put_failures,
    "history_differences": history_differences,
    "deleted_records": deleted_records,
    "online_touched_merge": online_touched_merge,
    "compacted_history": compacted_history,
    "streamed_missing": streamed_missing,
}
