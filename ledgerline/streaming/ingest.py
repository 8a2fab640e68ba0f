"""Streaming ingest: valid rows to the history or a keyed table, faulty ones to a quarantine."""

import time

from pyspark.sql import functions as F

from ledgerline.functions.history import (
    HOUR_COLUMNS,
    date_column,
    with_audit_columns,
    with_event_date,
    with_hour_columns,
)
from ledgerline.groups import TABLE_FORMAT
from ledgerline.operators.checks import cast_features, invalid_rows, valid_rows
from ledgerline.operators.names import ROW_ERRORS_COLUMN, check_names
from ledgerline.sinks.history import WRITE_OPTIONS, check_format, cluster_by

SEQUENCE_SCHEMA = "sequence bigint"
# Seconds for which a micro-batch waits for a compaction of its table.
COMPACTION_WAIT = 3600


def _file_query(df, path, checkpoint, partition_columns=(), trigger=None):
    return (
        df.writeStream.format("parquet")
        .partitionBy(*partition_columns)
        .option("compression", WRITE_OPTIONS["compression"])
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _quarantine_query(stream, group, quarantine, checkpoint, trigger, strict):
    """Faulty rows with their error; equal errors together, so files are few."""
    faulty = cluster_by(invalid_rows(stream, group, strict), [ROW_ERRORS_COLUMN])
    return _file_query(faulty, quarantine, f"{checkpoint}/quarantine", trigger=trigger)


def partitioned_rows(df, group):
    """Cast rows with audit and partition columns, and the names of the latter.

    Hours, or the event date for a group in the date layout.
    """
    rows = with_audit_columns(df)
    if group.offline is not None and group.offline.table_format == TABLE_FORMAT:
        return with_event_date(rows, group), (date_column(group),)
    return with_hour_columns(rows, group), HOUR_COLUMNS


def ingest_stream(stream, group, history, quarantine, checkpoint, trigger=None, strict=False):
    """Start two queries and return them: (history, quarantine).

    Without a ``quarantine``, for callers who keep faulty rows elsewhere, it is one query.
    The history gets the layout of the group's table format. Every step is a column
    expression of the batch path. Each query has a file sink with its own checkpoint, so
    each writes every row exactly once, also after a restart; the sinks' folders must not
    be shared with batch writers. The rows of an hour or date are brought together as in
    a batch, so a micro-batch does not leave one file per task and hour.
    """
    check_names(stream.columns, group)
    if group.offline is not None:
        check_format(stream.sparkSession, group)
    cast = cast_features(valid_rows(stream, group, strict), group, strict)
    rows, columns = partitioned_rows(cast, group)
    rows = cluster_by(rows, columns)
    kept = _file_query(rows, history, f"{checkpoint}/history", columns, trigger)
    if quarantine is None:
        return (kept,)
    return kept, _quarantine_query(stream, group, quarantine, checkpoint, trigger, strict)


def _sequence_of(spark, folder, batch_id):
    """The time at which a micro-batch was first put, kept beside the checkpoint."""
    path = f"{folder}/batch={batch_id}"
    row = spark.range(1).select(F.lit(time.time_ns()).alias("sequence"))
    row.coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema(SEQUENCE_SCHEMA).parquet(path).first()["sequence"]


def merge_stream(stream, table, quarantine, checkpoint, trigger=None, strict=False):
    """Start two queries and return them: (merge, quarantine).

    The valid rows of each micro-batch are put into a keyed table, the faulty ones go to
    the quarantine exactly once, with their error. The time of the first put of a batch
    decides between equal event times. It is kept, so a batch that is replayed after a
    failure, even after later ones, puts the same records again, which changes nothing.
    A compaction that is under way is waited for.
    """
    group = table.group
    check_names(stream.columns, group)
    rows = cast_features(valid_rows(stream, group, strict), group, strict)
    sequences = f"{checkpoint}/sequences"

    def put(batch, batch_id):
        sequence = _sequence_of(batch.sparkSession, sequences, batch_id)
        table.put(batch, sequence, wait=COMPACTION_WAIT)

    merge = (
        rows.writeStream.foreachBatch(put)
        .option("checkpointLocation", f"{checkpoint}/merge")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return merge, _quarantine_query(stream, group, quarantine, checkpoint, trigger, strict)
