"""Appending to the history."""

from pyspark.sql import functions as F

from ledgerline.errors import INVALID_FORMAT, RESERVED_NAME, ValidationError
from ledgerline.functions import named
from ledgerline.functions.history import (
    HOUR_COLUMNS,
    date_column,
    with_audit_columns,
    with_event_date,
    with_hour_columns,
)
from ledgerline.groups import HOUR_FORMAT, TABLE_FORMAT
from ledgerline.sources.history import in_catalog, table_name

# No compression, no marker file, no summary files.
WRITE_OPTIONS = {
    "compression": "none",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    "parquet.summary.metadata.level": "NONE",
}
_REBALANCE_FLAGS = (
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled",
)
_STREAM_FLAG = "spark.sql.adaptive.streaming.stateless.enabled"


def cluster_by(df, columns):
    """Bring equal partition values together, but never a hot one into one task.

    REBALANCE shuffles by the columns once; AQE then cuts partitions above the advisory
    size into several tasks and merges small ones, so an hour with a third of all rows
    becomes many files of normal size. Without AQE a range partitioning over the columns
    and a hash of the row does the same from a sample of the data, at the price of the
    sampling pass; a stream, which cannot be sampled, is then left as it is.
    """
    keys = [named(c) for c in columns]
    conf = df.sparkSession.conf
    flags = _REBALANCE_FLAGS + ((_STREAM_FLAG,) if df.isStreaming else ())
    if all(conf.get(flag).lower() == "true" for flag in flags):
        return df.hint("rebalance", *keys)
    if df.isStreaming:
        return df
    return df.repartitionByRange(*keys, F.xxhash64(*[named(c) for c in df.columns]))


def append_hours(df, group, path, clustered=False, at=None, deleted=False):
    """Append cast rows below ``year=/month=/day=/hour=``, with audit columns.

    ``clustered=True`` says that each task's rows lie in few hours already, as when the
    input is read from hourly files; then nothing is shuffled.
    """
    rows = with_hour_columns(with_audit_columns(df, at, deleted), group)
    (
        (rows if clustered else cluster_by(rows, HOUR_COLUMNS))
        .write.partitionBy(*HOUR_COLUMNS)
        .options(**WRITE_OPTIONS)
        .mode("append")
        .parquet(path)
    )


def append_dates(df, group, path, clustered=False, at=None, deleted=False):
    """Append cast rows below ``<event time>_trunc=``, sorted by event time in each file.

    The sort starts with the partition column, so the writer needs no sort of its own.
    ``clustered=True``, as above, is for input whose tasks hold few dates each.
    """
    date = date_column(group)
    rows = with_event_date(with_audit_columns(df, at, deleted), group)
    (
        (rows if clustered else cluster_by(rows, [date]))
        .sortWithinPartitions(named(date), named(group.event_time))
        .write.partitionBy(date)
        .options(**WRITE_OPTIONS)
        .mode("append")
        .parquet(path)
    )


def append_table(df, group, at=None, deleted=False):
    """Append to a table of a v2 catalogue, which lays out the rows itself."""
    (
        with_audit_columns(df, at, deleted)
        .sortWithinPartitions(named(group.event_time))
        .writeTo(table_name(group.offline))
        .option("compression", "none")
        .append()
    )


def _append_dated(df, group, path, clustered, at, deleted):
    if in_catalog(df.sparkSession, group):
        append_table(df, group, at, deleted)
    else:
        append_dates(df, group, path, clustered, at, deleted)


_WRITERS = {None: append_hours, HOUR_FORMAT: append_hours, TABLE_FORMAT: _append_dated}


def check_format(spark, group):
    """Raise if the history of the group could not be written in this session."""
    if group.offline.table_format not in _WRITERS:
        valid = ", ".join(f for f in _WRITERS if f)
        raise ValueError(INVALID_FORMAT.format(format=group.offline.table_format, valid=valid))
    dated = group.offline.table_format == TABLE_FORMAT
    if dated and date_column(group) in group.feature_types:
        raise ValidationError(RESERVED_NAME.format(name=date_column(group)))
    in_catalog(spark, group)


def append_history(df, group, path, clustered=False, at=None, deleted=False):
    """Append cast rows in the layout of the group's table format.

    ``at`` is the mark that the rows carry as their write time, see ``sinks.ledger``;
    ``deleted`` says that they are deletions.
    """
    check_format(df.sparkSession, group)
    _WRITERS[group.offline.table_format](df, group, path, clustered, at, deleted)
