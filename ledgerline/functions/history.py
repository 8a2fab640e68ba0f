"""Columns added to a row on its way into the history."""

from pyspark.sql import functions as F

from ledgerline.functions import named
from ledgerline.functions.casts import to_event_timestamp

# Names of the stored columns.
API_INVOCATION_TIME = "api_invocation_time"
WRITE_TIME = "write_time"
IS_DELETED = "is_deleted"
AUDIT_COLUMNS = (API_INVOCATION_TIME, WRITE_TIME, IS_DELETED)
HOUR_COLUMNS = ("year", "month", "day", "hour")
HOUR_PATTERNS = ("yyyy", "MM", "dd", "HH")
DATE_SUFFIX = "_trunc"


def mark_time(at):
    """The write time of rows that carry a mark: ``at`` microseconds since the epoch."""
    return F.timestamp_micros(F.lit(at).cast("bigint"))


def with_audit_columns(df, at=None, deleted=False):
    """Both times are the start of the query, or the mark ``at``: equal within one write.

    ``deleted`` says that the rows are deletions of records.
    """
    time = F.current_timestamp() if at is None else mark_time(at)
    return df.withColumns(
        {
            API_INVOCATION_TIME: time,
            WRITE_TIME: time,
            IS_DELETED: F.lit(deleted),
        }
    )


def event_timestamp(group):
    """Event time of a row whose columns already have their declared types."""
    return to_event_timestamp(named(group.event_time), group.feature_types[group.event_time])


def hour_columns(ts):
    """Year, month, day and hour of a timestamp, as texts."""
    return {name: F.date_format(ts, p) for name, p in zip(HOUR_COLUMNS, HOUR_PATTERNS)}


def with_hour_columns(df, group):
    return df.withColumns(hour_columns(event_timestamp(group)))


def event_date(group):
    """First ten characters of a text event time; the date of a numeric one."""
    if group.feature_types[group.event_time] == "String":
        return F.substring(named(group.event_time), 1, 10)
    return F.date_format(event_timestamp(group), "yyyy-MM-dd")


def date_column(group):
    """Name of the partition column of the date layout."""
    return group.event_time + DATE_SUFFIX


def with_event_date(df, group):
    return df.withColumn(date_column(group), event_date(group))
