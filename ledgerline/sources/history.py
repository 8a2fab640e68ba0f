"""Reading the history back."""

from datetime import UTC, date, datetime, time, timedelta
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.errors import NO_SUCH_CATALOGUE, ValidationError
from ledgerline.functions import named
from ledgerline.functions.history import (
    API_INVOCATION_TIME,
    HOUR_COLUMNS,
    IS_DELETED,
    WRITE_TIME,
    date_column,
    event_timestamp,
    mark_time,
)
from ledgerline.groups import TABLE_FORMAT


def history_schema(group, partition_columns=HOUR_COLUMNS):
    """Declared features, audit columns, partition columns as texts.

    Given to the reader, it keeps ``month=01`` a text and spares the inference pass.
    """
    audit = [
        T.StructField(API_INVOCATION_TIME, T.TimestampType()),
        T.StructField(WRITE_TIME, T.TimestampType()),
        T.StructField(IS_DELETED, T.BooleanType()),
    ]
    keys = [T.StructField(c, T.StringType()) for c in partition_columns]
    return T.StructType(group.schema().fields + audit + keys)


def table_name(store):
    """Name of a catalogue table, all parts in lower case."""
    return f"{store.catalog.lower()}.{store.database.lower()}.`{store.table.lower()}`"


def in_catalog(spark, group):
    """Whether the group's history is a table of a v2 catalogue.

    A group that names one is never kept anywhere else: it raises where the session does
    not configure that catalogue.
    """
    name = group.offline.catalog
    if group.offline.table_format != TABLE_FORMAT or not name:
        return False
    if not spark.conf.get(f"spark.sql.catalog.{name.lower()}", None):
        raise ValidationError(NO_SUCH_CATALOGUE.format(group=group.name, catalog=name))
    return True


def read_table(spark, group):
    """The history of a group kept in a v2 catalogue."""
    return spark.read.table(table_name(group.offline))


def read_hours(spark, group, path):
    """The hour-partitioned history; filters on its four columns prune directories."""
    return spark.read.schema(history_schema(group)).parquet(path)


def read_hour(spark, group, path, year, month, day, hour):
    """One hour by its directory, so that no other directory is even listed."""
    values = dict(zip(HOUR_COLUMNS, (year, month, day, hour)))
    folder = "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in values.items())])
    try:
        return (
            spark.read.schema(history_schema(group)).option("basePath", path).parquet(folder)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Nothing in that hour; a missing history still raises here.
        wanted = [F.col(k) == v for k, v in values.items()]
        return read_hours(spark, group, path).filter(reduce(and_, wanted))


def read_dates(spark, group, path):
    """The date-partitioned history."""
    return spark.read.schema(history_schema(group, (date_column(group),))).parquet(path)


def read_date(spark, group, path, date):
    return read_dates(spark, group, path).filter(named(date_column(group)) == date)


# Ranges of event time ---------------------------------------------------------

HOUR = timedelta(hours=1)
# A text may give its time in a zone this far from UTC, and its date is that of the zone.
FARTHEST_ZONE = timedelta(hours=18)
_EPOCH = datetime(1970, 1, 1)


def moment(value):
    """A time as UTC without a zone: a datetime, a date or an ISO text; without a zone it is UTC."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if isinstance(value, date) and not isinstance(value, datetime):
        value = datetime.combine(value, time())
    return value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value


def _micros(value):
    return (value - _EPOCH) // timedelta(microseconds=1)


def _within(group, start, end):
    ts = event_timestamp(group)
    return (ts >= mark_time(_micros(start))) & (ts < mark_time(_micros(end)))


def _hour_values(value):
    """The texts of the four hour columns."""
    return (f"{value.year:04d}", f"{value.month:02d}", f"{value.day:02d}", f"{value.hour:02d}")


def _after(value, unit):
    """The start of the next ``unit``; the latest time there is if that is beyond it."""
    try:
        if unit == "year":
            return value.replace(year=value.year + 1)
        if unit == "month":
            return value.replace(year=value.year + value.month // 12, month=value.month % 12 + 1)
        return value + (HOUR * 24 if unit == "day" else HOUR)
    except (ValueError, OverflowError):
        return datetime.max


def covering_folders(start, end):
    """The fewest folders that hold the hours of [start, end) and no other.

    Whole years, months and days in the middle, single hours at the edges: some hundred
    folders and one per year, however long the range is.
    """
    units = {"year": (1, 1, 0), "month": (1, 0), "day": (0,), "hour": ()}
    fields = ("month", "day", "hour")
    now, folders = start.replace(minute=0, second=0, microsecond=0), []
    while now < end:
        for depth, (unit, zeros) in enumerate(units.items(), 1):
            begins = all(
                getattr(now, f) == z for f, z in zip(fields[3 - len(zeros) :], zeros, strict=True)
            )
            # The hour that the end falls into is covered whole.
            if unit == "hour" or (begins and _after(now, unit) <= end):
                break
        columns = zip(HOUR_COLUMNS[:depth], _hour_values(now))
        folders.append("/".join(f"{c}={v}" for c, v in columns))
        now = _after(now, unit)
    return folders


def _in_hour(value):
    return reduce(and_, [F.col(c) == v for c, v in zip(HOUR_COLUMNS, _hour_values(value))])


def _read_hours_between(spark, group, path, start, end):
    base = path.rstrip("/")
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f"{base}/{f}" for f in covering_folders(start, end)]
    folders = [f for f in folders if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f))]
    if not folders:
        # Nothing in that range; a missing history still raises here.
        return read_hours(spark, group, path).filter(F.lit(False))
    rows = spark.read.schema(history_schema(group)).option("basePath", base).parquet(*folders)
    # Only the two hours that the range cuts have rows to be left out.
    cut = {t.replace(minute=0, second=0, microsecond=0) for t in (start, end)} - {start, end}
    for hour in sorted(cut):
        rows = rows.filter(~_in_hour(hour) | _within(group, start, end))
    return rows


def _read_dates_between(spark, group, path, start, end):
    rows = read_dates(spark, group, path)
    column = named(date_column(group))
    whole = timedelta(days=1)
    spread, other = timedelta(), F.lit(False)
    if group.feature_types[group.event_time] == "String":
        # The folder of a text is its first ten characters: a date of the zone that the text
        # names, or, for a short form of a time, something that is no date.
        spread, other = FARTHEST_ZONE, ~column.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    last = end - timedelta(microseconds=1)

    def day(value):
        return f"{value.year:04d}-{value.month:02d}-{value.day:02d}"

    def shifted(value, by):
        try:
            return value + by
        except OverflowError:
            return datetime.max if by > timedelta() else datetime.min

    covering = (column >= day(shifted(start, -spread))) & (column <= day(shifted(last, spread)))
    # A date lies inside if it begins late enough and ends early enough in every zone.
    at_start, at_end = shifted(start, spread), shifted(end, -spread - whole)
    late = day(at_start if at_start.time() == time() else shifted(at_start, whole))
    inside = (column >= late) & (column <= day(at_end)) & ~other
    return rows.filter(covering | other).filter(inside | _within(group, start, end))


def read_range(spark, group, path, start, end):
    """The rows of a history of files whose event time is in [start, end).

    Times are datetimes, dates or ISO texts. Only folders that the range touches are read,
    and rows are compared with it only in those that it cuts: the first and the last hour
    or date. In the date layout of a text event time, whose folders are dates of the zone of
    each text, those within the farthest zone of an edge are compared as well, and so are
    folders that are no date. An empty range gives no rows; rows without a time are in none.
    """
    start, end = moment(start), moment(end)
    dated = group.offline.table_format == TABLE_FORMAT
    if start >= end:
        return (read_dates if dated else read_hours)(spark, group, path).filter(F.lit(False))
    return (_read_dates_between if dated else _read_hours_between)(spark, group, path, start, end)


def rows_between(rows, group, start, end):
    """``rows`` of a history, as of a catalogue's table, whose event time is in [start, end)."""
    return rows.filter(_within(group, moment(start), moment(end)))
