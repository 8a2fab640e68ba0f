"""Which records differ between what was sent and what a history holds, found by digests."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from ledgerline.functions import named
from ledgerline.functions.history import (
    HOUR_COLUMNS,
    date_column,
    with_event_date,
    with_hour_columns,
)
from ledgerline.groups import TABLE_FORMAT
from ledgerline.operators.reconcile import common_types, row_key
from ledgerline.session import scratch_dir

BUCKETS = 64
MISSING, EXTRA, CHANGED, REPEATED = "missing", "extra", "changed", "repeated"
_FOLDER, _BUCKET, _SIGN = "__folder", "__bucket", "__sign"
_HASHES = ("__h1", "__h2")


def _folder_columns(group):
    """The partition columns of the group's layout."""
    dated = group.offline is not None and group.offline.table_format == TABLE_FORMAT
    return (date_column(group),) if dated else HOUR_COLUMNS


def _folder(group):
    """The folder of a row as one text; rows without a time share one."""
    parts = [F.coalesce(named(c), F.lit("")) for c in _folder_columns(group)]
    return F.concat_ws("/", *parts)


def _with_folder_columns(df, group):
    if _folder_columns(group) == HOUR_COLUMNS:
        return with_hour_columns(df, group)
    return with_event_date(df, group)


def _sides(sent, stored, group):
    """Both sides in their common types, with the partition columns of the layout.

    Those of a history come from its folders, so that filters on them prune it; rows that
    are sent get them from their event time.
    """
    schema = common_types(sent, stored.select(*[named(c) for c in sent.columns]), sent.columns)
    columns = [named(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    folder = [named(c) for c in _folder_columns(group)]
    return (
        _with_folder_columns(sent, group).select(*columns, *folder),
        stored.select(*columns, *folder),
        [f.name for f in schema.fields],
    )


def _signed(df, group, columns, sign, buckets):
    return df.select(
        "*",
        _folder(group).alias(_FOLDER),
        F.pmod(F.xxhash64(named(group.record_identifier)), F.lit(buckets)).alias(_BUCKET),
        F.lit(sign).alias(_SIGN),
        *[(h.cast("decimal(20,0)") * sign).alias(name) for name, h in row_key(columns).items()],
    )


def _balance():
    """Sums that are all zero for equal multisets of rows, in whatever order they come."""
    return [F.sum(c).alias(c) for c in (_SIGN, *_HASHES)]


def _unequal():
    return reduce(or_, [F.col(c) != 0 for c in (_SIGN, *_HASHES)])


def differing_cells(sent, stored, group, buckets=BUCKETS):
    """(folder, bucket) of the hours, or dates, and buckets of identifiers that differ.

    Rows that are sent count for, those stored against: per cell the number of rows and two
    sums of 64-bit hashes are left, which combine on the map side, so a row per cell and task
    is shuffled, however hot a cell is.
    """
    sent, stored, columns = _sides(sent, stored, group)
    cells = _signed(sent, group, columns, 1, buckets).unionByName(
        _signed(stored, group, columns, -1, buckets)
    )
    return (
        cells.groupBy(_FOLDER, _BUCKET)
        .agg(*_balance())
        .where(_unequal())
        .select(F.col(_FOLDER).alias("folder"), F.col(_BUCKET).alias("bucket"))
    )


def rows_in(df, group, folders):
    """The rows in the given folders; a history reads no others."""
    return df.filter(_folder(group).isin(list(folders)))


def rows_sent_in(df, group, folders):
    """The rows that belong into the given folders, by their event time."""
    placed = _with_folder_columns(df, group)
    return rows_in(placed, group, folders).select(*[named(c) for c in df.columns])


def differences(sent, stored, group, buckets=BUCKETS):
    """One row per difference: identifier, event time, ``difference``, ``column``, ``sent``, ``stored``.

    A record is an identifier at an event time. It is ``missing`` if it was sent and not
    stored, ``extra`` if it was stored and not sent, ``repeated`` if it occurs several times
    on a side and not equally on both (``sent`` and ``stored`` are the numbers then), and
    else ``changed``, with a row per column that differs and both values as texts.

    ``sent`` has its declared types; ``stored`` is a history with its partition columns.
    Digests are compared first, see :func:`differing_cells`; then the rows of differing
    folders only are read again, and of those only rows of differing buckets are grouped.
    The names of differing folders come to the driver, which lists folders anyway.
    """
    spark = sent.sparkSession
    path = scratch_dir(spark, "differing-cells")
    differing_cells(sent, stored, group, buckets).write.parquet(path)
    cells = spark.read.schema("folder string, bucket long").parquet(path)
    folders = [r["folder"] for r in cells.select("folder").distinct().collect()]
    cells = cells.select(F.col("folder").alias(_FOLDER), F.col("bucket").alias(_BUCKET))
    sent, stored, columns = _sides(rows_sent_in(sent, group, folders), rows_in(stored, group, folders), group)
    both = _signed(sent, group, columns, 1, buckets).unionByName(
        _signed(stored, group, columns, -1, buckets)
    )
    records = _records(both.join(cells, [_FOLDER, _BUCKET], "left_semi"), group, columns)
    return _findings(records, group, columns)


def _records(both, group, columns):
    """One row per record that is not equally on both sides, with its values on either."""
    was_sent = F.col(_SIGN) > 0
    values = [
        F.max(F.when(was_sent if side == "sent" else ~was_sent, F.struct(named(c)))).alias(f"__{side}{i}")
        for i, c in enumerate(columns)
        for side in ("sent", "stored")
    ]
    return (
        both.groupBy(named(group.record_identifier), named(group.event_time))
        .agg(
            *_balance(),
            F.count_if(was_sent).alias("__n_sent"),
            F.count_if(~was_sent).alias("__n_stored"),
            *values,
        )
        .where(_unequal())
    )


def _finding(kind, column=None, sent=None, stored=None):
    def text(value):
        return (F.lit(None) if value is None else value).cast("string")

    return F.struct(
        F.lit(kind).alias("difference"),
        F.lit(column).cast("string").alias("column"),
        text(sent).alias("sent"),
        text(stored).alias("stored"),
    )


def _findings(records, group, columns):
    """Each record's differences as rows."""
    changed = []
    for i, c in enumerate(columns):
        sent, stored = (F.col(f"__{side}{i}").getField(c) for side in ("sent", "stored"))
        changed.append(F.when(~sent.eqNullSafe(stored), _finding(CHANGED, c, sent, stored)))
    n_sent, n_stored = F.col("__n_sent"), F.col("__n_stored")
    found = (
        F.when(n_stored == 0, F.array(_finding(MISSING)))
        .when(n_sent == 0, F.array(_finding(EXTRA)))
        .when((n_sent > 1) | (n_stored > 1), F.array(_finding(REPEATED, None, n_sent, n_stored)))
        .otherwise(F.array_compact(F.array(*changed)))
    )
    return records.select(named(group.record_identifier), named(group.event_time), F.inline(found))
