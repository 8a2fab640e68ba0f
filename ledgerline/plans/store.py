"""The feature store: checks, routing and writes of one ingest."""

import time
import uuid
from contextlib import contextmanager, nullcontext
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.errors import (
    FAILED_RECORDS,
    OFFLINE_NOT_ENABLED,
    REPEATED_GROUP,
    RecordIngestionError,
    ValidationError,
)
from ledgerline.functions import named
from ledgerline.functions.casts import CHECKED_TYPES
from ledgerline.functions.history import WRITE_TIME, event_timestamp, mark_time
from ledgerline.functions.resource_ids import ResourceIdFormat
from ledgerline.groups import (
    OFFLINE_STORE,
    ONLINE_STORE,
    TABLE_FORMAT,
    FeatureGroup,
    check_created,
    check_target_stores,
    feature_definitions,
)
from ledgerline.operators.checks import cast_features, check_rows, row_errors, watched
from ledgerline.operators.differences import differences
from ledgerline.operators.names import ERROR_COLUMN, check_names
from ledgerline.operators.outcomes import (
    failed_records,
    put_outcomes,
    put_target,
    stored_records,
)
from ledgerline.operators.partitions import spread_for_puts
from ledgerline.operators.slices import SLICE, with_time_slice
from ledgerline.session import pin_utc, remove_scratch, scratch_dir
from ledgerline.sinks.compaction import compact_history
from ledgerline.sinks.history import append_history, check_format, cluster_by
from ledgerline.sinks.keyed import KeyedTable
from ledgerline.sinks.ledger import Ledger
from ledgerline.sinks.publish import append_if_valid
from ledgerline.sources.catalog import (
    CATALOG_SCHEMA,
    catalog_frame,
    current_groups,
    find_group,
)
from ledgerline.sources.history import (
    in_catalog,
    read_dates,
    read_hours,
    read_range,
    read_table,
    rows_between,
)
from ledgerline.streaming.ingest import ingest_stream, merge_stream
from ledgerline.streaming.puts import failed_puts, put_stream

# How the writer names the directory of a null partition value.
NO_SLICE = "__HIVE_DEFAULT_PARTITION__"
_EPOCH = datetime(1970, 1, 1)


def _with_castable_columns(df):
    """Values other than texts and numbers as the text that a record would hold."""
    return df.select(
        *[
            named(f.name)
            if isinstance(f.dataType, CHECKED_TYPES)
            else named(f.name).cast("string").alias(f.name)
            for f in df.schema.fields
        ]
    )


class FeatureStore:
    """Ingests DataFrames into feature groups kept below ``root``.

    ``root`` is a folder all executors share. ``put(client, record, target)``, with
    ``open_client()`` once per partition, plugs in an external online store; ``target``
    is a dictionary with the group's name and the target stores, see ``put_target``. Without it
    online records go to a keyed Spark table, of ``buckets`` buckets where it is new.
    """

    def __init__(
        self,
        spark,
        root,
        put=None,
        open_client=None,
        id_format=ResourceIdFormat(),
        buckets=None,
    ):
        self.spark = pin_utc(spark)
        self.root = root.rstrip("/")
        self._put, self._open_client = put, open_client
        self._id_format, self._buckets = id_format, buckets
        self._failures = None

    # Groups -----------------------------------------------------------------

    @property
    def _catalog_path(self):
        return f"{self.root}/catalog"

    def register(self, *groups):
        """Add groups to the catalogue; a name that is there already is replaced."""
        names = [g.name for g in groups]
        for name in names:
            if names.count(name) > 1:
                raise ValidationError(REPEATED_GROUP.format(group=name))
        frame = catalog_frame(self.spark, groups, time.time_ns())
        frame.coalesce(1).write.mode("append").parquet(self._catalog_path)

    def catalog(self):
        """The groups as they were registered last."""
        rows = self.spark.read.schema(CATALOG_SCHEMA).parquet(self._catalog_path)
        return current_groups(rows)

    def group(self, group):
        """A group itself, or the one a name or resource identifier stands for."""
        if isinstance(group, FeatureGroup):
            return group
        name = self._id_format.group_name(group) if ":" in group else group
        return find_group(self.catalog(), name)

    @staticmethod
    def load_feature_definitions(df):
        return feature_definitions(df)

    # Ingest -----------------------------------------------------------------

    def ingest(
        self,
        df,
        group,
        target_stores=None,
        strict=False,
        stage_input=False,
        rows_checked=False,
        clustered=False,
        check_records=False,
        sequence=None,
        one_pass=True,
        token=None,
    ):
        """Check ``df`` against the group and write it to the target stores.

        ``None`` means all enabled stores. Offline only: one invalid row refuses the
        whole input, and nothing of it is ever visible. With the online store, rows are judged
        one by one: failed ones are kept for :meth:`failed_records` and reported by a
        :class:`RecordIngestionError` after all others are stored.

        The input is evaluated once. Offline only, its rows are checked while they are
        written to a hidden folder of the history, whose files are then moved into place.
        ``one_pass=False``, for stores where moving a file copies it, checks first and writes
        then, which evaluates the input twice, as does a history in a catalogue;
        ``stage_input=True`` writes it to the shared checkpoint folder before that.
        With the online store outcomes are written before anything else reads them.

        ``rows_checked=True`` says that
        ``check_rows`` has passed, ``clustered=True`` that the tasks of the input hold few
        hours (or dates) each, so that the history is written without a shuffle.
        ``check_records=True`` has rows checked before an external put also where no
        history is written. ``sequence`` decides between equal event times in the keyed
        table; it is the time of the ingest unless given, as it should be for a replay.

        ``token`` names the ingest: run again with the same one after a failure, it goes on
        with the rows that were staged for it and writes none twice. See :meth:`ingest_by_time`.
        """
        group, stores = self._admit(df, group, target_stores)
        options = (target_stores, strict, clustered, check_records, sequence)
        if token is not None:
            self._ingest_slices(df, group, stores, None, token, *options)
            return
        staged = stage_input and ONLINE_STORE not in stores
        with self._staged_if(staged, df) as rows:
            if ONLINE_STORE in stores:
                with self._failures_in(group) as kept:
                    self._ingest_records(rows, group, stores, *options, f"{kept}/0")
            else:
                in_passing = one_pass and not staged and not in_catalog(self.spark, group)
                self._ingest_history(rows, group, strict, rows_checked, clustered, in_passing)

    def ingest_by_time(
        self, df, group, unit="day", target_stores=None, strict=False, sequence=None, token=None
    ):
        """Ingest ``df`` one ``unit`` of event time after the other; returns the slices.

        The outcome is that of one ingest. The input is evaluated once: it is written
        partitioned by slice, and checked as a whole meanwhile if offline only; each slice
        then reads only its own directory. A slice no wider than a directory of the history
        is not shuffled again. ``sequence`` is as in :meth:`ingest`.

        With a ``token`` a ledger keeps what is done. After a failure, of the driver too, the
        same call goes on: finished slices are passed over, and of the one that was under way
        only those rows are appended that the history does not hold yet. Staged rows stay
        until all slices are done, so ``df`` is not evaluated again, and need not be
        repeatable. A call with the token of an ingest that is finished writes nothing. Rows
        of an external put may be put again, as after any retry.
        """
        group, stores = self._admit(df, group, target_stores)
        by_date = group.offline_enabled and group.offline.table_format == TABLE_FORMAT
        clustered = unit in (("hour", "day") if by_date else ("hour",))
        return self._ingest_slices(
            df, group, stores, unit, token, target_stores, strict, clustered, False, sequence
        )

    def _ingest_slices(
        self, df, group, stores, unit, token, asked, strict, clustered, check_records, sequence
    ):
        """Ingest slice by slice, or with no ``unit`` as one slice, and keep account of it."""
        ledger = None
        if token is not None:
            ledger = Ledger(self.spark, f"{self.root}/ledger/{group.name}", token)
            if ledger.closed:
                self._report_failures(self._failure_path(group, ledger))
                return ledger.slices
        offline_only = ONLINE_STORE not in stores
        path = ledger.staged_path if ledger else scratch_dir(self.spark, "slices")
        try:
            staged, slices = self._staged_slices(df, group, unit, strict, offline_only, path, ledger)
            with self._failures_in(group, ledger) if not offline_only else nullcontext() as kept:
                for number, value in enumerate(slices):
                    if ledger and ledger.finished(value):
                        continue
                    mark, resumed = ledger.begin(value) if ledger else (None, False)
                    rows = staged
                    if unit is not None:
                        rows = staged.filter(F.col(SLICE).eqNullSafe(value)).drop(SLICE)
                    if offline_only:
                        self._ingest_history(
                            rows, group, strict, True, clustered, False, mark, resumed
                        )
                    else:
                        order = mark if sequence is None else sequence
                        self._ingest_records(
                            rows, group, stores, asked, strict, clustered, check_records, order,
                            f"{kept}/{number}", mark, resumed,
                        )
                    if ledger:
                        ledger.finish(value)
                if ledger:
                    ledger.close()
        finally:
            if not ledger or ledger.closed:
                self._remove(path)
        return slices

    def _staged_slices(self, df, group, unit, strict, offline_only, path, ledger):
        """The rows as kept below ``path``, which are written unless they are there, and the slices."""
        rows = _with_castable_columns(df)
        verdict = None
        if offline_only:
            rows, verdict = watched(rows, group, strict)
        columns = []
        if unit is not None:
            rows, columns = with_time_slice(rows, group, unit), [SLICE]
            rows = cluster_by(rows, columns)
        if not (ledger and ledger.staged):
            rows.write.mode("overwrite").partitionBy(*columns).parquet(path)
            if verdict:
                try:
                    verdict()
                except ValidationError:
                    self._remove(path)
                    raise
            if ledger:
                ledger.note_staged()
        slices = [None] if unit is None else self._slice_names(path)
        return self.spark.read.schema(rows.schema).parquet(path), slices

    def delete(self, df, group, target_stores=None, sequence=None):
        """Delete the records of identifiers as of an event time, the two columns of ``df``.

        The history gets a row per deletion, with ``is_deleted`` true and no other feature,
        and keeps what it has. The keyed table leaves an identifier out whose latest record
        is a deletion, see ``KeyedTable.delete``. One invalid row refuses all of them. An
        external store is not told; target the offline store then.
        """
        group, stores = self._admit(df, group, target_stores)
        keys = [group.record_identifier, group.event_time]
        if sorted(df.columns) != sorted(keys):
            raise ValidationError(f"A deletion has the columns {', '.join(keys)} and no others.")
        if ONLINE_STORE in stores and self._put is not None:
            raise ValidationError("Records of an external store are not deleted by this one.")
        rows, verdict = watched(_with_castable_columns(df), group)
        with self._staged_if(True, rows) as staged:
            verdict()
            deleted = cast_features(staged, group)
            if ONLINE_STORE in stores:
                order = time.time_ns() if sequence is None else sequence
                self.online(group).delete(deleted, order)
            if OFFLINE_STORE in stores:
                absent = [f for f in group.schema().fields if f.name not in keys]
                whole = deleted.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
                path = self.history_path(group)
                append_history(whole, group, path, deleted=True)

    def _slice_names(self, path):
        """Slices in ascending order, the one without a time first: names of directories."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        values = [n.removeprefix(f"{SLICE}=") for n in names if n.startswith(f"{SLICE}=")]
        return [None] * (NO_SLICE in values) + sorted(v for v in values if v != NO_SLICE)

    def _admit(self, df, group, target_stores):
        """The group and its target stores, after all checks that need no rows."""
        group = self.group(group)
        check_created(group)
        stores = check_target_stores(group, target_stores)
        if stores is None:
            stores = group.enabled_stores
        self._failures = None
        if OFFLINE_STORE in stores or not stores:
            if not group.offline_enabled:
                raise ValidationError(OFFLINE_NOT_ENABLED.format(group=group.name))
            check_format(self.spark, group)
        check_names(df.columns, group)
        return group, stores

    @contextmanager
    def _staged_if(self, wanted, df):
        """``df``, or its rows written to the shared scratch folder for the time being."""
        if not wanted:
            yield df
            return
        path = scratch_dir(self.spark, "staged")
        try:
            df.write.parquet(path)
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            remove_scratch(self.spark, path)

    def _ingest_history(
        self, df, group, strict, rows_checked, clustered, in_passing, mark=None, resumed=False
    ):
        """Append rows to the history, checked before, in passing, or first of all."""
        if in_passing and not rows_checked:
            append_if_valid(df, group, self.history_path(group), strict, clustered)
            return
        if not rows_checked:
            check_rows(df, group, strict)
        self._append(df, group, strict, clustered, mark, resumed)

    def _append(self, df, group, strict, clustered, mark=None, resumed=False):
        rows = cast_features(df, group, strict)
        if resumed:
            rows = self._not_appended(rows, group, mark)
        append_history(rows, group, self.history_path(group), clustered, mark)

    def _not_appended(self, rows, group, mark):
        """``rows`` without those that an attempt which was cut off appended under its mark.

        A row that occurs several times is left out as often as it is there. Of the history
        only the range of event times of ``rows`` is read.
        """
        if not in_catalog(self.spark, group) and not self._is_folder(self.history_path(group)):
            return rows
        time = event_timestamp(group)
        low, high = rows.agg(
            F.unix_micros(F.min(time)), F.unix_micros(F.max(time))
        ).first()
        if low is None:
            return rows
        try:
            start, end = (_EPOCH + timedelta(microseconds=m) for m in (low, high + 1))
            written = self._own_history_between(group, start, end)
        except OverflowError:
            # Times beyond the year 9999.
            written = self.history(group)
        written = written.filter(F.col(WRITE_TIME) == mark_time(mark))
        return rows.exceptAll(written.select(*[named(c) for c in rows.columns]))

    def _ingest_records(
        self, df, group, stores, asked, strict, clustered, check_records, sequence, kept,
        mark=None, resumed=False,
    ):
        """Put the rows, append those accepted to the history, keep the others in ``kept``.

        Outcomes are written once before they are read, so that no row is put or checked
        twice, nor judged differently by two stores where the input is not repeatable.
        """
        with_history = OFFLINE_STORE in stores
        if self._put is None:
            rows = _with_castable_columns(df)
            errors = F.nullif(row_errors(rows, group, strict), F.lit(""))
            outcomes = rows.withColumn(ERROR_COLUMN, errors)
        else:
            rows = spread_for_puts(_with_castable_columns(df) if with_history else df)
            # The external store judges values, unless the history needs them castable.
            precheck = None
            if with_history or check_records:
                checked = rows if with_history else _with_castable_columns(rows)
                precheck = F.nullif(row_errors(checked, group, strict), F.lit(""))
            target = put_target(group.name, asked)
            outcomes = put_outcomes(rows, self._put, self._open_client, precheck, target)
        with self._staged_if(True, outcomes) as done:
            if self._put is None:
                accepted = cast_features(stored_records(done), group, strict)
                self.online(group).put(
                    accepted, time.time_ns() if sequence is None else sequence
                )
            if with_history:
                self._append(stored_records(done), group, strict, clustered, mark, resumed)
            failed_records(done).write.mode("overwrite").parquet(kept)

    def _failure_path(self, group, ledger=None):
        name = ledger.path.rsplit("/", 1)[1] if ledger else uuid.uuid4().hex
        return f"{self.root}/failures/{group.name}/{name}"

    @contextmanager
    def _failures_in(self, group, ledger=None):
        """A folder with one of failed rows per slice; in the end they are reported if any."""
        path = self._failure_path(group, ledger)
        yield path
        self._report_failures(path)

    def _report_failures(self, path):
        if not self._is_folder(path):
            return
        self._failures = self.spark.read.option("recursiveFileLookup", True).parquet(path)
        count = self._failures.count()
        if count:
            raise RecordIngestionError(FAILED_RECORDS.format(count=count))

    def _remove(self, path):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _is_folder(self, path):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def remove_failures(self, group, keep=1):
        """Remove the folders of failed rows but the ``keep`` newest; returns how many went.

        Each online ingest leaves one. Frames of :meth:`failed_records` that are still in use
        read from theirs.
        """
        root = f"{self.root}/failures/{self.group(group).name}"
        if not self._is_folder(root):
            return 0
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(root)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = sorted(system.listStatus(folder), key=lambda s: -s.getModificationTime())
        for status in found[keep:]:
            system.delete(status.getPath(), True)
        return max(len(found) - keep, 0)

    def failed_records(self):
        """Rows the last online ingest could not store, with their error.

        None before any ingest and after one that was offline only.
        """
        return self._failures

    # Reading back -----------------------------------------------------------

    def history_path(self, group):
        return group.offline.path or f"{self.root}/offline/{group.name}"

    def _streamed_root(self, group):
        """Beside the path of the group, where it has one: any store that knows it finds them."""
        if group.offline.path:
            return f"{group.offline.path.rstrip('/')}-streamed"
        return f"{self.root}/streamed/{group.name}"

    def _history_paths(self, group):
        """The folders of batches and streams that are there; that of batches if none is."""
        paths = [self.history_path(group), *self._streams(group)]
        return [p for p in paths if self._is_folder(p)] or paths[:1]

    def history(self, group):
        """The history of a group: what batches and what streams have written."""
        group = self.group(group)
        if in_catalog(self.spark, group):
            return read_table(self.spark, group)
        read = read_dates if group.offline.table_format == TABLE_FORMAT else read_hours
        parts = [read(self.spark, group, p) for p in self._history_paths(group)]
        return reduce(DataFrame.unionByName, parts)

    def history_between(self, group, start, end):
        """The rows of :meth:`history` whose event time is in [start, end).

        Times are datetimes, dates or ISO texts, in UTC unless they name a zone. Of a history
        of files only the folders are listed and read that the range touches, see
        ``sources.history.read_range``.
        """
        group = self.group(group)
        if in_catalog(self.spark, group):
            return rows_between(read_table(self.spark, group), group, start, end)
        parts = [
            read_range(self.spark, group, p, start, end) for p in self._history_paths(group)
        ]
        return reduce(DataFrame.unionByName, parts)

    def compact_history(self, group, target=None):
        """Pack small files of the history that batches wrote, see ``sinks.compaction``."""
        group = self.group(group)
        if in_catalog(self.spark, group):
            raise ValidationError("A table of a catalogue is compacted by its catalogue.")
        return compact_history(self.spark, group, self.history_path(group), target)

    def differences(self, df, group):
        """What differs between the valid rows of ``df`` and the history, as rows.

        See ``operators.differences``: only hours, or dates, that differ are read twice.
        """
        group = self.group(group)
        sent = cast_features(_with_castable_columns(df), group)
        return differences(sent, self.history(group), group)

    def _own_history_between(self, group, start, end):
        """As :meth:`history_between`, of batches alone."""
        if in_catalog(self.spark, group):
            return rows_between(read_table(self.spark, group), group, start, end)
        return read_range(self.spark, group, self.history_path(group), start, end)

    def _streams(self, group):
        """The folders of the group's streams: one for each name it was streamed under."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self._streamed_root(group))
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = system.listStatus(root) if system.exists(root) else []
        return sorted(f"{self._streamed_root(group)}/{s.getPath().getName()}" for s in found)

    def online(self, group):
        group = self.group(group)
        return KeyedTable(
            self.spark, f"{self.root}/online/{group.name}", group, self._buckets
        )

    # Streams ----------------------------------------------------------------

    def ingest_stream(
        self,
        stream,
        group,
        name="stream",
        target_stores=None,
        trigger=None,
        strict=False,
        check_records=False,
    ):
        """Stream into a group's stores; the queries started, the last the quarantine's.

        The history gets the group's layout, in a folder of its own per ``name`` that
        :meth:`history` reads with the others; the keyed table gets a put per micro-batch.
        Faulty rows are kept with their error, see :meth:`quarantined`. ``name`` stands
        for one stream with its checkpoints: started again, it goes on where it was.

        With an external put it is one query, which keeps the rows that could not be put, and
        with ``check_records`` the faulty ones instead of putting them. Such a stream goes to
        that store only, since a history would have to wait for its outcomes.
        """
        group, stores = self._admit(stream, group, target_stores)
        base = f"{self.root}/streams/{group.name}/{name}"
        queries = []
        if ONLINE_STORE in stores and self._put is not None:
            if OFFLINE_STORE in stores:
                raise ValidationError("A stream with an external put goes to that store only.")
            put = put_stream(
                stream,
                group,
                self._put,
                self._open_client,
                f"{base}/quarantine",
                f"{base}/puts",
                put_target(group.name, target_stores),
                trigger,
                check_records,
                strict,
            )
            return (put,)
        if ONLINE_STORE in stores:
            merge, faulty = merge_stream(
                stream, self.online(group), f"{base}/quarantine", f"{base}/online", trigger, strict
            )
            queries.append(merge)
        if OFFLINE_STORE in stores:
            if in_catalog(self.spark, group):
                raise ValidationError("A stream is not written to a table of a catalogue.")
            # With both stores the quarantine of the merge holds the faulty rows already.
            history, *more = ingest_stream(
                stream,
                group,
                f"{self._streamed_root(group)}/{name}",
                None if queries else f"{base}/quarantine",
                f"{base}/offline",
                trigger,
                strict,
            )
            queries.append(history)
            faulty = more[0] if more else faulty
        return (*queries, faulty)

    def quarantined(self, group, name="stream"):
        """The faulty rows of a stream, or those that could not be put, with their errors."""
        group = self.group(group)
        return failed_puts(self.spark, f"{self.root}/streams/{group.name}/{name}/quarantine")
