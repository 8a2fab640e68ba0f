"""The keyed table: the online store when no external one is plugged in."""

import re
import time
import uuid
from collections import defaultdict
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.errors import BUCKETS_DIFFER, TABLE_BUSY, FeatureStoreError
from ledgerline.functions import named
from ledgerline.operators.latest import latest_per_record
from ledgerline.sinks.history import cluster_by

# Stored beside the features, so they must not be names of features.
BUCKET = "ledgerline_bucket"
SEQUENCE = "ledgerline_sequence"
DELETED = "ledgerline_deleted"
_BLOOM = "parquet.bloom.filter"
# Spark names the files of a write after it.
_WRITE = re.compile(r"part-\d+-([0-9a-f-]{36})")
VERSION_SCHEMA = "version bigint, buckets bigint"
BUCKETS = 64


class KeyedTable:
    """Puts are appended, reads return the latest record per identifier.

    A put costs as much as its batch, however large the table is, and replaying one
    with its sequence changes nothing: the same record wins again. Identifiers are spread
    over ``ledgerline_bucket=`` directories by hash, sorted within their files; a lookup of
    given identifiers opens only their directories and skips row groups without them.

    The number of buckets is kept with the table. ``buckets`` says how many a new table
    gets (64 unless given) and must agree with a table that is there.

    :meth:`compact` rewrites the table to one row per identifier in a new version
    folder, points to it and removes older ones. It refuses to run while a put does, and
    puts refuse while it runs; :meth:`unlock` clears marks that a killed driver has left.
    """

    def __init__(self, spark, path, group, buckets=None):
        self.spark, self.group = spark, group
        self.path, self._asked = path.rstrip("/"), buckets
        self._buckets = None

    # State beside the rows ----------------------------------------------------

    @property
    def _pointer(self):
        return f"{self.path}/versions"

    def _files(self, *parts):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, *parts):
        system, path = self._files(*parts)
        return system.exists(path)

    def _versions(self):
        return self.spark.read.schema(VERSION_SCHEMA).parquet(self._pointer)

    def version(self):
        """Number of the current version folder."""
        return self._versions().agg(F.max("version")).first()[0]

    @property
    def buckets(self):
        """Number of buckets, as kept with the table; raises if another one was asked for."""
        if self._buckets is None:
            if self._exists("versions"):
                kept = self._versions().agg(F.max("buckets")).first()[0]
                if self._asked is not None and self._asked != kept:
                    raise FeatureStoreError(
                        BUCKETS_DIFFER.format(path=self.path, stored=kept, given=self._asked)
                    )
                self._buckets = kept
            else:
                return BUCKETS if self._asked is None else self._asked
        return self._buckets

    def _point_to(self, version, mode):
        row = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.lit(self.buckets).cast("bigint").alias("buckets"),
        )
        row.write.mode(mode).parquet(self._pointer)

    def _folder(self, version):
        return f"{self.path}/v={version}"

    # One writer of the other kind at a time -------------------------------------

    def _busy(self, what):
        return FeatureStoreError(TABLE_BUSY.format(path=self.path, what=what))

    @contextmanager
    def _putting(self, wait=0):
        """A mark while a put runs. It is made before the look for a compaction, which
        looks for marks after making its own: one of the two sees the other. A put that
        waits takes its mark back meanwhile, so the compaction is not refused for it."""
        system, mark = self._files("_puts", uuid.uuid4().hex)
        until = time.monotonic() + wait
        system.createNewFile(mark)
        try:
            while self._exists("_compacting"):
                if time.monotonic() >= until:
                    raise self._busy("it is being compacted")
                system.delete(mark, False)
                time.sleep(min(1.0, wait))
                system.createNewFile(mark)
            yield
        finally:
            system.delete(mark, False)

    @contextmanager
    def _compacting(self):
        system, mark = self._files("_compacting")
        if not system.createNewFile(mark):
            raise self._busy("it is being compacted")
        try:
            _, puts = self._files("_puts")
            if system.exists(puts) and system.listStatus(puts):
                raise self._busy("puts are under way")
            yield
        finally:
            system.delete(mark, False)

    def unlock(self):
        """Clear the marks of puts and compactions that ended without doing so."""
        for name in ("_puts", "_compacting"):
            system, path = self._files(name)
            system.delete(path, True)

    # Writing --------------------------------------------------------------------

    def _schema(self):
        return T.StructType(
            self.group.schema().fields
            + [
                T.StructField(SEQUENCE, T.LongType()),
                T.StructField(DELETED, T.BooleanType()),
                T.StructField(BUCKET, T.LongType()),
            ]
        )

    def _bucket(self, identifier):
        return F.pmod(F.xxhash64(identifier), F.lit(self.buckets))

    def _write(self, rows, folder, mode, **more):
        identifier = named(self.group.record_identifier)
        bucketed = rows.withColumn(BUCKET, self._bucket(identifier))
        # The writer sorts by bucket anyway; with the identifier, row groups can be skipped.
        rows = cluster_by(bucketed, [BUCKET]).sortWithinPartitions(F.col(BUCKET), identifier)
        # Each put spans all identifiers, so bounds do not tell which has one; a Bloom filter
        # does, of a size that follows the number of identifiers.
        column = self.group.record_identifier
        options = {f"{_BLOOM}.enabled#{column}": "true", f"{_BLOOM}.adaptive.enabled": "true"}
        options |= more
        rows.write.partitionBy(BUCKET).options(**options).mode(mode).parquet(folder)

    def put(self, df, sequence=0, wait=0):
        """Append cast rows; ``sequence`` decides between equal event times.

        It is a number for the whole batch or a column of ``df`` to copy it from. Only
        the latest row per identifier of the batch is written. ``wait`` says for how many
        seconds a compaction that is under way is waited for; then the put is refused.
        """
        self._put(df, sequence, wait, False)

    def delete(self, df, sequence=0, wait=0):
        """Delete the records of identifiers as of an event time, the two columns of ``df``.

        A deletion is a record of its own: reads leave an identifier out whose latest record
        is one, and a record with a later event time brings it back. ``compact`` keeps
        deletions, so that an earlier record that arrives later stays deleted.
        """
        self._put(df, sequence, wait, True)

    def _put(self, df, sequence, wait, deleted):
        order = named(sequence).cast("bigint") if isinstance(sequence, str) else F.lit(sequence)
        rows = df.withColumns({SEQUENCE: order.cast("bigint"), DELETED: F.lit(deleted)})
        absent = [f for f in self.group.schema().fields if f.name not in df.columns]
        rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
        with self._putting(wait):
            if not self._exists("versions"):
                self._point_to(0, "ignore")
            self._write(
                latest_per_record(rows, self.group, SEQUENCE),
                self._folder(self.version()),
                "append",
            )

    # Reading --------------------------------------------------------------------

    def _log(self):
        return self.spark.read.schema(self._schema()).parquet(self._folder(self.version()))

    def _latest(self, rows):
        """The latest record per identifier among rows of the log, without deleted ones."""
        latest = latest_per_record(rows.drop(BUCKET), self.group, SEQUENCE)
        there = ~F.coalesce(F.col(DELETED), F.lit(False))
        return latest.filter(there).drop(SEQUENCE, DELETED)

    def read(self):
        """The latest record of every identifier."""
        return self._latest(self._log())

    def get(self, *identifiers):
        """The latest records of a few given identifiers."""
        id_type = self.group.schema()[self.group.record_identifier].dataType
        wanted = [F.lit(i).cast(id_type) for i in identifiers]
        rows = self._log().filter(
            F.col(BUCKET).isin([self._bucket(w) for w in wanted])
            & named(self.group.record_identifier).isin(wanted)
        )
        return self._latest(rows)

    def lookup(self, ids):
        """The latest records whose identifier is in the one column of ``ids``.

        Identifiers are made distinct first, which combines on the map side, so one that
        is wanted often is one row in the join. The semi-join comes next, so only wanted
        rows are grouped. The log has one row per identifier and put, so no key is hot in
        it; without a broadcast the grouping reuses the partitioning of the join.
        """
        identifier = self.group.record_identifier
        wanted = ids.select(named(ids.columns[0]).alias(identifier)).distinct()
        rows = self._log().join(wanted, identifier, "left_semi")
        return self._latest(rows)

    def compact(self, keep=1):
        """Rewrite to one row per identifier, switch to the new folder, drop old ones.

        ``keep`` folders before the new one stay, for reads that are still under way.
        """
        with self._compacting():
            current = self.version()
            rows = latest_per_record(self._log().drop(BUCKET), self.group, SEQUENCE)
            self._write(rows, self._folder(current + 1), "overwrite")
            self._point_to(current + 1, "append")
            for version in range(current + 1 - keep):
                if self._exists(f"v={version}"):
                    system, path = self._files(f"v={version}")
                    system.delete(path, True)

    def _touched(self):
        """Buckets with files of several writes; those of a single one are latest records only."""
        system, folder = self._files(f"v={self.version()}")
        writes, files = defaultdict(set), system.listFiles(folder, True)
        while files.hasNext():
            path = files.next().getPath()
            write = _WRITE.match(path.getName())
            if write:
                writes[int(path.getParent().getName().removeprefix(f"{BUCKET}="))].add(write.group(1))
        return sorted(bucket for bucket, found in writes.items() if len(found) > 1)

    def compact_touched(self):
        """Rewrite, in place, only buckets that puts have added to since they were rewritten.

        Returns their number. Other buckets keep their files, so the cost follows what was
        put, not the size of the table. Files of touched buckets are replaced when all are
        written, by dynamic partition overwrite: nobody should read the table meanwhile, and
        a driver that ends during the replacement leaves rows in Spark's staging folder.
        With readers at work, :meth:`compact` is the one to use.
        """
        with self._compacting():
            touched = self._touched()
            if touched:
                rows = self._log().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
                latest = latest_per_record(rows, self.group, SEQUENCE)
                self._write(
                    latest, self._folder(self.version()), "overwrite", partitionOverwriteMode="dynamic"
                )
            return len(touched)
