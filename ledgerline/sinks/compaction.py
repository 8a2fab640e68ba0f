"""Small files of a history packed into larger ones, folder by folder."""

import uuid
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerline.errors import FeatureStoreError
from ledgerline.functions import named
from ledgerline.functions.history import HOUR_COLUMNS, date_column
from ledgerline.groups import TABLE_FORMAT
from ledgerline.sinks.history import WRITE_OPTIONS
from ledgerline.sources.history import history_schema

HIDDEN = "_compaction-"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FILE, _BIN = "ledgerline_file", "ledgerline_bin"


def packed(sizes, target):
    """Bins of names whose sizes add up to at most ``target``, largest first, first that fits.

    ``sizes`` maps names to sizes below ``target``. A bin of one name saves nothing and is
    left out.
    """
    bins = []
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        for b in bins:
            if b[0] + sizes[name] <= target:
                b[0] += sizes[name]
                b[1].append(name)
                break
        else:
            bins.append([sizes[name], [name]])
    return [names for _, names in bins if len(names) > 1]


class _Folder:
    """The files of a history, by Hadoop's file system."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        root = self._Path(self.path)
        self.system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.base = self.system.makeQualified(root).toString().rstrip("/")

    def at(self, relative):
        return self._Path(f"{self.path}/{relative}")

    def exists(self, relative):
        return self.system.exists(self.at(relative))

    def files(self, below="", hidden=False):
        """{name relative to ``below``: size} of all files below a folder."""
        start = self.at(below) if below else self._Path(self.path)
        prefix = f"{self.base}/{below}".rstrip("/") + "/"
        found, listed = {}, self.system.listFiles(start, True)
        while listed.hasNext():
            status = listed.next()
            name = status.getPath().toString().removeprefix(prefix)
            if hidden or not any(part[0] in "_." and "=" not in part for part in name.split("/")):
                found[name] = status.getLen()
        return found

    def move(self, source, target):
        target = self.at(target)
        self.system.mkdirs(target.getParent())
        if not self.system.rename(self.at(source), target):
            raise OSError(f"Could not move {source}")

    def remove(self, relative):
        self.system.delete(self.at(relative), True)

    def under_way(self):
        root = self._Path(self.path)
        listed = self.system.listStatus(root) if self.system.exists(root) else []
        names = [s.getPath().getName() for s in listed]
        return [n for n in names if n.startswith(HIDDEN)]


def finish_compaction(spark, path):
    """Bring a compaction to its end that its driver did not; without one nothing happens.

    The list of files it replaces is written in one piece after all new files are there.
    Without the list nothing has been replaced, and the new files go. With it, what is
    left to be moved is moved.
    """
    folder = _Folder(spark, path)
    for work in folder.under_way():
        if folder.exists(f"{work}/replaces"):
            _swap(folder, work)
        folder.remove(work)


def _swap(folder, work):
    rows = folder.spark.read.schema("name string").parquet(f"{folder.path}/{work}/replaces")
    for (name,) in rows.collect():
        if folder.exists(name):
            folder.move(name, f"{work}/old/{name}")
    new = folder.files(f"{work}/new") if folder.exists(f"{work}/new") else {}
    for name in new:
        folder.move(f"{work}/new/{name}", name)


def compact_history(spark, group, path, target=None):
    """Pack small files of a history of files into larger ones; returns how many there were and are.

    Files below half of ``target`` bytes, Spark's advisory partition size unless given, are
    packed within their hour or date into files of up to that size. Folders are chosen
    from a listing; others are not read. Rows stay as they are, with their audit columns. New
    files are written aside; then the old ones are moved away and the new ones in, so nobody
    should read the history meanwhile. :func:`finish_compaction` goes on after a failure.
    A stream's folder, whose sink keeps a list of its files, is refused.
    """
    folder = _Folder(spark, path)
    if folder.exists("_spark_metadata"):
        raise FeatureStoreError(f"The files of a stream at {path} cannot be packed.")
    finish_compaction(spark, path)
    if target is None:
        bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        target = bytes_of(spark.conf.get(ADVISORY))
    small = defaultdict(dict)
    for name, size in folder.files().items():
        if size < target / 2:
            small[name.rpartition("/")[0]][name] = size
    bins = [names for sizes in small.values() for names in packed(sizes, target)]
    before = sum(map(len, bins))
    if not bins:
        return 0, 0
    dated = group.offline.table_format == TABLE_FORMAT
    columns = (date_column(group),) if dated else HOUR_COLUMNS
    work = f"{HIDDEN}{uuid.uuid4().hex}"
    bin_of = spark.createDataFrame(
        [(f"{folder.base}/{name}", i) for i, names in enumerate(bins) for name in names],
        f"{_FILE} string, {_BIN} int",
    )
    rows = (
        spark.read.schema(history_schema(group, columns))
        .option("basePath", folder.path)
        .parquet(*[f"{folder.path}/{name}" for names in bins for name in names])
    )
    # A bin is one task's, and its rows are of one folder.
    placed = rows.withColumn(_FILE, F.col("_metadata.file_path")).join(bin_of, _FILE)
    packed_rows = placed.drop(_FILE).repartition(len(bins), _BIN)
    order = [named(group.event_time)] if dated else []
    (
        packed_rows.sortWithinPartitions(*[named(c) for c in columns], _BIN, *order)
        .drop(_BIN)
        .write.partitionBy(*columns)
        .options(**WRITE_OPTIONS)
        .parquet(f"{folder.path}/{work}/new")
    )
    after = len(folder.files(f"{work}/new"))
    names = spark.createDataFrame([(n,) for b in bins for n in b], "name string")
    names.coalesce(1).write.parquet(f"{folder.path}/{work}/replaces-unfinished")
    folder.move(f"{work}/replaces-unfinished", f"{work}/replaces")
    _swap(folder, work)
    folder.remove(work)
    return before, after
