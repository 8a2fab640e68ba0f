"""What an ingest with a token has done, so that running it again repeats nothing."""

import hashlib
import time

from pyspark.sql import functions as F

SCHEMA = "slice string, state string, at bigint"
STAGED, BEGUN, DONE, CLOSED = "staged", "begun", "done", "closed"


class Ledger:
    """Entries of one token, kept as rows below ``root``: staged, slices begun and done, closed.

    An entry is a row of its own and is only ever added, by Spark's commit protocol, so a
    driver that dies leaves either the whole entry or none. Each slice that was begun has a
    mark, a time in microseconds that no other slice of the token has and that its rows carry
    as their write time: what an attempt that was cut off left behind can be told from rows
    of other ingests. One ingest at a time may use a token.
    """

    def __init__(self, spark, root, token):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{hashlib.sha256(token.encode()).hexdigest()[:32]}"
        self._marks, self._done, self._staged, self._closed = {}, set(), False, False
        for row in self._entries():
            self._take(row["slice"], row["state"], row["at"])

    @property
    def staged_path(self):
        """Where the input is kept until all its slices are done."""
        return f"{self.path}/staged"

    def _entries(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/entries")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return []
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/entries").collect()

    def _take(self, value, state, at):
        self._staged |= state == STAGED
        self._closed |= state == CLOSED
        if state == BEGUN:
            self._marks[value] = at
        if state == DONE:
            self._done.add(value)

    def _add(self, value, state, at=None):
        row = self.spark.range(1).select(
            F.lit(value).cast("string").alias("slice"),
            F.lit(state).alias("state"),
            F.lit(at).cast("bigint").alias("at"),
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/entries")
        self._take(value, state, at)

    @property
    def staged(self):
        return self._staged

    @property
    def closed(self):
        return self._closed

    @property
    def slices(self):
        """Slices that were begun, in the order of ingest."""
        return sorted(self._marks, key=self._marks.get)

    def finished(self, value):
        return value in self._done

    def note_staged(self):
        self._add(None, STAGED)

    def begin(self, value):
        """(mark of the slice, whether an earlier attempt had begun it)."""
        if value in self._marks:
            return self._marks[value], True
        mark = max([time.time_ns() // 1000, *(m + 1 for m in self._marks.values())])
        self._add(value, BEGUN, mark)
        return mark, False

    def finish(self, value):
        self._add(value, DONE)

    def close(self):
        self._add(None, CLOSED)
