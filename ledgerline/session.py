"""Session settings this package relies on."""

import tempfile
import uuid

TIME_ZONE = "spark.sql.session.timeZone"
CHECKPOINT_DIR = "spark.checkpoint.dir"
SCRATCH = "ledgerline"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def pin_utc(spark):
    """Event times, hour directories and dates are all UTC."""
    if spark.conf.get(TIME_ZONE) != "UTC":
        spark.conf.set(TIME_ZONE, "UTC")
    return spark


def bound_batches(spark):
    """What goes to Python at once is bounded in bytes, as rows may be long; a set bound stays."""
    if not spark.conf.get(BATCH_BYTES, None):
        spark.conf.set(BATCH_BYTES, str(4 << 20))


def scratch_dir(spark, purpose):
    """A new folder path under the shared folder named by ``spark.checkpoint.dir``.

    What its user does not remove goes when the session's JVM ends in good order. Only a
    local session may go without that setting: a folder of this machine would be out of
    reach of the executors of a cluster.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"Set {CHECKPOINT_DIR} to a folder all executors share.")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/{SCRATCH}/{purpose}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder.getParent())
    # Only paths that exist can be marked, and writers want theirs not to exist.
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    system.delete(folder, True)
    return path


def remove_scratch(spark, path):
    """Delete a folder made by :func:`scratch_dir` once nothing reads it any more."""
    if f"/{SCRATCH}/" not in path:
        raise ValueError(f"Not a scratch folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
