"""Binary files in the shared folder, written and read by tasks."""

import re
import uuid

from pyarrow import fs

from ledgerline.session import scratch_dir


def shared_folder(spark, purpose):
    """The URI of a new folder that driver and executors share."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, purpose))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def file_system(uri):
    """The Arrow file system of a URI as Hadoop writes it, and the path in it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def new_name(stem, partition, suffix):
    """A name of its own for each attempt: only names that a finished job hands on count.

    A task that is tried again, or twice at once, leaves a file that nothing refers to.
    """
    return f"{stem}-{partition:05d}-{uuid.uuid4().hex}{suffix}"
