"""Check and append in one pass: rows go to a hidden folder, published if none is at fault."""

import uuid

from ledgerline.operators.checks import cast_features, watched
from ledgerline.sinks.history import append_history

# Readers of a folder pass over names that begin like this.
HIDDEN = "_staging-"


def _publish(spark, staging, path):
    """Move every file to the same place below ``path``.

    Files have names of their own, so those of other writers are never replaced; where a
    folder is there already, as an hour that has rows, files are added to it.
    """
    Path = spark._jvm.org.apache.hadoop.fs.Path
    source = Path(staging)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(source).toString()
    files, made = system.listFiles(source, True), set()
    while files.hasNext():
        file = files.next().getPath()
        target = Path(path.rstrip("/") + file.toString().removeprefix(base))
        folder = target.getParent()
        if folder.toString() not in made:
            system.mkdirs(folder)
            made.add(folder.toString())
        if not system.rename(file, target):
            raise OSError(f"Could not publish {target}")


def append_if_valid(df, group, path, strict=False, clustered=False, at=None):
    """Check, cast and append ``df`` to a history of files; the input is read once.

    Faults are counted while the rows are written to a hidden folder of the history. With
    none, the files are moved into place, which on HDFS and shared disks touches names only;
    else the folder goes and :class:`ValidationError` is raised, for whose report the input
    is read again. Nothing is visible before the count is known.
    """
    spark = df.sparkSession
    rows, verdict = watched(df, group, strict)
    staging = f"{path.rstrip('/')}/{HIDDEN}{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(staging)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    absent, home = [], folder.getParent()
    while home is not None and not system.exists(home):
        absent.append(home)
        home = home.getParent()
    refused = True
    try:
        append_history(cast_features(rows, group, strict), group, staging, clustered, at)
        verdict()
        refused = False
        _publish(spark, staging, path)
    finally:
        system.delete(folder, True)
        # Folders must not appear where nothing has been written.
        for home in absent if refused else ():
            if system.exists(home) and not system.listStatus(home):
                system.delete(home, False)
