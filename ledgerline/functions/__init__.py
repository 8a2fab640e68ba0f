"""Column expressions: no jobs, no session state, usable in batch and streaming."""

from pyspark.sql import functions as F


def named(name):
    """Column of exactly this name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")
