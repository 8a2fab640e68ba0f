"""Slices of event time."""

from pyspark.sql import functions as F

from ledgerline.functions import named
from ledgerline.functions.casts import to_event_timestamp, to_feature

SLICE = "ledgerline_slice"


def with_time_slice(df, group, unit):
    """The start of the ``unit`` an uncast row falls into, null without a valid time."""
    declared = group.feature_types[group.event_time]
    source = df.schema[group.event_time].dataType
    value = to_feature(named(group.event_time), source, declared)
    start = F.date_trunc(unit, to_event_timestamp(value, declared))
    return df.withColumn(SLICE, F.date_format(start, "yyyy-MM-dd-HH-mm"))
