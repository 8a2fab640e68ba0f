"""Latest record per identifier."""

from pyspark.sql import functions as F

from ledgerline.functions import named
from ledgerline.functions.history import event_timestamp


def latest_per_record(df, group, sequence=None):
    """One row per identifier: greatest event time, then greatest ``sequence``.

    A remaining tie goes to the greatest row, so the outcome never depends on the order
    of arrival. ``max`` of a struct is combined on the map side: a key that holds a
    third of all rows sends one row per map task, not a third of the data to one task.
    """
    if group.feature_types[group.event_time] == "String":
        newest = event_timestamp(group)
    else:
        newest = named(group.event_time)
    rest = [c for c in df.columns if c != group.record_identifier]
    order = [newest.alias("newest")]
    if sequence is not None:
        order.append(named(sequence).alias("tie"))
    row = F.struct(*order, F.struct(*[named(c) for c in rest]).alias("row"))
    best = df.groupBy(named(group.record_identifier)).agg(F.max(row).alias("best"))
    return best.select(
        *[
            named(c) if c == group.record_identifier else F.col("best.row").getField(c).alias(c)
            for c in df.columns
        ]
    )
