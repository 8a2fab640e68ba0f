"""What a stream has sent and another one has not stored in time."""

from pyspark.sql import functions as F

from ledgerline.functions import named
from ledgerline.functions.history import event_timestamp
from ledgerline.streaming.ingest import _file_query

_AT, _ID, _STORED = "ledgerline_at", "ledgerline_id", "ledgerline_stored_at"


def missing_stream(sent, stored, group, path, checkpoint, delay="1 hour", trigger=None):
    """Start a query that appends to ``path`` the records sent that were not stored.

    ``sent`` and ``stored`` are streams with the declared types, ``stored`` such as a history
    that is read as a stream. A record is an identifier at an event time. It is missing if no
    stored row has both by the time that the watermark passes it: the older of the latest
    event times of both streams, less ``delay``. State is kept for no longer. Each missing
    row is written once, also over restarts, with all its columns, as often as it was sent;
    rows that arrive behind the watermark are judged no more.
    """
    identifier = named(group.record_identifier)
    left = sent.withColumn(_AT, event_timestamp(group)).withWatermark(_AT, delay)
    right = stored.select(
        identifier.alias(_ID), event_timestamp(group).alias(_STORED)
    ).withWatermark(_STORED, delay)
    same = (identifier == F.col(_ID)) & (F.col(_AT) == F.col(_STORED))
    missing = left.join(right, same, "left_outer").filter(F.col(_ID).isNull())
    return _file_query(
        missing.select(*[named(c) for c in sent.columns]), path, checkpoint, trigger=trigger
    )
