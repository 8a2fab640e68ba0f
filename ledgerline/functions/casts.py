"""Casts to the declared feature types.

The rules are those of Spark's cast with ANSI mode off. They are spelled out here so
that they hold whatever ``spark.sql.ansi.enabled`` says, as plain expressions that
never throw. ``strict=True`` gives ``try_cast`` instead.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.errors import ValidationError, unsupported_type

LONG_MAX = 2**63 - 1
LONG_MIN = -(2**63)
TWO_63 = float(2**63)

# Control characters and blanks around a number are ignored.
_PADDING = r"[\x00-\x20\x7F]"
_WHOLE = r"\A[+-]?[0-9]+(\.[0-9]*)?\z"
_POINT_FIRST = r"\A[+-]?\.[0-9]*\z"
# Texts that read as the double NaN.
_NAN_TEXT = r"\A[\x00-\x20]*([+-]?NaN|(?i:nan))[\x00-\x20]*\z"

_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT_TYPES = (T.FloatType, T.DoubleType)
CHECKED_TYPES = (T.StringType, T.DecimalType) + _WHOLE_TYPES + _FLOAT_TYPES


def check_castable(data_type):
    """Only texts and numbers can be checked; other input types are refused."""
    if not isinstance(data_type, CHECKED_TYPES):
        raise ValidationError(unsupported_type(data_type))


def to_feature(c, source, feature_type, strict=False):
    """``c`` of Spark type ``source`` as a value of the declared feature type."""
    if feature_type == "String":
        return c if isinstance(source, T.StringType) else c.try_cast("string")
    if feature_type == "Fractional":
        return c if isinstance(source, T.DoubleType) else c.try_cast("double")
    if isinstance(source, T.LongType):
        return c
    if strict or isinstance(source, _WHOLE_TYPES):
        return c.try_cast("bigint")
    if isinstance(source, T.StringType):
        return _long_from_text(c)
    if isinstance(source, T.DecimalType):
        return _long_from_decimal(c)
    return _long_from_double(c)


def _long_from_text(c):
    """Digits after a point are dropped. Plain whole numbers take the short way."""
    text = F.regexp_replace(c, rf"\A{_PADDING}+|{_PADDING}+\z", "")
    return F.coalesce(
        c.try_cast("bigint"),
        F.when(
            text.rlike(_WHOLE),
            F.regexp_extract(text, r"\A([+-]?[0-9]+)", 1).try_cast("bigint"),
        ).when(text.rlike(_POINT_FIRST), F.lit(0).cast("bigint")),
    )


def _long_from_double(c):
    return (
        F.when(F.isnan(c), F.lit(0).cast("bigint"))
        .when(c >= F.lit(TWO_63), F.lit(LONG_MAX))
        .when(c <= F.lit(-TWO_63), F.lit(LONG_MIN))
        .otherwise(c.try_cast("bigint"))
    )


def _long_from_decimal(c):
    """Out of range, the low 64 bits of the whole part remain."""
    whole = F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("decimal(38,0)")
    span = F.lit(str(2**64)).cast("decimal(38,0)")
    low = F.pmod(whole, span)
    wrapped = F.when(low > F.lit(LONG_MAX), low - span).otherwise(low)
    return F.coalesce(c.try_cast("bigint"), wrapped.try_cast("bigint"))


def is_nan(c, source):
    """True where the value is NaN, or a text that reads as NaN."""
    if isinstance(source, T.StringType):
        return F.coalesce(c.rlike(_NAN_TEXT), F.lit(False))
    if isinstance(source, _FLOAT_TYPES):
        return F.coalesce(F.isnan(c), F.lit(False))
    return F.lit(False)


def to_event_timestamp(value, feature_type, strict=False):
    """Timestamp of an event time that already has its declared type.

    Numbers are seconds since the epoch; beyond the timestamp range they are clamped.
    """
    if feature_type != "Fractional" or strict:
        return value.try_cast("timestamp")
    micros = value * F.lit(1e6)
    infinite = F.abs(value) == F.lit(float("inf"))
    return (
        F.when(F.isnan(value) | infinite, F.lit(None).cast("timestamp"))
        .when(micros >= F.lit(TWO_63), F.timestamp_micros(F.lit(LONG_MAX)))
        .when(micros <= F.lit(-TWO_63), F.timestamp_micros(F.lit(LONG_MIN)))
        .otherwise(value.try_cast("timestamp"))
    )
