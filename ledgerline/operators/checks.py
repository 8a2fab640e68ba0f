"""Checks and casts of row values. One narrow projection each: no shuffle, no Python."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.errors import INVALID_VALUES, ValidationError
from ledgerline.functions import named
from ledgerline.functions.casts import (
    check_castable,
    is_nan,
    to_event_timestamp,
    to_feature,
)
from ledgerline.operators.names import ROW_ERRORS_COLUMN, check_names

# Rows of a report; ``invalid_rows`` gives them all.
REPORT_ROWS = 20


def _present_features(df, group):
    """(name, Spark type, feature type) of the group's features that ``df`` has."""
    sources = {f.name: f.dataType for f in df.schema.fields}
    for name, feature_type in group.features:
        if name in sources:
            check_castable(sources[name])
            yield name, sources[name], feature_type


def row_errors(df, group, strict=False):
    """Text of the faults of a row, ``''`` for a valid one, in declared order."""
    checks = []
    for name, source, feature_type in _present_features(df, group):
        value = named(name)
        is_text = isinstance(source, T.StringType)
        target = to_feature(value, source, feature_type, strict)
        if name == group.event_time and feature_type == "Fractional" and not strict:
            # Has a timestamp if finite: zero times anything else is NaN. Parsed once.
            target = F.nanvl(target * F.lit(0.0), F.lit(None).cast("double"))
        elif name == group.event_time:
            target = to_event_timestamp(target, feature_type, strict)
        elif is_text and feature_type == "Fractional":
            # A text that reads as NaN; to a long or a timestamp it does not cast at all.
            target = F.nanvl(target, F.lit(None).cast("double"))
        fault = F.lit(False) if target is value else target.isNull() & value.isNotNull()
        if not is_text or (feature_type == "String" and name != group.event_time):
            fault |= is_nan(value, source)
        if name in group.required:
            fault |= value.isNull()
        checks.append(F.when(fault, F.lit(f"{name} not valid")))
    return F.concat_ws(",", *checks)


def row_validation_errors(df, group, strict=False):
    """Identifier and error text of every row."""
    return df.select(
        named(group.record_identifier), row_errors(df, group, strict).alias(ROW_ERRORS_COLUMN)
    )


def invalid_rows(df, group, strict=False):
    """The rows that have a fault, whole, with their error text."""
    return df.withColumn(ROW_ERRORS_COLUMN, row_errors(df, group, strict)).filter(
        F.col(ROW_ERRORS_COLUMN) != ""
    )


def invalid_row_report(df, group, strict=False, rows=REPORT_ROWS):
    """The lowest identifiers among the invalid rows, with their errors: ``rows`` of them."""
    return (
        row_validation_errors(df, group, strict)
        .filter(F.col(ROW_ERRORS_COLUMN) != "")
        .orderBy(named(group.record_identifier), ROW_ERRORS_COLUMN)
        .limit(rows)
    )


def valid_rows(df, group, strict=False):
    return df.filter(row_errors(df, group, strict) == "")


def cast_features(df, group, strict=False):
    """Columns in input order, each as its declared type."""
    types = group.feature_types
    return df.select(
        *[
            to_feature(named(f.name), f.dataType, types[f.name], strict).alias(f.name)
            for f in df.schema.fields
        ]
    )


def check_rows(df, group, strict=False, rows=REPORT_ROWS):
    """Raise if any row is invalid, with the first ``rows`` of them and their number.

    One job that keeps at most that many rows per partition; it reads only the columns
    that are checked and moves nothing but those rows. A second counts what is refused.
    """
    report = invalid_row_report(df, group, strict, rows).collect()
    if report:
        raise ValidationError(INVALID_VALUES, report, invalid_rows(df, group, strict).count())


def watched(df, group, strict=False):
    """``df``, and a function that raises if any row was invalid, once all have been written.

    Faults are counted by the job that writes the rows, so valid input is read once. A
    retried task may count its rows again, which leaves zero at zero. For the report the
    input is read again; if it is not repeatable and shows no fault then, the lowest of the
    faulty rows that were counted is reported.
    """
    seen = Observation()
    faulty = F.col(ROW_ERRORS_COLUMN) != ""
    row = F.struct(named(group.record_identifier), F.col(ROW_ERRORS_COLUMN))
    marked = df.withColumn(ROW_ERRORS_COLUMN, row_errors(df, group, strict)).observe(
        seen, F.count_if(faulty).alias("faults"), F.min(F.when(faulty, row)).alias("lowest")
    )

    def verdict():
        try:
            found = seen.get
        except Py4JJavaError:
            # The plan of an input that turns out empty may lose its counts: look again.
            check_rows(df, group, strict)
            return
        if found["faults"]:
            check_rows(df, group, strict)
            raise ValidationError(INVALID_VALUES, [found["lowest"]], found["faults"])

    return marked.drop(ROW_ERRORS_COLUMN), verdict


def validated_cast(df, group, strict=False):
    """Check names and rows, then cast; raises if anything is invalid."""
    check_names(df.columns, group)
    check_rows(df, group, strict)
    return cast_features(df, group, strict)
