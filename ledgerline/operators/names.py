"""Checks of column names against a group, for one schema or for a table of schemas."""

import re

from pyspark.sql import functions as F

from ledgerline.errors import (
    DUPLICATE_COLUMN,
    INVALID_CHARACTER,
    MISSING_NAMES,
    RESERVED_NAME,
    UNKNOWN_COLUMNS,
    ValidationError,
)
from ledgerline.functions.history import AUDIT_COLUMNS, HOUR_COLUMNS

# Characters and names a column may not have.
INVALID_CHARACTERS = "[,;{}()\n\t=]"
ERROR_COLUMN = "online_ingestion_error"
ROW_ERRORS_COLUMN = "dataTypeValidationErrors"
RESERVED_NAMES = frozenset(
    (*AUDIT_COLUMNS, *HOUR_COLUMNS, "temp_event_time_col", ERROR_COLUMN, ROW_ERRORS_COLUMN)
)


def check_names(names, group):
    """Raise on the first bad name, then on unknown, missing and repeated ones."""
    for name in names:
        if re.search(INVALID_CHARACTERS, name):
            raise ValidationError(
                INVALID_CHARACTER.format(chars=INVALID_CHARACTERS, name=name)
            )
        if name in RESERVED_NAMES:
            raise ValidationError(RESERVED_NAME.format(name=name))
    unknown = [name for name in names if name not in group.feature_types]
    if unknown:
        raise ValidationError(UNKNOWN_COLUMNS.format(names=",".join(unknown)))
    missing = [name for name in group.required if name not in names]
    if missing:
        raise ValidationError(MISSING_NAMES.format(names=",".join(missing)))
    seen = set()
    for name in names:
        # Spark resolves names without regard to case, so variants count as repeats.
        if name.lower() in seen:
            raise ValidationError(DUPLICATE_COLUMN.format(name=name))
        seen.add(name.lower())


def name_problems(names, group):
    """Array of (name, rule) for an array column holding the names of one schema.

    The rules are those of :func:`check_names`, but every problem is reported.
    """

    def text_array(values):
        return F.array(*[F.lit(v) for v in values])

    def rule_of(name):
        return (
            F.when(name.rlike(INVALID_CHARACTERS), F.lit("invalid character"))
            .when(name.isin(sorted(RESERVED_NAMES)), F.lit("reserved"))
            .when(~name.isin(list(group.feature_types)), F.lit("unknown"))
        )

    def problem(name, rule):
        return F.struct(name.alias("name"), rule.alias("rule"))

    present = F.filter(
        F.transform(names, lambda n: problem(n, rule_of(n))), lambda p: p["rule"].isNotNull()
    )
    missing = F.transform(
        F.array_except(text_array(group.required), names),
        lambda n: problem(n, F.lit("missing")),
    )
    lowered = F.transform(names, F.lower)
    distinct = F.array_distinct(lowered)
    repeated = F.transform(
        F.filter(distinct, lambda n: F.size(F.filter(lowered, lambda m: m == n)) > 1),
        lambda n: problem(n, F.lit("repeated")),
    )
    # The quadratic search runs only where a name does repeat.
    repeated = F.when(F.size(distinct) < F.size(names), repeated).otherwise(
        F.array().cast("array<struct<name: string, rule: string>>")
    )
    return F.concat(present, missing, repeated)


def schema_name_report(schemas, schema_id, names_column, group):
    """One row per problem in a table of schemas; rows without problems vanish."""
    return schemas.select(
        schema_id, F.inline(name_problems(F.col(names_column), group))
    )
