"""Errors and message texts."""

# Message texts that callers match on.
UNSUPPORTED_TYPE = (
    "Found unsupported data type from schema '{type}' which cannot be converted "
    "to a corresponding feature type."
)
NOT_CREATED = (
    "Feature group '{group}' is in '{status}' status, "
    "however status must be in 'Created' instead."
)
UNKNOWN_STORE = "Found unknown target store, the valid values are [{valid}]."
DUPLICATE_STORE = (
    "Found duplicate target store, please remove duplicate value and try again."
)
EMPTY_STORES = (
    "Target stores cannot be empty, please provide at least one target store "
    "or leave it unspecified."
)
STORE_NOT_ENABLED = (
    "[{stores}] of FeatureGroup: '{group}' are not enabled, "
    "however they are specified in target store."
)
OFFLINE_NOT_ENABLED = "OfflineStore of FeatureGroup: '{group}' is not enabled."
INVALID_CHARACTER = "Cannot proceed. Invalid char among '{chars}' detected in '{name}'."
RESERVED_NAME = "Cannot proceed. Detected column with reserved feature name '{name}'."
UNKNOWN_COLUMNS = "Cannot proceed. Schema contains unknown columns: '{names}'"
MISSING_NAMES = "Cannot proceed. Missing feature names '{names}' in schema."
INVALID_VALUES = (
    "Cannot proceed. Some records contain columns with data types that are not "
    "registered in the FeatureGroup or records values equal to NaN."
)
FAILED_RECORDS = (
    "Stream ingestion finished, however {count} records failed to be ingested. "
    "Please inspect failed stream ingestion data frame for more info."
)
INVALID_RESOURCE_ID = "Provided feature group arn is not valid."

# Our own messages.
INVALID_FORMAT = "Table format '{format}' is not supported; use one of {valid}."
DUPLICATE_COLUMN = "Cannot proceed. Column '{name}' occurs more than once in schema."
NO_SUCH_GROUP = "Feature group '{group}' is not in the catalogue."
NO_SUCH_CATALOGUE = (
    "The history of '{group}' is a table of catalogue '{catalog}', which this session "
    "does not configure."
)
BUCKETS_DIFFER = "The table at '{path}' has {stored} buckets, not {given}."
TABLE_BUSY = "The table at '{path}' is busy: {what}."
REPEATED_GROUP = "Group '{group}' is registered twice at once."
AMBIGUOUS_GROUP = "Feature group '{group}' is in the catalogue more than once."


class FeatureStoreError(RuntimeError):
    """Base of the errors raised by this package."""


class ValidationError(FeatureStoreError):
    """The input, the group or the request breaks a rule; nothing was written.

    When rows were at fault, ``report`` holds the lowest offending identifiers with their
    error strings and ``total`` the number of all faulty rows; else they are empty and 0.
    """

    def __init__(self, message, report=(), total=0):
        super().__init__(message)
        self.report, self.total = list(report), total


class RecordIngestionError(FeatureStoreError):
    """Some records of an online ingest failed; the others are stored."""


def unsupported_type(data_type):
    """Text for a Spark type that no feature type stands for, e.g. ``BooleanType``."""
    return UNSUPPORTED_TYPE.format(type=str(data_type).replace("()", ""))
