"""Feature groups: declaration, schema, enabled stores."""

from dataclasses import dataclass

from pyspark.sql import types as T

from ledgerline.errors import (
    DUPLICATE_STORE,
    EMPTY_STORES,
    NOT_CREATED,
    STORE_NOT_ENABLED,
    UNKNOWN_STORE,
    ValidationError,
    unsupported_type,
)

# Feature types and the Spark types they are stored as.
STORAGE_TYPES = {
    "Integral": T.LongType(),
    "String": T.StringType(),
    "Fractional": T.DoubleType(),
}
# Spark type -> feature type when a schema is turned into definitions.
INFERRED_TYPES = {
    T.StringType: "String",
    T.DoubleType: "Fractional",
    T.FloatType: "Fractional",
    T.ByteType: "Integral",
    T.ShortType: "Integral",
    T.IntegerType: "Integral",
    T.LongType: "Integral",
}
# Store names and the only status that accepts data.
ONLINE_STORE = "OnlineStore"
OFFLINE_STORE = "OfflineStore"
TARGET_STORES = (ONLINE_STORE, OFFLINE_STORE)
CREATED = "Created"

# Our names for the two offline layouts; a group without a format is hour-partitioned.
HOUR_FORMAT = "Hive"
TABLE_FORMAT = "Iceberg"


@dataclass(frozen=True)
class OfflineStore:
    """Where and how the history of a group is kept."""

    table_format: str | None = None
    path: str | None = None
    catalog: str | None = None
    database: str | None = None
    table: str | None = None


@dataclass(frozen=True)
class FeatureGroup:
    """A named schema with an identifier, an event time and typed features."""

    name: str
    record_identifier: str
    event_time: str
    features: tuple[tuple[str, str], ...]
    status: str = CREATED
    online: bool | None = None
    offline: OfflineStore | None = None

    def __post_init__(self):
        declared = dict(self.features)
        if len(declared) != len(self.features):
            raise ValidationError(f"Group '{self.name}' declares a feature twice.")
        for name, feature_type in self.features:
            if feature_type not in STORAGE_TYPES:
                raise ValidationError(
                    f"Feature '{name}' has the unknown type '{feature_type}'."
                )
        for name in (self.record_identifier, self.event_time):
            if name not in declared:
                raise ValidationError(f"Group '{self.name}' does not declare '{name}'.")

    @property
    def feature_types(self):
        return dict(self.features)

    @property
    def required(self):
        return (self.record_identifier, self.event_time)

    @property
    def online_enabled(self):
        return bool(self.online)

    @property
    def offline_enabled(self):
        return self.offline is not None

    @property
    def enabled_stores(self):
        """Enabled stores, online first."""
        enabled = {ONLINE_STORE: self.online_enabled, OFFLINE_STORE: self.offline_enabled}
        return [store for store in TARGET_STORES if enabled[store]]

    def schema(self):
        """Schema of a stored row, without audit and partition columns."""
        return T.StructType(
            [T.StructField(n, STORAGE_TYPES[t], True) for n, t in self.features]
        )


def feature_type_of(data_type):
    """Feature type of a Spark type; raises for a type that has none."""
    try:
        return INFERRED_TYPES[type(data_type)]
    except KeyError:
        raise ValidationError(unsupported_type(data_type)) from None


def feature_definitions(df):
    """``[{"FeatureName": ..., "FeatureType": ...}]`` in field order; no Spark job."""
    return [
        {"FeatureName": f.name, "FeatureType": feature_type_of(f.dataType)}
        for f in df.schema.fields
    ]


def check_created(group):
    if group.status != CREATED:
        raise ValidationError(NOT_CREATED.format(group=group.name, status=group.status))


def check_target_stores(group, target_stores):
    """Requested stores as a list, or None when the caller named none."""
    if target_stores is None:
        return None
    requested = list(target_stores)
    if any(store not in TARGET_STORES for store in requested):
        raise ValidationError(UNKNOWN_STORE.format(valid=", ".join(TARGET_STORES)))
    if len(set(requested)) != len(requested):
        raise ValidationError(DUPLICATE_STORE)
    if not requested:
        raise ValidationError(EMPTY_STORES)
    disabled = [s for s in TARGET_STORES if s in requested and s not in group.enabled_stores]
    if disabled:
        raise ValidationError(
            STORE_NOT_ENABLED.format(stores=",".join(disabled), group=group.name)
        )
    return requested
