"""Feature ingestion on Spark: check, cast, and store feature data."""

from ledgerline.errors import FeatureStoreError, RecordIngestionError, ValidationError
from ledgerline.groups import FeatureGroup, OfflineStore, feature_definitions
from ledgerline.plans.store import FeatureStore

__all__ = [
    "FeatureGroup",
    "FeatureStore",
    "FeatureStoreError",
    "OfflineStore",
    "RecordIngestionError",
    "ValidationError",
    "feature_definitions",
]
