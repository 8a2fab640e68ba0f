from ledgerline import FeatureGroup, OfflineStore

# One feature of each type besides the keys; the event time is a number of seconds.
READINGS = FeatureGroup(
    name="readings",
    record_identifier="station",
    event_time="measured-at",
    features=(
        ("station", "String"),
        ("measured-at", "Fractional"),
        ("sky", "String"),
        ("gusts", "Integral"),
        ("rain mm", "Fractional"),
    ),
    online=True,
    offline=OfflineStore("Hive"),
)


def visits(online=True, table_format="Hive", offline=True, **store):
    """A group of just its two keys, both texts."""
    return FeatureGroup(
        name="visits",
        record_identifier="visitor",
        event_time="seen-at",
        features=(("visitor", "String"), ("seen-at", "String")),
        online=online,
        offline=OfflineStore(table_format, **store) if offline else None,
    )


ONE_VISIT = [("guest 7", "2023-11-02T17:40:09Z")]
VISIT_SCHEMA = "visitor string, `seen-at` string"
