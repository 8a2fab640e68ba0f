"""The catalogue: one row per feature group."""

from pyspark.sql import functions as F

from ledgerline.errors import AMBIGUOUS_GROUP, NO_SUCH_GROUP, ValidationError
from ledgerline.groups import (
    CREATED,
    HOUR_FORMAT,
    OFFLINE_STORE,
    ONLINE_STORE,
    TABLE_FORMAT,
    FeatureGroup,
    OfflineStore,
)

CATALOG_SCHEMA = """
    name string,
    status string,
    record_identifier string,
    event_time string,
    features array<struct<name: string, type: string>>,
    online struct<enabled: boolean>,
    offline struct<table_format: string, path: string,
                   catalog: string, database: string, table: string>,
    registered bigint
"""


def catalog_frame(spark, groups, registered=None):
    """The catalogue rows of some groups; of equal names the last registered counts."""
    rows = [
        (
            g.name,
            g.status,
            g.record_identifier,
            g.event_time,
            list(g.features),
            None if g.online is None else (g.online,),
            g.offline
            and (
                g.offline.table_format,
                g.offline.path,
                g.offline.catalog,
                g.offline.database,
                g.offline.table,
            ),
            registered,
        )
        for g in groups
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def current_groups(catalog):
    """One row per group: the one registered last.

    A filter on the name reaches the scan, as rows are grouped by it.
    """
    row = F.struct("registered", *[c for c in catalog.columns if c != "registered"])
    return catalog.groupBy("name").agg(F.max_by(row, "registered").alias("row")).select(
        *[F.col("row").getField(c).alias(c) for c in catalog.columns]
    )


def find_group(catalog, name):
    """The group of this name; the filter reaches the scan and two rows suffice."""
    rows = catalog.filter(F.col("name") == name).limit(2).collect()
    if not rows:
        raise ValidationError(NO_SUCH_GROUP.format(group=name))
    if len(rows) > 1:
        raise ValidationError(AMBIGUOUS_GROUP.format(group=name))
    row = rows[0]
    return FeatureGroup(
        name=row["name"],
        status=row["status"],
        record_identifier=row["record_identifier"],
        event_time=row["event_time"],
        features=tuple((f["name"], f["type"]) for f in row["features"]),
        online=row["online"] and row["online"]["enabled"],
        offline=row["offline"] and OfflineStore(**row["offline"].asDict()),
    )


def with_group_flags(catalog):
    """Created, enabled stores (online first) and table format of every group."""
    online = F.coalesce(F.col("online.enabled"), F.lit(False))
    offline = F.col("offline").isNotNull()
    table_format = F.col("offline.table_format")
    stores = F.array(F.when(online, ONLINE_STORE), F.when(offline, OFFLINE_STORE))
    return catalog.withColumns(
        {
            "is_created": F.coalesce(F.col("status") == CREATED, F.lit(False)),
            "online_enabled": online,
            "offline_enabled": offline,
            "is_hour_table": F.coalesce(table_format == HOUR_FORMAT, F.lit(False)),
            "is_v2_table": F.coalesce(table_format == TABLE_FORMAT, F.lit(False)),
            "target_stores": F.filter(stores, lambda s: s.isNotNull()),
        }
    )


def usable_groups(catalog):
    """Groups that accept data: created, with at least one store enabled."""
    return with_group_flags(catalog).filter(
        F.col("is_created") & (F.size("target_stores") > 0)
    )
