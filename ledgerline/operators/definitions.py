"""Feature definitions as a report over a table."""

from pyspark.sql import functions as F

from ledgerline.functions import named
from ledgerline.groups import feature_definitions


def definition_report(df):
    """Each definition that ``df`` gives rise to, with the number of values it has.

    One aggregation of one row, turned on its side.
    """
    definitions = feature_definitions(df)
    counted = df.agg(
        *[F.count(named(d["FeatureName"])).alias(f"n{i}") for i, d in enumerate(definitions)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(d["FeatureName"]).alias("feature_name"),
                F.lit(d["FeatureType"]).alias("feature_type"),
                F.col(f"n{i}").alias("n_values"),
            )
            for i, d in enumerate(definitions)
        ]
    )
    return counted.select(F.inline(rows))
