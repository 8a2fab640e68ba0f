"""A row as the record that a put sends."""

from pyspark.sql import functions as F

from ledgerline.functions import named


def record_column(columns):
    """Ordered array of (feature_name, value_as_string); nulls are left out."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature_name"),
                named(c).cast("string").alias("value_as_string"),
            )
            for c in columns
        ]
    )
    return F.filter(pairs, lambda pair: pair["value_as_string"].isNotNull())


def exploded_records(df, identifier):
    """One row per stored value: identifier, position in the record, name, value."""
    return df.select(
        named(identifier), F.posexplode(record_column(df.columns)).alias("position", "pair")
    ).select(
        named(identifier),
        "position",
        F.col("pair.feature_name").alias("feature_name"),
        F.col("pair.value_as_string").alias("value_as_string"),
    )
