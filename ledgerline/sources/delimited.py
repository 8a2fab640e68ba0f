"""CSV with a header."""


def read_csv(spark, path, schema=None, limit=None):
    """Types are inferred from all rows, which is a second pass, unless given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df if limit is None else df.limit(limit)
