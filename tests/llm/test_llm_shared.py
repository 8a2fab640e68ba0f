import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm.shared import map_in_arrow


def test_batches_of_long_rows_are_small(spark):
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["size"])

    found = [r["size"] for r in map_in_arrow(docs, sizes, "size long").collect()]
    assert max(found) < 6_000_000 and sum(found) > 30_000_000
