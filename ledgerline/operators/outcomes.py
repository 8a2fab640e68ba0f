"""One put per record, with the outcome of each row."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.records import record_column
from ledgerline.operators.names import ERROR_COLUMN

_RECORD = "__record"


def put_target(group=None, target_stores=None):
    """What a put is for: the group's name, and the target stores, None if none were given."""
    stores = None if target_stores is None else list(target_stores)
    return {"group": group, "target_stores": stores}


def put_outcomes(df, put, open_client=None, precheck=None, target=None):
    """Send every row through ``put(client, record, target)`` and add its error, null if none.

    ``open_client()`` runs once per partition on the executor; a ``close()`` method of
    its result is called at the end. ``record`` is a list of
    ``{"feature_name", "value_as_string"}`` without nulls, ``target`` a dictionary as
    :func:`put_target` makes it. A row whose ``precheck``
    column is not null is not put; that text becomes its error.

    Values become texts before they reach Python, and the input columns pass through as
    Arrow, so integers with nulls keep their type. A retried task repeats its puts;
    ``put`` has to treat the same identifier and event time as the same record.
    """
    prechecked = F.lit(None).cast("string") if precheck is None else precheck
    sent = df.select(
        "*", record_column(df.columns).alias(_RECORD), prechecked.alias(ERROR_COLUMN)
    )
    # mapInArrow resolves names itself, and not all of them: numbers stand in.
    sent = sent.toDF(*[str(i) for i in range(len(sent.columns))])
    fields = [T.StructField(str(i), f.dataType) for i, f in enumerate(df.schema.fields)]
    out_schema = T.StructType([*fields, T.StructField(sent.columns[-1], T.StringType())])

    # A plain dictionary, since executors need not have this package.
    goal = target or put_target()

    def run(batches):
        import pyarrow as pa

        client = open_client() if open_client else None
        try:
            for batch in batches:
                kept = batch.columns[:-2]
                records, errors = batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist()
                for i, record in enumerate(records):
                    if errors[i] is None:
                        try:
                            put(client, record, goal)
                        except Exception as error:
                            errors[i] = str(error) or type(error).__name__
                names = batch.schema.names[:-2] + [batch.schema.names[-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(errors, batch.columns[-1].type)], names=names
                )
        finally:
            if hasattr(client, "close"):
                client.close()

    return sent.mapInArrow(run, out_schema).toDF(*df.columns, ERROR_COLUMN)


def failed_records(outcomes):
    return outcomes.filter(F.col(ERROR_COLUMN).isNotNull())


def stored_records(outcomes):
    return outcomes.filter(F.col(ERROR_COLUMN).isNull()).drop(ERROR_COLUMN)


def failed_record_count(outcomes):
    return outcomes.agg(
        F.count_if(F.col(ERROR_COLUMN).isNotNull()).alias("n_failed")
    )
