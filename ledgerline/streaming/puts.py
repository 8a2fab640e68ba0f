"""A stream into an external online store: one put per row, failures kept once per batch."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from ledgerline.functions import named
from ledgerline.functions.records import record_column
from ledgerline.operators.checks import row_errors
from ledgerline.operators.names import ERROR_COLUMN, check_names
from ledgerline.operators.outcomes import put_target

BATCH = "ledgerline_batch"


def put_source(name, put, open_client, target, columns, home):
    """A data source whose stream writer puts rows and keeps those that fail below ``home``.

    Rows come with two more columns, the record to put and an error that they have already.
    A task puts its rows one by one and writes failed ones to a pending file. The commit of a
    micro-batch moves the files that its tasks name to the folder of the batch and then marks
    it; a batch that is marked is not committed again, and what a commit that was cut off has
    moved goes first. Files of failed or repeated tasks are named by nobody and never seen.

    Everything it needs is in its closure, since executors need not have this package. ``home``
    is a URI that Arrow opens from executors and from the driver.
    """

    def files():
        from pyarrow import fs

        return fs.FileSystem.from_uri(home)

    class PutWriter(DataSourceStreamArrowWriter):
        def write(self, iterator):
            import pyarrow as pa
            import pyarrow.parquet as pq

            system, root = files()
            client = open_client() if open_client else None
            message, writer = WriterCommitMessage(), None
            message.file, message.rows, message.failed = None, 0, 0
            try:
                for batch in iterator:
                    records, errors = batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist()
                    for i, record in enumerate(records):
                        if errors[i] is None:
                            try:
                                put(client, record, target)
                            except Exception as error:
                                errors[i] = str(error) or type(error).__name__
                    message.rows += len(errors)
                    failed = [i for i, error in enumerate(errors) if error is not None]
                    if not failed:
                        continue
                    message.failed += len(failed)
                    kept = pa.table(
                        [*batch.columns[:-2], pa.array(errors, pa.string())], names=columns
                    ).take(failed)
                    if writer is None:
                        message.file = f"{uuid.uuid4().hex}.parquet"
                        system.create_dir(f"{root}/_pending")
                        writer = pq.ParquetWriter(
                            f"{root}/_pending/{message.file}", kept.schema, filesystem=system
                        )
                    writer.write_table(kept)
            finally:
                if writer is not None:
                    writer.close()
                if hasattr(client, "close"):
                    client.close()
            return message

        def commit(self, messages, batchId):
            import json

            from pyarrow import fs

            system, root = files()
            folder, mark = f"{root}/{BATCH}={batchId}", f"{root}/_committed/{batchId}"
            if system.get_file_info(mark).type != fs.FileType.NotFound:
                self.abort(messages, batchId)
                return
            if system.get_file_info(folder).type != fs.FileType.NotFound:
                system.delete_dir(folder)
            system.create_dir(folder)
            told = [m for m in messages if m is not None]
            for message in told:
                if message.file:
                    system.move(f"{root}/_pending/{message.file}", f"{folder}/{message.file}")
            system.create_dir(f"{root}/_committed")
            with system.open_output_stream(mark) as out:
                counts = {"rows": sum(m.rows for m in told), "failed": sum(m.failed for m in told)}
                out.write(json.dumps(counts).encode())

        def abort(self, messages, batchId):
            system, root = files()
            for message in messages:
                if message is not None and message.file:
                    system.delete_file(f"{root}/_pending/{message.file}")

    class PutSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def streamWriter(self, schema, overwrite):
            return PutWriter()

    return PutSource


def _shared_uri(spark, path):
    """A folder, made if need be, as a URI that Arrow reads as well."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    uri = system.makeQualified(folder).toString()
    if uri.startswith("file:"):
        return "file:///" + uri.removeprefix("file:").lstrip("/")
    return uri.replace("s3a:", "s3:", 1)


def put_stream(
    stream,
    group,
    put,
    open_client,
    failures,
    checkpoint,
    target=None,
    trigger=None,
    check_records=False,
    strict=False,
):
    """Start a query that sends every row through ``put(client, record, target)``.

    Arguments are those of ``operators.outcomes.put_outcomes``. Failed rows are kept with
    their error below ``failures``, see :func:`failed_puts`, each batch once, also when the
    driver ends between a batch and its checkpoint. Such a batch is put again, so ``put`` has
    to treat the same identifier and event time as the same record. Names are checked;
    values are what the store judges, unless ``check_records``: then faulty rows are kept
    with their fault and are not put.
    """
    spark = stream.sparkSession
    check_names(stream.columns, group)
    fields = [*stream.schema.fields, T.StructField(ERROR_COLUMN, T.StringType())]
    # Readers take the schema from here, also before anything has failed.
    nothing = spark.createDataFrame([], T.StructType(fields))
    home = _shared_uri(spark, failures)
    nothing.write.mode("ignore").parquet(f"{failures.rstrip('/')}/{BATCH}=-1")
    fault = F.lit(None).cast("string")
    if check_records:
        fault = F.nullif(row_errors(stream, group, strict), F.lit(""))
    sent = stream.select(
        *[named(c) for c in stream.columns], record_column(stream.columns), fault
    )
    sent = sent.toDF(*[str(i) for i in range(len(sent.columns))])
    name = f"ledgerline_put_{uuid.uuid4().hex}"
    columns = [f.name for f in fields]
    spark.dataSource.register(
        put_source(name, put, open_client, target or put_target(group.name), columns, home)
    )
    return (
        sent.writeStream.format(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def failed_puts(spark, failures):
    """The rows that could not be put, with their error."""
    return spark.read.parquet(failures).drop(BATCH)
