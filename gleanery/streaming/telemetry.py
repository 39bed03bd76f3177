"""Continuous telemetry: responses in, one record per request out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleanery.operators.telemetry import derive_telemetry
from gleanery.plans.medallion import TELEMETRY
from gleanery.plans.usage_log import log_records
from gleanery.session import materialize
from gleanery.sinks.buckets import BucketedTable
from gleanery.sinks.tables import TableStore
from gleanery.streaming.batches import batch_version, paced, publish_batches
from gleanery.streaming.mart import merge_batch


def accepted_telemetry(responses: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Records of a response stream, replays of a request dropped while the watermark remembers it. Records later than
    the watermark are dropped with them; ``log_responses`` keeps all."""
    records = derive_telemetry(responses.where(F.col("executed_at").isNotNull()))
    return records.withWatermark("execution_timestamp", lateness).dropDuplicatesWithinWatermark(["request_id"])


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Responses without a time belong to no day."""
    return responses.where(F.col("executed_at").isNull()).withColumn("reason", F.lit("executed_at is missing"))


def log_responses(
    responses: DataFrame, store: TableStore, checkpoint: str, every: str | None = None, mart: BucketedTable | None = None
) -> StreamingQuery:
    """Log each micro-batch, however late its rows are: accepted records, rejects and replays add up to the input.

    A replay has the id and the day of a record that is stored or came earlier on that day, so a day's records are only compared
    with each other. Rows without a time are set aside. ``mart`` (see ``mart_table``) is kept up with every batch by merging the states of its
    new records into their days.
    """

    def log(batch: DataFrame, number: int) -> None:
        version = batch_version(store.spark, number)
        if not store.is_published(TELEMETRY, version):
            records = materialize(derive_telemetry(batch), "telemetry")
            log_records(store, unlogged(records, store.read(TELEMETRY)), version)
        if mart is not None and store.is_published(TELEMETRY, version):
            merge_batch(mart, store.read(TELEMETRY, [version]), version)

    return paced(responses.writeStream.foreachBatch(log), checkpoint, every).start()


def unlogged(records: DataFrame, logged: DataFrame | None) -> DataFrame:
    """Records without a time, and of the others the first of each id and day that is not in the log."""
    day = F.to_date("execution_timestamp")
    of_day = Window.partitionBy("request_id", day).orderBy("execution_timestamp")
    copy = F.when(F.col("execution_timestamp").isNotNull(), F.row_number().over(of_day))
    first = records.withColumn("_copy", copy).where("coalesce(_copy, 1) = 1").drop("_copy")
    if logged is None:
        return first
    known = logged.select(F.col("request_id").alias("_id"), F.col("run_date").alias("_date"))
    return first.join(known, (F.col("request_id") == F.col("_id")) & (day == F.col("_date")), "left_anti")


def write_files(
    stream: DataFrame, path: str, checkpoint: str, by_day_of: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Append to a file sink, each record exactly once, optionally in one folder per UTC day."""
    if by_day_of:
        writer = stream.withColumn("run_date", F.to_date(by_day_of)).writeStream.partitionBy("run_date")
    else:
        writer = stream.writeStream
    return paced(writer.format("parquet").outputMode("append"), checkpoint, every).start(path)


def publish_stream(
    stream: DataFrame, store: TableStore, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append each micro-batch to a published table, once even if the batch is replayed."""
    return publish_batches(stream.writeStream.outputMode("append"), store.append, store, table, checkpoint, every)
