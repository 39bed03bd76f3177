"""Continuous daily mart over telemetry that is already free of replays: merged states, or windows of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gleanery.operators.mart import MART_COLUMNS, mart_measures, mart_states, merged_states
from gleanery.session import materialize
from gleanery.sinks.buckets import UPSERT, BucketedTable
from gleanery.sinks.tables import TableStore
from gleanery.streaming.batches import paced, publish_batches

_RECORDS = (
    "request_id string, execution_timestamp timestamp, execution_time_ms double, vector_similarity_score double, prompt_tokens bigint, "
    "completion_tokens bigint, total_cost_usd decimal(18,6), status_code int"
)
_BATCH = T.StructType([T.StructField("stream", T.StringType()), T.StructField("number", T.LongType())])
_APPLIED = T.StructField("applied", T.ArrayType(_BATCH))


def mart_table(store: TableStore, buckets: int = 16) -> BucketedTable:
    """One state per day, with the last batch of each stream that went into it."""
    states = mart_states(store.spark.createDataFrame([], _RECORDS)).schema
    return BucketedTable(store.spark, f"{store.root}/daily_states", T.StructType([*states.fields, _APPLIED]), "run_date", buckets=buckets)


def merge_batch(table: BucketedTable, records: DataFrame, version: str) -> None:
    """Add the records of a batch to the states of their days; no other records are read.

    Every day remembers the versions that it holds of the last batch of each stream, so a batch that is replayed, or died between two days, is added once a day.
    Versions are named ``stream-number``, and a stream's numbers rise.
    """
    stream, number = version.rsplit("-", 1)
    fresh = materialize(mart_states(records.where("execution_timestamp IS NOT NULL")), "day-states")
    held = table.read_like(fresh)
    done = held.where(F.exists("applied", lambda b: (b["stream"] == stream) & (b["number"] >= int(number)))).select("run_date")
    fresh = fresh.join(done, "run_date", "left_anti")
    days = fresh.select("run_date")
    held = held.join(days, "run_date", "left_semi")
    merged = merged_states(held.drop("applied").unionByName(fresh))
    marks = days.join(held.select("run_date", "applied"), "run_date", "left")
    others = F.filter(F.coalesce("applied", F.array().cast(_APPLIED.dataType)), lambda b: b["stream"] != stream)
    own = F.array(F.struct(F.lit(stream).alias("stream"), F.lit(int(number)).cast("bigint").alias("number")))
    marks = marks.select("run_date", F.concat(others, own).alias("applied"))
    table.apply(merged.join(marks, "run_date").withColumn("change", F.lit(UPSERT)))


def windowed_mart(telemetry: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Measures per UTC day. In append mode a day comes out once, when the watermark has passed its end;
    records later than that are left out. State is one row of running sums per open day."""
    days = F.window("execution_timestamp", "1 day")
    marked = telemetry.withWatermark("execution_timestamp", lateness)
    daily = marked.groupBy(days).agg(*mart_measures())
    return daily.withColumn("run_date", F.to_date("window.start")).select(*MART_COLUMNS)


def publish_mart(
    telemetry: DataFrame, store: TableStore, table: str, checkpoint: str, lateness: str = "1 day", every: str | None = None
) -> StreamingQuery:
    """Republish the whole mart after each micro-batch. It has one row per day, so this stays small."""
    mart = windowed_mart(telemetry, lateness).writeStream.outputMode("complete")
    return publish_batches(mart, store.replace, store, table, checkpoint, every)


def append_closed_days(
    telemetry: DataFrame, path: str, checkpoint: str, lateness: str = "1 day", every: str | None = None
) -> StreamingQuery:
    writer = windowed_mart(telemetry, lateness).writeStream.outputMode("append").format("parquet")
    return paced(writer, checkpoint, every).start(path)
