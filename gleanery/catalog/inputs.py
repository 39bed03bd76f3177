"""The driver's tables in the shapes that the operators take."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.session import spread_small

RUN_TS = datetime(2024, 1, 31)
#: How very many small files are written: tasks move their files into place themselves, where else the driver moves one after another, and
#: on a local disk no checksum file is made beside each, which takes as long as the file itself.
MANY_FILES = {
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}
#: What Spark writes as %XX in the names of partition folders.
_SPECIAL = re.compile("[\\x01-\\x1f\"#%'*/:=?\\\\\\x7f{\\[\\]^]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_path() -> F.Column:
    return F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        file_path().alias("file_path"),
        F.col("text").alias("raw_text"),
        F.lit(RUN_TS).cast("timestamp").alias("ingested_at"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, content, category."""
    rows = table(spark, sf_dir, "documents")
    return rows.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), F.col("lang").alias("category"))


def request_id() -> F.Column:
    return F.concat_ws("-", "conv_id", "turn")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_id, query: the text of every turn."""
    return table(spark, sf_dir, "conversations").select(request_id().alias("request_id"), F.col("text").alias("query"))


def unanswerable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, request_id, query: for every system turn a blank request, for every assistant turn an empty one, with ids of their own."""
    turns = table(spark, sf_dir, "conversations").where("role IN ('system', 'assistant')")
    blank = F.col("role") == "system"
    kind = F.when(blank, "blank").otherwise("empty")
    query = F.when(blank, " ").otherwise("")
    return turns.select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn", kind).alias("request_id"), query.alias("query"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of every turn as a request, and blank and empty requests beside them."""
    return questions(spark, sf_dir).unionByName(unanswerable(spark, sf_dir).select("request_id", "query"))


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_id, query, analysis_output: user turns with the assistant turn right after them, if any."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("query"))
    given = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("analysis_output")
    )
    paired = asked.join(given, ["conv_id", "turn"], "left")
    return paired.select(request_id().alias("request_id"), "query", "analysis_output")


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_id, executed_at, execution_time_ms: the requests take them from events spread over all days."""
    events = table(spark, sf_dir, "events")
    number = (F.col("conv_id").cast("bigint") * 7919 + F.col("turn") * 104729) % F.lit(max(1, events.count()))
    turns = table(spark, sf_dir, "conversations").select(number.alias("event_id"), request_id().alias("request_id"))
    turns = turns.unionByName(unanswerable(spark, sf_dir).select(number.alias("event_id"), "request_id"))
    events = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("executed_at"),
        F.col("value").alias("execution_time_ms"),
    )
    return turns.join(events, "event_id").drop("event_id")


def event_responses(events: DataFrame, *carry: str) -> DataFrame:
    """Events as responses (batch or stream): the type is the question, the properties are the answer. Columns to ``carry`` stay."""
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts").cast("timestamp").alias("executed_at"),
        F.col("value").alias("execution_time_ms"),
        F.col("event_type").alias("query"),
        F.lit(None).cast("array<struct<id:string,content:string,category:string,score:double>>").alias("retrieved_docs"),
        F.when(~failed, F.col("props")).alias("analysis_output"),
        F.when(failed, F.lit("event reported an error")).alias("error"),
        *carry,
    )


def event_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stored telemetry: tokens and similarity from the number in ``props``."""
    events = table(spark, sf_dir, "events")
    number = F.get_json_object("props", "$.k").cast("bigint")
    rows = events.select("event_id", "ts", "value", "event_type", number.alias("k"))
    return rows.select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts").cast("timestamp").alias("execution_timestamp"),
        F.col("value").alias("execution_time_ms"),
        (F.col("k") / 100).alias("vector_similarity_score"),
        F.col("k").alias("prompt_tokens"),
        (F.col("k") * 2).alias("completion_tokens"),
        (F.col("k") * F.lit("0.000035").cast("decimal(12,6)")).cast("decimal(18,6)").alias("total_cost_usd"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
    )


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def corpus_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def file_states(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    """path, modificationTime, content of documents as files; ``changed`` is a later state: German ones deleted, French ones replaced, Spanish
    ones cut to half, English ones of even length extended."""
    rows = table(spark, sf_dir, "documents")
    text, modified = F.col("text"), F.lit(RUN_TS).cast("timestamp")
    if changed:
        rows = rows.where("lang IS DISTINCT FROM 'de'")
        grown = (F.col("lang") == "en") & (F.length("text") % 2 == 0)
        half = F.substring("text", F.lit(1), F.ceil(F.length("text") / 2).cast("int"))
        text = F.when(F.col("lang") == "fr", F.reverse("text")).when(F.col("lang") == "es", half).when(grown, F.concat("text", F.lit(" "), "text")).otherwise(F.col("text"))
        modified = F.when(F.col("lang").isin("fr", "es") | grown, F.lit(RUN_TS + timedelta(days=1))).otherwise(F.lit(RUN_TS)).cast("timestamp")
    return rows.select(file_path().alias("path"), modified.alias("modificationTime"), text.cast("binary").alias("content"))


def export_text_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Each document as a ``.txt`` file of its own in nested folders. A file ends with a line feed.

    On a file system of this machine or a mount the tasks open the files themselves, as Hadoop without its native library starts a process for
    the permissions of each; elsewhere Spark's writer makes them.
    """
    rows = spread_small(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        rows.drop("doc_id").write.partitionBy("lang", "source").options(**MANY_FILES).option("maxRecordsPerFile", 1).text(path)
        return
    folder = target.toUri().getPath()
    os.makedirs(folder, exist_ok=True)
    # In one order, so that a repeated task gives the same files the same names.
    ordered = rows.withColumn("text", F.col("text").cast("binary")).sortWithinPartitions("lang", "source", "doc_id", "text").drop("doc_id")
    ordered.mapInArrow(_write_files(folder), "files bigint").agg(F.sum("files")).collect()


def _write_files(folder: str):
    """Write each row to a file of its own below ``lang=…/source=…``, named as Spark names partitions."""

    def named(column: str, value: str | None) -> str:
        return f"{column}={_SPECIAL.sub(lambda c: f'%{ord(c[0]):02X}', value) if value else '__HIVE_DEFAULT_PARTITION__'}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, made = TaskContext.get().partitionId(), 0, set()
        for batch in batches:
            for text, lang, source in zip(*batch.columns, strict=True):
                to = f"{folder}/{named('lang', lang.as_py())}/{named('source', source.as_py())}"
                if to not in made:
                    os.makedirs(to, exist_ok=True)
                    made.add(to)
                # Under a name of its own first, so that attempts of one task never share an open file.
                own = f"{to}/.{part}-{number}-{uuid.uuid4().hex}"
                with open(own, "wb") as out:
                    out.write(text.as_py() or b"")
                    out.write(b"\n")
                os.replace(own, f"{to}/part-{part:05d}-{number:09d}.txt")
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], names=["files"])

    return run
