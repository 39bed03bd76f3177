"""Documents handed over as records: content is required, id and category are optional."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_SCHEMA = "id STRING, content STRING, category STRING"
DEFAULT_CATEGORY = "general"  # fixed value


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with a declared schema: no inference pass, absent keys become null."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def accept_documents(documents: DataFrame) -> DataFrame:
    """Rows with content, defaults filled in. A missing id is derived from the content, so a replay of
    the same document meets the same key."""
    return documents.where(F.col("content").isNotNull()).select(
        F.coalesce("id", F.concat(F.lit("doc_"), F.md5("content"))).alias("id"),
        "content",
        F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category"),
    )


def reject_documents(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("content").isNull()).withColumn("reason", F.lit("content is missing"))
