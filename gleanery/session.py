"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_bases: dict[str, str] = {}


def build_session(app_name: str = "gleanery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC days, AQE with skew joins, Arrow)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a single-machine session (as in tests) may go without it; there a temporary folder stands in.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_bases:
        _local_bases[context.applicationId] = tempfile.mkdtemp(prefix="gleanery-")
    return _local_bases[context.applicationId]


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{shared_base(spark)}/gleanery/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives executor loss."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_in_bytes(size: str) -> int:
    """A size as Spark's settings write it: a number, and a unit from b to p."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([bkmgtp]?)b?\s*", size.lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit if unit not in ("", "b") else " ")


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an input smaller than one scan split per core over all cores, ahead of CPU-heavy work.

    Larger inputs already arrive in enough splits and pass through without a shuffle.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = size_in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if estimate >= cores * split:
        return df
    return df.repartition(cores, *keys)
