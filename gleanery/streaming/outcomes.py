"""Every response of a stream with its outcome, told by a state per request with a timer; responses joined with times that come as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from gleanery.operators.telemetry import measured, records
from gleanery.plans.medallion import TELEMETRY
from gleanery.plans.usage_log import REJECTED_TELEMETRY, log_records
from gleanery.session import materialize
from gleanery.sinks.tables import TableStore
from gleanery.streaming.batches import batch_version, paced
from gleanery.streaming.telemetry import unlogged

ACCEPTED, LATE, REPLAY, REJECTED = "accepted", "late", "replay", "rejected"
LATE_TELEMETRY, REPLAYED_TELEMETRY = "late_telemetry", "replayed_telemetry"

#: Groups that late and rejected responses of a micro-batch pass the state in.
_ASIDE = 1024
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started here keep their state in RocksDB, on disk; a state with timers needs that."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _first_of_request() -> StatefulProcessor:
    # A class of this function travels with the tasks; executors need not have the package.
    class FirstOfRequest(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.until = handle.getValueState("until", "until long")
            self.newest = 0

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            if key[1] is None:
                yield from (Row(record=row["record"], again=False) for row in rows)
                return
            known, first = self.until.exists(), None
            for row in rows:
                self.newest = max(self.newest, row["arrived"])
                if not known and first is None:
                    first = row
                    continue
                if first is not None and (row["arrived"], row["time"]) < (first["arrived"], first["time"]):
                    first, row = row, first
                yield Row(record=row["record"], again=True)
            if first is not None:
                # What will be over when the batch ends need not be remembered: whatever comes later arrives later.
                if first["until"] * 1000 > self.newest:
                    self.until.update((first["until"],))
                    self.handle.registerTimer(first["until"])
                yield Row(record=first["record"], again=False)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            self.until.clear()
            return iter([])

        def close(self) -> None:
            pass

    return FirstOfRequest()


def response_outcomes(responses: DataFrame, lateness: timedelta = timedelta(hours=1), arrived: Column | None = None) -> DataFrame:
    """One telemetry record per response of a stream, with ``arrived_at`` and ``outcome``; none is dropped.

    * ``rejected``: without a time, or more than ``lateness`` ahead of its arrival.
    * ``late``: arrived more than ``lateness`` after its time.
    * ``accepted``: of the others, the first of its request and day; of several in a micro-batch the first to arrive, then the earliest.
    * ``replay``: a further one.

    A request is remembered until ``lateness`` after its arrival and its time, when a timer clears it. A copy that comes later is late by then, so no
    request is accepted twice at the same time, and the state holds the requests of the last ``lateness`` (twice that, where times run ahead).
    Documents and answers are counted before the shuffle by request. ``arrived`` must not fall from one micro-batch to the
    next; by default it is the time of the micro-batch, which a replayed batch keeps.

    A request costs some calls to its state, and a message back whose columns cost each. So a record passes the state as one text, late and rejected
    ones in groups of many. Newer days come first (``days_back``), so that of a batch over many days only the end is remembered.
    """
    stamped = responses.withColumn("arrived_at", F.current_timestamp() if arrived is None else arrived)
    found = records(measured(stamped, ["arrived_at"]), ["arrived_at"])
    time, at, span = F.col("execution_timestamp"), F.col("arrived_at"), _interval(lateness)
    outcome = F.when(time.isNull() | (time > at + span), REJECTED).when(time < at - span, LATE).otherwise(ACCEPTED)
    found = found.withColumn("outcome", outcome).withWatermark("arrived_at", "0 seconds")
    times = {c: F.unix_micros(c) for c in ("execution_timestamp", "arrived_at")}
    own = F.col("outcome") == ACCEPTED
    asked = found.select(
        F.when(own, -F.unix_date(F.to_date(time))).otherwise(F.pmod(F.xxhash64("request_id", time, at), F.lit(_ASIDE)).cast("int")).alias("days_back"),
        F.when(own, F.col("request_id")).alias("request_id"),
        F.coalesce(times["arrived_at"], F.lit(0)).alias("arrived"),
        F.coalesce(times["execution_timestamp"], F.lit(0)).alias("time"),
        (F.unix_millis(F.greatest(at, time)) + _millis(lateness) + 1).alias("until"),
        F.to_json(F.struct(*[times[c].alias(c) if c in times else F.col(c) for c in found.columns])).alias("record"),
        "arrived_at",
    )
    told = asked.groupBy("days_back", "request_id").transformWithState(
        statefulProcessor=_first_of_request(), outputStructType="record string, again boolean", outputMode="Append", timeMode="EventTime"
    )
    told = told.select(F.from_json("record", found.withColumns(times).schema, {"maxStringLen": str(2**31 - 1)}).alias("record"), "again")
    told = told.select("record.*", "again").withColumns({c: F.timestamp_micros(c) for c in times})
    outcome = F.when(F.col("again"), REPLAY).otherwise(F.col("outcome"))
    return told.select(*[c for c in found.columns if c != "outcome"], F.to_date("execution_timestamp").alias("run_date"), outcome.alias("outcome"))


def route_responses(
    responses: DataFrame,
    store: TableStore,
    checkpoint: str,
    lateness: timedelta = timedelta(hours=1),
    arrived: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Log the accepted records of each micro-batch and set late ones, replays and rejects aside in tables of their own, without a look at
    the log. The four tables add up to the input. One checkpoint belongs to a store: another one knows none of its requests.
    """
    tables = {LATE: LATE_TELEMETRY, REPLAY: REPLAYED_TELEMETRY, REJECTED: REJECTED_TELEMETRY}

    def route(batch: DataFrame, number: int) -> None:
        version = batch_version(store.spark, number)
        rows = materialize(batch, "outcomes")
        log_records(store, rows.where(F.col("outcome") == ACCEPTED).drop("arrived_at", "outcome", "run_date"), version)
        for outcome, table in tables.items():
            store.append(rows.where(F.col("outcome") == outcome).drop("outcome", "run_date"), table, version)

    with rocksdb_state(store.spark):
        return paced(response_outcomes(responses, lateness, arrived).writeStream.foreachBatch(route), checkpoint, every).start()


def settle_late(store: TableStore, version: str) -> int:
    """Log the late records that the log lacks, the first of each request and day; returns how many. A second run finds none."""
    late = store.read(LATE_TELEMETRY)
    if late is None:
        return 0
    return log_records(store, materialize(unlogged(late.drop("arrived_at"), store.read(TELEMETRY)), "late"), version)


def joined_with_times(
    responses: DataFrame, timings: DataFrame, within: timedelta = timedelta(hours=1), lateness: timedelta = timedelta(hours=1)
) -> DataFrame:
    """Telemetry of streamed responses (with ``answered_at``) and their streamed times (request_id, executed_at, execution_time_ms).

    A time belongs to a response of its request that was answered up to ``within`` after it. Both sides wait for each other until the watermarks,
    ``lateness`` behind the newest rows of the slower stream, have passed; a response that then has no time comes out without one.
    Of several times of a request the first to arrive counts. Responses and times without their timestamp never match and are left
    out, as are rows behind the watermark. Documents and answers are counted before the join, so the state holds short rows.
    """
    delay = f"{_millis(lateness)} milliseconds"
    answers = measured(responses.where("answered_at IS NOT NULL").drop("executed_at", "execution_time_ms"), ["answered_at"])
    answers = answers.withWatermark("answered_at", delay)
    times = timings.where("executed_at IS NOT NULL").select(F.col("request_id").alias("timed_id"), "executed_at", "execution_time_ms")
    times = times.withWatermark("executed_at", delay).dropDuplicatesWithinWatermark(["timed_id"])
    same = F.col("request_id") == F.col("timed_id")
    near = F.col("executed_at").between(F.col("answered_at") - _interval(within), F.col("answered_at"))
    return records(answers.join(times, same & near, "left"))


def _millis(span: timedelta) -> int:
    return round(span.total_seconds() * 1000)


def _interval(span: timedelta) -> Column:
    return F.expr(f"INTERVAL '{span.total_seconds():.6f}' SECOND")
