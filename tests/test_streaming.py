from datetime import datetime, timedelta

import pytest

from gleanery.operators.mart import daily_mart, mart_of_states
from gleanery.plans.medallion import BRONZE, GOLD, SILVER, TELEMETRY, IngestSettings, ingest_bronze
from gleanery.plans.usage_log import REJECTED_TELEMETRY
from gleanery.sinks.tables import TableStore
from gleanery.sources.text_files import bronze_rows, scan_text_files
from gleanery.streaming.ingest import ingest_new_files
from gleanery.streaming import telemetry
from gleanery.streaming.mart import append_closed_days, mart_table, publish_mart
from gleanery.streaming.telemetry import accepted_telemetry, log_responses, publish_stream, rejected_responses, write_files

RESPONSE = (
    "request_id string, executed_at timestamp, execution_time_ms double, query string, "
    "retrieved_docs array<struct<id:string,content:string,category:string,score:double>>, analysis_output string, error string"
)
START = datetime(2024, 1, 1)


def response(n, at):
    return (None if n is None else f"r{n}", at, float(n or 0), "a question", None, "an answer", "bad" if n == 3 else None)


class Drops:
    """Files dropped one by one into the folder a stream reads."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        (base / "in").mkdir()

    def drop(self, rows):
        self.spark.createDataFrame(rows, RESPONSE).coalesce(1).write.mode("append").parquet(str(self.base / "in"))

    def responses(self):
        return self.spark.readStream.schema(RESPONSE).parquet(str(self.base / "in"))

    def telemetry(self):
        path, checkpoint = str(self.base / "telemetry"), str(self.base / "cp-telemetry")
        write_files(accepted_telemetry(self.responses()), path, checkpoint, "execution_timestamp").awaitTermination()
        return self.spark.read.parquet(path)


@pytest.fixture
def drops(spark, tmp_path):
    return Drops(spark, tmp_path)


def ids(df):
    return sorted(r["request_id"] for r in df.select("request_id").collect())


def test_telemetry_drops_replays_and_keeps_the_rest(drops):
    drops.drop([response(n, START + timedelta(minutes=n)) for n in range(5)])
    assert ids(drops.telemetry()) == [f"r{n}" for n in range(5)]
    drops.drop([response(4, START + timedelta(minutes=4)), response(9, START + timedelta(minutes=9))])
    records = drops.telemetry()
    assert ids(records) == ["r0", "r1", "r2", "r3", "r4", "r9"]
    assert {r["request_id"]: r["status_code"] for r in records.collect()}["r3"] == 500


def test_records_without_time_are_set_aside_and_missing_keys_derived(drops, spark, tmp_path):
    drops.drop([response(1, START), response(None, START), response(None, START), response(2, None)])
    keys = ids(drops.telemetry())
    assert len(keys) == 2 and "r1" in keys and all(keys)
    path = str(tmp_path / "rejects")
    write_files(rejected_responses(drops.responses()), path, str(tmp_path / "cp-rejects")).awaitTermination()
    assert [r["request_id"] for r in spark.read.parquet(path).collect()] == ["r2"]


def test_log_keeps_late_rows(drops, spark, tmp_path):
    """Days arrive newest first, with a replay and a row without time: accepted, rejected and replays add up to the input."""
    store = TableStore(spark, str(tmp_path / "tables"))
    drops.drop([response(n, START + timedelta(days=9, minutes=n)) for n in range(3)])
    drops.drop([response(n, START + timedelta(days=5)) for n in (10, 11, 11)] + [response(12, None)])
    drops.drop([response(20, START), response(1, START + timedelta(days=9, minutes=1))])
    arriving = spark.readStream.schema(RESPONSE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    log_responses(arriving, store, str(tmp_path / "cp-log")).awaitTermination()
    assert ids(store.read(TELEMETRY)) == ["r0", "r1", "r10", "r11", "r2", "r20"]
    assert ids(store.read(REJECTED_TELEMETRY)) == ["r12"]


def test_mart_is_merged_batch_by_batch(drops, spark, tmp_path, monkeypatch):
    """Late days, a replayed batch and a second stream: the states equal the mart of all records, and only new records are read."""
    store = TableStore(spark, str(tmp_path / "tables"))
    mart, checkpoint, read = mart_table(store, 4), tmp_path / "cp-log", []
    merge = telemetry.merge_batch
    monkeypatch.setattr(telemetry, "merge_batch", lambda table, records, version: read.append(records.count()) or merge(table, records, version))

    def run(path=checkpoint):
        log_responses(drops.responses(), store, str(path), mart=mart).awaitTermination()
        assert sorted(mart_of_states(mart.read()).collect()) == sorted(daily_mart(store.read(TELEMETRY)).collect())

    drops.drop([response(n, START + timedelta(days=3, hours=5 * n)) for n in range(9)] + [response(40, None)])
    run()
    drops.drop([response(n, START + timedelta(hours=5 * n)) for n in range(20, 30)] + [response(0, START + timedelta(days=3))])
    run()
    replay_last_batch(checkpoint)
    run()
    run(tmp_path / "another-checkpoint")
    assert read[:3] == [9, 10, 10] and store.read(TELEMETRY).count() == 19


def replay_last_batch(checkpoint):
    """As if the job had died after publishing but before the batch was committed."""
    last = max((checkpoint / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for file in (last, last.with_name(f".{last.name}.crc")):
        file.unlink(missing_ok=True)


def test_replayed_batch_is_published_once(drops, spark, tmp_path):
    store, checkpoint = TableStore(spark, str(tmp_path / "tables")), tmp_path / "cp"

    def run():
        publish_stream(accepted_telemetry(drops.responses()), store, "telemetry", str(checkpoint)).awaitTermination()
        return ids(store.read("telemetry"))

    drops.drop([response(n, START) for n in range(3)])
    assert run() == ["r0", "r1", "r2"]
    replay_last_batch(checkpoint)
    drops.drop([response(n, START) for n in range(2, 5)])
    assert run() == ["r0", "r1", "r2", "r3", "r4"]


def test_replayed_mart_batch(drops, spark, tmp_path):
    store, checkpoint = TableStore(spark, str(tmp_path / "tables")), tmp_path / "cp-mart"

    def run():
        records = drops.telemetry()
        stream = spark.readStream.schema(records.schema).parquet(str(tmp_path / "telemetry"))
        publish_mart(stream, store, "mart", str(checkpoint)).awaitTermination()
        assert sorted(store.read("mart").collect()) == sorted(daily_mart(records).collect())

    drops.drop([response(n, START) for n in range(3)])
    run()
    replay_last_batch(checkpoint)
    drops.drop([response(n, START) for n in range(3, 5)])
    run()


def test_complete_mart_equals_batch_mart(drops, spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))

    def run():
        records = drops.telemetry()
        stream = spark.readStream.schema(records.schema).parquet(str(tmp_path / "telemetry"))
        publish_mart(stream, store, "mart", str(tmp_path / "cp-mart")).awaitTermination()
        assert sorted(store.read("mart").collect()) == sorted(daily_mart(records).collect())
        return store.read("mart").count()

    drops.drop([response(n, START + timedelta(hours=5 * n)) for n in range(10)])
    assert run() == 2 + 0
    drops.drop([response(n, START + timedelta(hours=5 * n)) for n in range(8, 20)])
    assert run() == 4


def test_append_mart_emits_closed_days_once_and_leaves_late_records_out(drops, spark, tmp_path):
    def run():
        schema = drops.telemetry().schema
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "telemetry"))
        append_closed_days(stream, str(tmp_path / "closed"), str(tmp_path / "cp-closed")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "closed")).collect()
        return {r["run_date"].day: r["total_agent_queries"] for r in rows}

    drops.drop([response(n, START + timedelta(hours=12 * n)) for n in range(8)])
    assert run() == {1: 2, 2: 2}
    drops.drop([response(50, START), response(51, START + timedelta(days=9))])
    assert run() == {1: 2, 2: 2, 3: 2, 4: 2}


def test_ingestion_sees_each_file_once(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    store = TableStore(spark, str(tmp_path / "tables"))

    def run():
        ingest_new_files(store, str(raw), str(tmp_path / "cp"), files_per_batch=2).awaitTermination()
        return tuple(store.read(t).count() for t in (BRONZE, SILVER, GOLD))

    for n in range(3):
        (raw / f"{n}.txt").write_text(str(n) * 600)
    (raw / "skipped.md").write_text("no")
    assert run() == (3, 6, 6) and len(store.versions(BRONZE)) == 2
    assert run() == (3, 6, 6)
    (raw / "late.txt").write_text("late")
    assert run() == (4, 7, 7)
    ingest_new_files(store, str(raw), str(tmp_path / "another-checkpoint")).awaitTermination()
    assert run() == (4, 7, 7)


def test_batch_that_died_half_way_is_completed(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text("a" * 600)
    store = TableStore(spark, str(tmp_path / "tables"))
    bronze = bronze_rows(scan_text_files(spark, str(raw)), START)
    store.append(bronze, BRONZE, "batch-0")
    store.stage(bronze.limit(0), SILVER, "batch-0")
    ingest_bronze(store, bronze, IngestSettings(), "batch-0")
    assert [store.read(t).count() for t in (BRONZE, SILVER, GOLD)] == [1, 2, 2]
