from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanery.jobs import DEFAULT_SOURCE, parse
from gleanery.operators.quality import QualityError, audit, response_suite
from gleanery.plans.document_index import DOCUMENT_VECTORS, REJECTED_DOCUMENTS, answer_from_index, document_table, ingest_documents
from gleanery.plans.medallion import MART, TELEMETRY, IngestSettings, rebuild_mart
from gleanery.plans.question_answering import answer_requests
from gleanery.plans.usage_log import REJECTED_TELEMETRY, log_answers
from gleanery.sinks.tables import TableStore

DAYS = [datetime(2024, 1, n) for n in (1, 2, 3)]


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def held(store):
    rows = document_table(store).read().select("doc_id", "payload.content", "payload.category").collect()
    return {r["doc_id"]: (r["content"], r["category"]) for r in rows}


def test_upsert_by_id(spark, store, policies):
    first = ingest_documents(store, policies, run_ts=DAYS[0])
    assert first.rows == {DOCUMENT_VECTORS: 3, REJECTED_DOCUMENTS: 0}
    more = spark.createDataFrame(
        [("policy_02", None, "revised"), (None, "x", "no id"), (None, "x", "no id"), ("lost", "x", None)],
        "id string, category string, content string",
    )
    second = ingest_documents(store, more, run_ts=DAYS[1])
    assert second.rows == {DOCUMENT_VECTORS: 2, REJECTED_DOCUMENTS: 1}
    rows = held(store)
    assert len(rows) == 4 and rows["policy_02"] == ("revised", "general") and rows["policy_01"][1] == "security"
    ingest_documents(store, policies, run_ts=DAYS[2])
    assert held(store)["policy_02"][1] == "deployment" and len(held(store)) == 4
    assert store.read(REJECTED_DOCUMENTS).first()["id"] == "lost"


def test_a_small_hand_over_rewrites_its_own_folders(spark, store):
    def files():
        return {r[0] for r in document_table(store).read().select(F.input_file_name()).distinct().collect()}

    many = spark.range(300).select(F.concat(F.lit("d"), "id").alias("id"), F.lit("c").alias("category"), F.concat(F.lit("text "), "id").alias("content"))
    ingest_documents(store, many, run_ts=DAYS[0])
    before = files()
    more = spark.createDataFrame([("d7", "c", "another text"), ("lost", "c", None)], "id string, category string, content string")
    for _ in range(2):
        ingest_documents(store, more, run_ts=DAYS[1], version="night-2")
    assert len(before - files()) == len(files() - before) == 1
    assert held(store)["d7"] == ("another text", "c") and len(held(store)) == 300
    assert store.read(REJECTED_DOCUMENTS).count() == 1


def test_index_refuses_vectors_of_another_length(store, policies):
    with pytest.raises(QualityError, match="dimension"):
        ingest_documents(store, policies, IngestSettings(dim=10))
    assert not document_table(store).exists()


def test_stored_vectors_give_the_same_answers(spark, store, policies):
    ingest_documents(store, policies)
    requests = spark.createDataFrame([("r1", "badge readers keys"), ("r2", " ")], "request_id string, query string")
    stored = answer_from_index(store, requests)
    assert sorted(stored.collect()) == sorted(answer_requests(requests, policies).collect())
    assert all(r["passed"] for r in audit(stored, response_suite()).collect())


def test_incomplete_documents_break_the_response_contract(spark):
    rows = spark.createDataFrame(
        [("r", "q", "analyst_completed", [("a", "text", None, 0.5)])],
        "request_id string, query string, current_step string, "
        "retrieved_docs array<struct<id:string,content:string,category:string,score:double>>",
    )
    assert [r["check"] for r in audit(rows, response_suite()).collect() if not r["passed"]] == ["complete"]


def test_usage_is_stored_by_day_and_rolled_up(spark, store, policies):
    requests = spark.createDataFrame([(f"r{n}", "readers keys" if n else " ") for n in range(4)], "request_id string, query string")
    timings = spark.createDataFrame([(f"r{n}", DAYS[n % 2], 10.0 * n) for n in range(4)], "request_id string, executed_at timestamp, execution_time_ms double")
    assert log_answers(store, answer_requests(requests, policies), timings, "night-1") == 4
    assert log_answers(store, answer_requests(requests, policies), timings, "night-1") == 0
    records = store.read(TELEMETRY)
    assert records.where(F.col("status_code") == 500).count() == 1 and records.select("run_date").distinct().count() == 2
    files = {r[0].rsplit("/", 2)[1] for r in records.select(F.input_file_name()).distinct().collect()}
    assert files == {"run_date=2024-01-01", "run_date=2024-01-02"}
    assert rebuild_mart(store) == 2
    assert {r["run_date"].day: r["error_count"] for r in store.read(MART).collect()} == {1: 1, 2: 0}


def test_source_folder_has_a_default():
    assert parse(["nightly", "--root", "/x"]).path == DEFAULT_SOURCE
    assert parse(["nightly", "/data/raw", "--root", "/x"]).path == "/data/raw"
    assert parse(["nightly", "--root", "/x", "/data/raw"]).path == "/data/raw"


def test_an_index_that_cannot_be_searched_is_an_error_of_every_request(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "unsearchable"))
    requests = spark.createDataFrame([("r1", "remote work"), ("r2", " ")], "request_id string, query string")
    missing = {r["request_id"]: r for r in answer_from_index(store, requests).collect()}
    assert "does not exist" in missing["r1"]["error"] and missing["r1"]["retrieved_docs"] == []
    assert missing["r2"]["error"] == "Empty query provided to Retrieval Agent."
    ingest_documents(store, spark.createDataFrame([("d", "remote work", "hr")], "id string, content string, category string"))
    other = answer_from_index(store, requests.where("request_id = 'r1'"), IngestSettings(dim=100)).first()
    assert "384 dimensions" in other["error"] and other["retrieval_step"] == "retrieval_failed"


def test_answers_without_timing_are_set_aside(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "log"))
    responses = spark.createDataFrame(
        [("a", "q", None, "text", None), ("b", "q", None, "text", None)],
        "request_id string, query string, retrieved_docs array<struct<id:string,content:string,category:string,score:double>>, "
        "analysis_output string, error string",
    )
    times = spark.sql("SELECT 'a' request_id, timestamp'2024-01-01' + make_interval(0,0,0,i) executed_at, 1D execution_time_ms FROM (SELECT explode(sequence(0, 1)) i)")
    assert log_answers(store, responses, times) == 1
    assert log_answers(store, responses.withColumn("request_id", F.concat("request_id", F.lit("2"))), times) == 0
    assert [r["request_id"] for r in store.read(REJECTED_TELEMETRY).orderBy("request_id").collect()] == ["a2", "b", "b2"]
