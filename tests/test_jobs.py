import json

import pytest

from gleanery.jobs import parse, run
from gleanery.operators.quality import QualityError
from gleanery.plans.document_index import REJECTED_REQUESTS, RESPONSES, publish_answers
from gleanery.sinks.tables import TableStore


def lines(path, rows):
    path.write_text("\n".join(json.dumps(row) for row in rows))
    return str(path)


def test_documents_and_questions_from_json_lines(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "tables"))
    documents = lines(tmp_path / "documents.json", [{"id": "a", "content": "badge readers in the east wing"}, {"content": "cold storage of old tables", "category": "db"}, {"id": "x"}])
    assert dict(run(store, "ingest-documents", documents).rows) == {"document_vectors": 2, "rejected_documents": 1}
    questions = lines(tmp_path / "questions.json", [{"request_id": "1", "query": "badge readers"}, {"request_id": "2", "query": " "}, {"request_id": "3", "query": ""}])
    assert dict(run(store, "answer", questions).rows) == {RESPONSES: 2, REJECTED_REQUESTS: 1}
    found = {r["request_id"]: r for r in store.read(RESPONSES).collect()}
    assert found["1"]["retrieved_docs"][0]["id"] == "a" and found["2"]["error"] == "Empty query provided to Retrieval Agent."


def test_responses_that_break_the_contract_are_not_published(spark, tmp_path, policies):
    from gleanery.plans.document_index import ingest_documents

    store = TableStore(spark, str(tmp_path))
    ingest_documents(store, policies)
    twice = spark.createDataFrame([("1", "badge readers"), ("1", "green build")], "request_id string, query string")
    with pytest.raises(QualityError, match=r"unique\(request_id\): 2 of 2"):
        publish_answers(store, twice)
    assert store.read(RESPONSES) is None


def test_arguments():
    assert parse(["answer", "/q", "--root", "/x"]).job == "answer"
    assert parse(["ingest-changed", "--root", "/x"]).path == "raw_docs"
