import pytest
from conftest import SF_DIR, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions.text import chunk_windows
from gleanery.operators.chunking import explode_chunks, silver_chunks

EDGE_LENGTHS = [0, 1, 49, 50, 51, 449, 450, 451, 499, 500, 501, 900, 950, 951]


def windows(text, size, step):
    return [text[start : start + size] for start in range(0, len(text), step)]


def chunked(spark, texts, size=500, overlap=50):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    out = rows.select("n", chunk_windows(F.col("text"), size, overlap).alias("c")).orderBy("n").collect()
    return [row["c"] for row in out]


@pytest.mark.parametrize("letter", ["a", "é", "中", "😀", "\n", "\r\n", " ", "\u0085"])
def test_edge_lengths(spark, letter):
    texts = [(letter * n)[:n] for n in EDGE_LENGTHS]
    assert chunked(spark, texts) == [windows(t, 500, 450) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=120), min_size=1, max_size=8),
    size=st.integers(1, 30),
    data=st.data(),
)
def test_any_text_size_and_overlap(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    assert chunked(spark, texts, size, overlap) == [windows(t, size, size - overlap) for t in texts]


@pytest.mark.parametrize("size, overlap", [(10, 10), (10, 11), (10, -1), (0, 0)])
def test_windows_that_would_never_end_are_refused(size, overlap):
    with pytest.raises(ValueError):
        chunk_windows(None, size, overlap)


def test_null_and_empty_texts_give_no_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "n int, text string")
    assert [tuple(r) for r in explode_chunks(rows, "text").collect()] == [(3, 0, "x")]


def test_long_text_is_walked_once(spark):
    rows = spark.range(1).select("id", F.repeat(F.lit("abcdéfg ij"), 2_000_000).alias("text"))
    assert explode_chunks(rows, "text").count() == -(-20_000_000 // 450)


def test_ids_are_unique_and_stable(spark):
    bronze = spark.createDataFrame(
        [("a.txt", "x" * 1400), ("b.txt", "x" * 1400), ("c.txt", "y")], "file_path string, raw_text string"
    ).withColumn("ingested_at", F.current_timestamp())
    first = [r["chunk_id"] for r in silver_chunks(bronze).collect()]
    again = [r["chunk_id"] for r in silver_chunks(bronze.repartition(3)).collect()]
    assert len(first) == 9 and len(set(first)) == 9 and set(first) == set(again)


def test_plan_has_no_python_and_no_shuffle(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(explode_chunks(documents.select("doc_id", "text"), "text"))
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
