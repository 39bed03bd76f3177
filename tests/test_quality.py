from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.operators.quality import QualityError, Rule, Suite, audit, gold_suite, mart_suite, not_null, require, silver_suite, unique_check

SILVER = "chunk_id string, file_path string, chunk_text string"
GOLD = "chunk_id string, embedding_vector array<float>"
MART = "run_date date, total_agent_queries bigint, total_spend_usd double"
GOOD_SILVER = [("1", "f", "abc"), ("2", "f", "abcd")]
GOOD_GOLD = [("1", [1.0, 2.0]), ("2", [0.0, 0.0])]
DAY = datetime(2024, 1, 1).date()
GOOD_MART = [(DAY, 1, 0.5)]


def failures(df, suite):
    return {(r["check"], r["column"]): (r["failed"], r["total"]) for r in audit(df, suite).collect() if not r["passed"]}


SUITES = {
    "silver": (lambda: silver_suite(4), SILVER, GOOD_SILVER),
    "gold": (lambda: gold_suite(2), GOLD, GOOD_GOLD),
    "mart": (mart_suite, MART, GOOD_MART),
}
NEXT_DAY = datetime(2024, 1, 2).date()
CASES = [
    ("silver", [("3", "f", None)], ("not_null", "chunk_text"), (1, 3)),
    ("silver", [("3", None, "x")], ("not_null", "file_path"), (1, 3)),
    ("silver", [("3", "f", "")], ("not_empty", "chunk_text"), (1, 3)),
    ("silver", [("3", "f", "abcde")], ("max_length", "chunk_text"), (1, 3)),
    ("silver", [("2", "f", "x"), ("2", "f", "y")], ("unique", "chunk_id"), (3, 4)),
    ("gold", [("3", None)], ("not_null", "embedding_vector"), (1, 3)),
    ("gold", [(None, [1.0, 1.0])], ("not_null", "chunk_id"), (1, 3)),
    ("gold", [("3", [1.0]), ("4", [])], ("dimension", "embedding_vector"), (2, 4)),
    ("gold", [("3", [1.0, float("nan")]), ("4", [1.0, None])], ("finite", "embedding_vector"), (2, 4)),
    ("mart", [(None, 1, 0.5)], ("not_null", "run_date"), (1, 2)),
    ("mart", [(DAY, 2, 0.5)], ("unique", "run_date"), (2, 2)),
    ("mart", [(NEXT_DAY, None, 0.5)], ("not_null", "total_agent_queries"), (1, 2)),
    ("mart", [(NEXT_DAY, 1, None)], ("not_null", "total_spend_usd"), (1, 2)),
]


@pytest.mark.parametrize("name, bad, check, counts", CASES)
def test_each_check_passes_and_fails(spark, name, bad, check, counts):
    suite, schema, good = SUITES[name]
    assert failures(spark.createDataFrame(good, schema), suite()) == {}
    assert failures(spark.createDataFrame(good + bad, schema), suite()) == {check: counts}


def test_unique_ignores_nulls(spark):
    rows = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert tuple(unique_check(rows, "k").first()) == ("unique", "k", 0, 1)


def test_empty_table_passes(spark):
    assert failures(spark.createDataFrame([], SILVER), silver_suite()) == {}


def test_schema_check(spark):
    rows = spark.createDataFrame([(1, "x")], "a int, b string")
    wanted = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    assert failures(rows, Suite("s", [], schema=wanted)) == {("schema", "a,c"): (2, 2)}
    assert failures(rows, Suite("s", [], schema=rows.schema)) == {}


def test_verdict(spark):
    rows = spark.createDataFrame([(None, 1)], "a int, b int")
    assert len(require(rows, Suite("s", [not_null("b")]))) == 1
    with pytest.raises(QualityError, match=r"s: not_null\(a\): 1 of 1"):
        require(rows, Suite("s", [not_null("a"), not_null("b")]))


def test_row_checks_share_one_pass(spark):
    plan = audit(spark.createDataFrame(GOOD_GOLD, GOLD), gold_suite(2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def test_a_suite_reads_its_input_once(spark, tmp_path):
    """Row rules, two unique columns of different types, nulls and copies; one scan in the plan."""
    from conftest import plan_of

    path = str(tmp_path / "rows")
    rows = [(1, "a", 1.0), (1, "b", None), (2, "b", 2.0), (None, None, 3.0), (None, "c", None)]
    spark.createDataFrame(rows, "k int, v string, x double").write.parquet(path)
    df = spark.read.parquet(path)
    suite = Suite("s", [not_null("x"), Rule("small", "x", F.col("x") > 2)], unique=["k", "v"])
    report = audit(df, suite)
    got = {(r["check"], r["column"]): (r["failed"], r["total"], r["passed"]) for r in report.collect()}
    assert got == {("not_null", "x"): (2, 5, False), ("small", "x"): (1, 5, False), ("unique", "k"): (2, 3, False), ("unique", "v"): (2, 4, False)}
    assert plan_of(audit(df, suite)).count("Scan parquet") == plan_of(audit(df, Suite("s", [not_null("x")]))).count("Scan parquet")
    empty = audit(df.limit(0), Suite("s", [not_null("x")], unique=["k"])).collect()
    assert all(r["passed"] and (r["failed"], r["total"]) == (0, 0) for r in empty)


def test_the_write_counts_the_row_rules(spark, tmp_path, monkeypatch):
    """Rows that break a rule are refused without being read again."""
    from gleanery.operators import quality
    from gleanery.sinks.tables import TableStore

    store = TableStore(spark, str(tmp_path))
    monkeypatch.setattr(quality, "audit", lambda df, suite: pytest.fail("read again") if suite.rules else audit(df, suite))
    suite = Suite("s", [not_null("x"), Rule("small", "x", F.col("x") > 2)], unique=["k"])
    assert store.append(spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, x double"), "t", suite=suite) == 2
    with pytest.raises(QualityError, match=r"not_null\(x\): 1 of 3; small\(x\): 1 of 3; unique\(k\): 2 of 3"):
        store.append(spark.createDataFrame([(1, None), (1, 2.0), (2, 3.0)], "k int, x double"), "t", suite=suite)
