import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracles import TABLES, rows_of  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from gleanery.catalog.oracles import ORACLES  # noqa: E402
from gleanery.catalog.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in df.collect()]
    assert rows
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, rows) == rows_of(columns, result.fetchall())


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and set(QUERIES) - set(ORACLES) == {"knn_lsh_top2", "knn_ivf_top2"}


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "analysis_output" in df.columns
