"""Table checks as aggregates.

A suite is a list of row rules plus the columns that must be unique. All checks of a suite are counted in one pass over its input:
rows are grouped by their unique value, combined before the shuffle, and the row rules are counted within these groups. A table's
write can count the row rules itself (``failures``, ``require``), which leaves the unique columns to be read.
A report has one row per check: suite, check, column, failed, total, passed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.functions.text import CHUNK_SIZE
from gleanery.functions.vectors import has_bad_value
from gleanery.operators.embedding import EMBEDDING_DIM

REPORT_COLUMNS = ["suite", "check", "column", "failed", "total", "passed"]


@dataclass(frozen=True)
class Rule:
    """``broken`` is true on a row that violates the rule; null counts as kept."""

    check: str
    column: str
    broken: Column


@dataclass(frozen=True)
class Suite:
    name: str
    rules: Sequence[Rule]
    unique: Sequence[str] = ()
    schema: T.StructType | None = None


class QualityError(Exception):
    """A suite failed; what it checked has not been published."""


def not_null(column: str) -> Rule:
    return Rule("not_null", column, F.col(column).isNull())


def silver_suite(chunk_size: int = CHUNK_SIZE, schema: T.StructType | None = None) -> Suite:
    text = F.col("chunk_text")
    return Suite(
        "silver",
        [
            not_null("chunk_text"),
            not_null("file_path"),
            Rule("not_empty", "chunk_text", F.length(text) == 0),
            Rule("max_length", "chunk_text", F.length(text) > chunk_size),
        ],
        unique=["chunk_id"],
        schema=schema,
    )


def gold_suite(dim: int = EMBEDDING_DIM, schema: T.StructType | None = None) -> Suite:
    vector = F.col("embedding_vector")
    return Suite(
        "gold",
        [
            not_null("embedding_vector"),
            not_null("chunk_id"),
            Rule("dimension", "embedding_vector", F.size(vector) != dim),
            Rule("finite", "embedding_vector", has_bad_value(vector)),
        ],
        schema=schema,
    )


def mart_suite() -> Suite:
    return Suite(
        "mart", [not_null(c) for c in ("run_date", "total_agent_queries", "total_spend_usd")], unique=["run_date"]
    )


def index_suite(dim: int = EMBEDDING_DIM, key: str = "chunk_id") -> Suite:
    """A search table takes vectors of one length, one per key."""
    return Suite("index", [rule for rule in gold_suite(dim).rules if rule.column != "chunk_id"] + [not_null(key)], unique=[key])


def response_suite() -> Suite:
    """What every answered request owes its caller."""
    incomplete = F.exists(
        "retrieved_docs", lambda d: d["id"].isNull() | d["content"].isNull() | d["category"].isNull() | d["score"].isNull()
    )
    return Suite(
        "response",
        [*(not_null(c) for c in ("query", "current_step", "retrieved_docs")), Rule("complete", "retrieved_docs", incomplete)],
        unique=["request_id"],
    )


def failures(suite: Suite) -> list[Column]:
    """Aggregates ``failed_0``, ``failed_1``, ... that count the rows which break each row rule."""
    return [F.count_if(rule.broken).alias(f"failed_{n}") for n, rule in enumerate(suite.rules)]


def _value_key(df: DataFrame, column: str) -> Column:
    """Strings are counted by their SHA-256, so that long texts are not shuffled."""
    value = F.col(column)
    return F.unhex(F.sha2(value, 256)) if isinstance(df.schema[column].dataType, T.StringType) else value


def _counted(df: DataFrame, suite: Suite) -> DataFrame:
    """One row: ``total``, the failures of each rule, and for unique column n ``copies_n`` and ``values_n``."""
    if not suite.unique:
        return df.agg(F.count("*").alias("total"), *failures(suite))
    keys = [_value_key(df, c).cast("binary" if isinstance(df.schema[c].dataType, T.StringType) else "string") for c in suite.unique]
    broken = [F.coalesce(rule.broken, F.lit(False)).cast("int").alias(f"failed_{n}") for n, rule in enumerate(suite.rules)]
    # Several unique columns give one row each; the rules are counted with the first.
    rows = df.select(*broken, F.posexplode(F.array(*[k.cast("binary") for k in keys])).alias("which", "value"))
    first = F.col("which") == 0
    groups = rows.groupBy("which", "value").agg(F.count("*").alias("n"), *[F.sum(F.when(first, F.col(b))).alias(b) for b in _names(suite)])

    def total(n: Column, alias: str) -> Column:
        return F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(alias)

    out = [total(F.when(first, F.col("n")), "total"), *[total(F.col(b), b) for b in _names(suite)]]
    for place in range(len(keys)):
        own = (F.col("which") == place) & F.col("value").isNotNull()
        out += [total(F.when(own & (F.col("n") > 1), F.col("n")), f"copies_{place}"), total(F.when(own, F.col("n")), f"values_{place}")]
    return groups.agg(*out)


def _names(suite: Suite) -> list[str]:
    return [f"failed_{n}" for n in range(len(suite.rules))]


def unique_check(df: DataFrame, column: str) -> DataFrame:
    """Every row of a value that occurs twice or more fails; nulls are left out."""
    copies = df.where(F.col(column).isNotNull()).groupBy(_value_key(df, column).alias("value")).agg(F.count("*").alias("n"))
    return copies.agg(
        F.lit("unique").alias("check"),
        F.lit(column).alias("column"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("bigint").alias("failed"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
    )


def _schema_check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns that are absent or of another type; further columns are allowed."""
    actual = {field.name: field.dataType for field in df.schema}
    wrong = sorted(field.name for field in schema if actual.get(field.name) != field.dataType)
    return df.sparkSession.range(1, numPartitions=1).select(
        F.lit("schema").alias("check"),
        F.lit(",".join(wrong) or "*").alias("column"),
        F.lit(len(wrong)).cast("bigint").alias("failed"),
        F.lit(len(schema)).cast("bigint").alias("total"),
    )


def audit(df: DataFrame, suite: Suite) -> DataFrame:
    """The report of a suite; its input is read once."""

    def line(check: str, column: str, failed: str, total: str) -> Column:
        return F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(failed).alias("failed"), F.col(total).alias("total"))

    lines = [line(rule.check, rule.column, f"failed_{n}", "total") for n, rule in enumerate(suite.rules)]
    lines += [line("unique", column, f"copies_{n}", f"values_{n}") for n, column in enumerate(suite.unique)]
    parts = [_counted(df, suite).select(F.inline(F.array(*lines)))] if lines else []
    parts += [_schema_check(df, suite.schema)] if suite.schema else []
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumns({"suite": F.lit(suite.name), "passed": F.col("failed") == 0}).select(*REPORT_COLUMNS)


def require(df: DataFrame, suite: Suite, counted: Mapping[str, int] | None = None) -> list:
    """Run the suite and raise if any check fails. Returns the report rows, one per check.

    ``counted`` holds ``row_count`` and the ``failures`` that the write of ``df`` counted; row rules are then not run again.
    """
    rest = suite if counted is None else replace(suite, rules=())
    report = audit(df, rest).collect() if rest.rules or rest.unique or rest.schema else []
    if counted is not None:
        rows = [(suite.name, r.check, r.column, counted[n], counted["row_count"], counted[n] == 0) for r, n in zip(suite.rules, _names(suite), strict=True)]
        report = [*(Row(*REPORT_COLUMNS)(*row) for row in rows), *report]
    broken = [f"{r['check']}({r['column']}): {r['failed']} of {r['total']}" for r in report if not r["passed"]]
    if broken:
        raise QualityError(f"{suite.name}: " + "; ".join(broken))
    return report
