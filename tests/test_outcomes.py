from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleanery.operators.telemetry import derive_telemetry
from gleanery.plans.medallion import TELEMETRY
from gleanery.plans.usage_log import REJECTED_TELEMETRY, timed
from gleanery.sinks.tables import TableStore
from gleanery.streaming.outcomes import LATE_TELEMETRY, REPLAYED_TELEMETRY, joined_with_times, rocksdb_state, route_responses, settle_late
from gleanery.streaming.telemetry import write_files

RESPONSE = (
    "request_id string, executed_at timestamp, execution_time_ms double, query string, "
    "retrieved_docs array<struct<id:string,content:string,category:string,score:double>>, analysis_output string, error string"
)
START = datetime(2024, 1, 1, 12)


def at(minutes):
    return START + timedelta(minutes=minutes)


def response(name, executed, arrived):
    docs = [("d", "content", "general", 0.5)]
    return (name, executed, 2.5, "a question", docs, "an answer", None, arrived)


@pytest.fixture
def routed(spark, tmp_path):
    """Runs the stream over what was dropped so far and tells what the four tables hold."""
    store, folder = TableStore(spark, str(tmp_path / "tables")), str(tmp_path / "in")

    def run(*rows):
        spark.createDataFrame(rows, f"{RESPONSE}, arrived timestamp").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(f"{RESPONSE}, arrived timestamp").parquet(folder)
        route_responses(stream, store, str(tmp_path / "cp"), arrived=F.col("arrived")).awaitTermination()
        return [ids(store.read(t)) for t in (TELEMETRY, LATE_TELEMETRY, REPLAYED_TELEMETRY, REJECTED_TELEMETRY)]

    run.store, run.base = store, tmp_path
    return run


def ids(df):
    return [] if df is None else sorted(r["request_id"] for r in df.collect())


def test_outcomes_of_disordered_batches_add_up_to_the_input(routed):
    first = [response("a", at(0), at(1)), response("b", at(-5), at(2)), response("a", at(0), at(2)), response("none", None, at(1)), response("ahead", at(100), at(3))]
    assert routed(*first) == [["a", "b"], [], ["a"], ["ahead", "none"]]
    second = [response("b", at(-5), at(10)), response("old", at(-90), at(10)), response("c", at(-40), at(11)), response(None, at(5), at(11)), response(None, at(5), at(11))]
    accepted, late, replays, rejected = routed(*second)
    key = next(x for x in accepted if len(x) == 32)
    assert accepted == sorted(["a", "b", "c", key]) and late == ["old"] and replays == sorted(["a", "b", key]) and rejected == ["ahead", "none"]
    # Long after: the timers have cleared "a" and "b", whose copies are late by now.
    routed(response("d", at(300), at(300)))
    accepted, late, replays, rejected = routed(response("a", at(0), at(301)), response("d", at(300), at(302)), response("e", at(250), at(303)))
    assert accepted == sorted(["a", "b", "c", "d", "e", key]) and late == ["a", "old"] and replays == sorted(["a", "b", "d", key])
    assert sum(map(len, (accepted, late, replays, rejected))) == len(first) + len(second) + 4
    assert settle_late(routed.store, "late-1") == 1 and settle_late(routed.store, "late-2") == 0
    assert ids(routed.store.read(TELEMETRY)) == sorted([*accepted, "old"])


def test_timers_bound_the_state(spark, routed):
    routed(*[response(f"r{n}", at(0), at(1)) for n in range(50)])
    routed(response("late enough", at(500), at(500)))
    routed(response("last", at(501), at(501)))
    with rocksdb_state(spark):
        held = spark.read.format("statestore").option("stateVarName", "until").load(str(routed.base / "cp"))
        assert sorted(r["key"]["request_id"] for r in held.collect()) == ["last", "late enough"]


def test_a_replayed_batch_changes_nothing(routed):
    routed(response("a", at(0), at(1)), response("a", at(0), at(1)))
    commits = routed.base / "cp" / "commits"
    last = max(commits.glob("[0-9]*"), key=lambda f: int(f.name))
    for file in (last, last.with_name(f".{last.name}.crc")):
        file.unlink(missing_ok=True)
    assert routed(response("a", at(0), at(2)), response("b", at(0), at(2))) == [["a", "b"], [], ["a", "a"], []]


def test_a_crowded_request_has_one_record(routed):
    accepted, late, replays, rejected = routed(*[response("hot", at(n % 7), at(7 + n % 3)) for n in range(30_000)])
    assert accepted == ["hot"] and len(replays) == 29_999 and not late and not rejected
    assert routed.store.read(TELEMETRY).first()["execution_timestamp"] == at(0)


def test_a_batch_over_many_days_remembers_its_end(spark, routed):
    """Requests that are over when their micro-batch ends are never written to the state; copies among them are replays all the same."""
    days = [response(f"r{n:02}", at(1440 * n), at(1440 * n + 1)) for n in range(40)]
    accepted, late, replays, rejected = routed(*days, *days[:5], response("late", at(0), at(1440)))
    assert accepted == [f"r{n:02}" for n in range(40)] and replays == [f"r{n:02}" for n in range(5)] and late == ["late"] and not rejected
    with rocksdb_state(spark):
        held = spark.read.format("statestore").option("stateVarName", "until").option("batchId", 0).load(str(routed.base / "cp")).collect()
    assert "r39" in {r["key"]["request_id"] for r in held} and len(held) <= 4  # the newest day of each partition


def test_a_record_passes_the_state_whole(spark, routed):
    """Microseconds, doubles that no text holds by itself, long and odd strings, and what is null."""
    odd = 'a "b"\\\n\u2028\U0001f600\x00'
    docs = [("d", "content", "general", float("nan")), ("e", "content", "general", 1.0)]
    first = START.replace(microsecond=123_457)
    rows = [(odd, first, float("-inf"), odd * 1000, docs, "one two", odd, at(1)), ("n", first, None, None, None, None, None, at(1)), ("z", first, -0.0, "", [("d", "", "", 0.1 + 0.2)], "", "", at(1))]
    routed(*rows, ("l", at(-90), 5e-324, odd, docs, None, None, at(1)))
    given = spark.createDataFrame(rows, f"{RESPONSE}, arrived timestamp").drop("arrived")
    expected = derive_telemetry(given)
    found = routed.store.read(TELEMETRY).select(expected.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    (late,) = routed.store.read(LATE_TELEMETRY).collect()
    assert late["execution_time_ms"] == 5e-324 and late["user_query"] == odd and late["arrived_at"] == at(1)


TIMING = "request_id string, executed_at timestamp, execution_time_ms double"


def test_streams_of_responses_and_times_equal_the_batch_join(spark, tmp_path):
    """Times come before, with and after their response, twice, or never; a closing pair lets the watermarks pass."""
    answered = {n: at(3 * n) for n in range(12)}
    responses = [(f"r{n}", None, None, "a question", [("d", "content", "general", 0.5)], "an answer", None, t) for n, t in answered.items()]
    times = [(f"r{n}", t - timedelta(seconds=20), 20_000.0) for n, t in answered.items() if n % 4]
    closing = ("closing", None, None, "", None, "", None, at(10_000))
    paths = [str(tmp_path / side) for side in ("responses", "times")]

    def run(some_responses, some_times):
        for path, rows, schema in zip(paths, (some_responses, some_times), (f"{RESPONSE}, answered_at timestamp", TIMING), strict=True):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        sides = [spark.readStream.schema(s).parquet(p) for s, p in zip((f"{RESPONSE}, answered_at timestamp", TIMING), paths, strict=True)]
        write_files(joined_with_times(*sides), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    run(responses[:6], times[4:])
    run(responses[6:], [*times[:4], times[1], times[5]])
    run([closing], [("closing too", at(10_000), 0.0)])
    found = spark.read.parquet(str(tmp_path / "out")).where("request_id NOT LIKE 'closing%'")
    batch = spark.createDataFrame(responses, f"{RESPONSE}, answered_at timestamp").drop("executed_at", "execution_time_ms")
    expected = derive_telemetry(timed(batch, spark.createDataFrame(times, TIMING)))
    assert sorted(map(str, found.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert found.where("execution_timestamp IS NULL").count() == 3
