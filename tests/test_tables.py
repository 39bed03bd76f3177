import pytest
from pyspark.sql import functions as F

from gleanery.operators.quality import QualityError, Suite, not_null
from gleanery.session import shared_base, work_dir
from gleanery.sinks.tables import ConcurrentWrite, TableStore, changed_rows, latest_per_key, merged_schema, range_sorted, upsert


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def rows(spark, *pairs, columns="k bigint, v string"):
    return spark.createDataFrame(list(pairs), columns)


def held(store, table="t"):
    return sorted(tuple(r) for r in store.read(table).collect())


def test_append_and_read(spark, store):
    assert store.read("t") is None
    assert store.append(rows(spark, (1, "a"), (2, "b")), "t") == 2
    assert store.append(rows(spark, (3, "c")), "t") == 1
    assert held(store) == [(1, "a"), (2, "b"), (3, "c")]
    assert store.read("other") is None


def test_new_columns_are_null_in_older_rows(spark, store):
    store.append(rows(spark, (1, "a")), "t")
    store.append(rows(spark, (2, "b", 0.5), columns="k bigint, v string, w double"), "t")
    assert held(store) == [(1, "a", None), (2, "b", 0.5)]


def test_a_column_keeps_its_type(spark):
    with pytest.raises(ValueError, match="column v changed"):
        merged_schema([rows(spark, (1, "a")).schema, rows(spark, (1, 2), columns="k bigint, v bigint").schema])


def test_failed_audit_is_never_visible(spark, store):
    suite = Suite("s", [not_null("v")])
    store.append(rows(spark, (1, "a")), "t", "good", suite)
    with pytest.raises(QualityError):
        store.append(rows(spark, (2, None)), "t", "bad", suite)
    assert held(store) == [(1, "a")]
    assert [tuple(r) for r in store.staged("t", "bad").collect()] == [(2, None)]
    store.append(rows(spark, (2, "b")), "t", "bad", suite)
    assert held(store) == [(1, "a"), (2, "b")]


def test_a_version_is_published_once(spark, store):
    assert store.append(rows(spark, (1, "a")), "t", "batch-0") == 1
    assert store.append(rows(spark, (1, "a")), "t", "batch-0") == 0
    store.append(rows(spark, (2, "b")), "t", "batch-1")
    assert store.compact("t", "k") == 2
    assert store.append(rows(spark, (1, "a")), "t", "batch-0") == 0
    assert held(store) == [(1, "a"), (2, "b")]


def test_empty_versions(spark, store):
    assert store.append(rows(spark, (1, "a")).limit(0), "t") == 0 and store.read("t") is None
    store.append(rows(spark, (1, "a")), "t")
    assert store.replace(rows(spark, (1, "a")).limit(0), "t") == 0 and held(store) == []


def test_replace(spark, store):
    store.append(rows(spark, (1, "a")), "t")
    store.replace(store.read("t").withColumn("v", F.upper("v")), "t")
    assert held(store) == [(1, "A")]


def test_replacement_loses_no_other_write(spark, store):
    store.append(rows(spark, (1, "a")), "t")
    base = store.versions("t")
    store.append(rows(spark, (2, "b")), "t")
    with pytest.raises(ConcurrentWrite):
        store.replace(rows(spark, (9, "z")), "t", base=base)
    assert held(store) == [(1, "a"), (2, "b")]
    schema = rows(spark, (1, "a")).schema
    for version in ("x", "y"):
        store.stage(rows(spark, (3, version)), "t", version)
    base = store.versions("t")
    store.publish("t", "x", 1, schema, base)
    with pytest.raises(ConcurrentWrite):
        store.publish("t", "y", 1, schema, base)
    assert held(store) == [(3, "x")]


def test_versions_of_different_layouts(spark, store):
    for day in (1, 2, 3):
        store.append(rows(spark, (day, "a"), (day, "b")), "t", partition_by=["v"])
    store.append(rows(spark, (4, "c")), "t")
    store.append(rows(spark, (5, "d")), "t")
    everything = [(k, v) for k in (1, 2, 3) for v in "ab"] + [(4, "c"), (5, "d")]
    assert held(store) == everything
    assert store.compact("t", "k") == 5 and len(store.versions("t")) == 2
    assert held(store) == everything


def test_compaction_merges_small_versions_only(spark, store):
    for n in range(4):
        store.append(spark.range(n * 100, n * 100 + 100).repartition(5), "t")
    before = held(store)
    assert store.compact("t", "id", target_bytes=1) == 0
    assert store.compact("t", "id") == 4 and store.compact("t", "id") == 0
    assert held(store) == before
    assert store.read("t").rdd.getNumPartitions() == 1
    assert [r["id"] for r in store.read("t").collect()] == list(range(400))


def test_range_sort_gives_disjoint_files(spark):
    parts = range_sorted(spark.range(1000).repartition(7), "id", 4).rdd.glom().collect()
    spans = sorted((min(p)[0], max(p)[0]) for p in parts if p)
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


COLUMNS = "doc_id string, written bigint, content string, content_hash string"


def test_upsert_last_write_wins(spark):
    current = rows(spark, ("a", 0, "old", "h0"), ("b", 0, "keep", "h1"), columns=COLUMNS)
    incoming = rows(spark, ("a", 2, "new", "h2"), ("a", 1, "stale", "h3"), ("c", 1, "add", "h4"), ("c", 1, "tie", "h5"), columns=COLUMNS)
    merged = {r["doc_id"]: r["content"] for r in upsert(current, incoming, "doc_id", "written").collect()}
    assert merged == {"a": "new", "b": "keep", "c": "tie"}


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    newest = latest_per_key(rows(spark, ("a", 1, "x", "h"), columns=COLUMNS), "doc_id", "written")
    assert newest._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_changed_rows(spark):
    source = rows(spark, ("a", "1"), ("b", "2"), ("c", "3"), columns="k string, content_hash string")
    index = rows(spark, ("a", "1"), ("b", "other"), columns="k string, content_hash string")
    assert sorted(r["k"] for r in changed_rows(source, index, "k").collect()) == ["b", "c"]


def test_work_folders_lie_below_the_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_base(spark) == configured.rstrip("/")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(shared_base(spark))
