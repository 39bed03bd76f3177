from conftest import plan_of
from pyspark.sql import functions as F

from gleanery.operators import known_ids
from gleanery.operators.known_ids import bloom_filter, clashes, possibly_known


def test_a_doubled_id_of_a_later_version_is_found(spark, tmp_path):
    spark.range(20_000).select(F.concat(F.lit("id-"), "id").alias("k")).unionByName(spark.createDataFrame([("id-7",), (None,)], "k string")).write.parquet(str(tmp_path / "published"))
    published = spark.read.parquet(str(tmp_path / "published"))
    new = spark.range(20_000, 25_000).select(F.concat(F.lit("id-"), "id").alias("k"))
    new = new.unionByName(spark.createDataFrame([("id-7",), ("id-19999",), ("id-19999",), (None,)], "k string"))
    assert sorted(map(tuple, clashes(new, published, "k").collect())) == [("id-19999", 2, 1), ("id-7", 1, 2)]
    suspects = possibly_known(new, "k", bloom_filter(published, "k"))
    assert 3 <= suspects.count() < 200
    assert clashes(new.where("k IS NULL"), published, "k").count() == 0 and clashes(new, published.limit(0), "k").count() == 0


def test_published_ids_are_not_shuffled(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "published"))
    plan = plan_of(clashes(spark.range(990, 1100), spark.read.parquet(str(tmp_path / "published")), "id"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_full_filter_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(known_ids, "MOST_BITS", known_ids.BLOCK)
    assert [r["id"] for r in clashes(spark.range(39_995, 60_000), spark.range(40_000), "id").orderBy("id").collect()] == list(range(39_995, 40_000))
