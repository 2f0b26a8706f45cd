"""Joins on a key that half of the rows share are split, and columns of the user's survive."""

import contextlib

import pytest
from pyspark.sql import functions as F

from gleaner.llm import components, ngram_join, shards

SMALL = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@contextlib.contextmanager
def small_partitions(spark):
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in SMALL:
            spark.conf.unset(name)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("larger", [True, False])
def test_the_centre_of_a_star_is_split(spark, larger):
    pairs = spark.range(1, 60_000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    others = spark.range(100_000, 160_000, 2).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = pairs.union(others)
    # The centre has the smallest id, or the largest one.
    edges = edges if larger else edges.select(F.col("a").alias("a"), F.when(F.col("a") == 0, 200_000).otherwise(F.col("b")).alias("b"),
                                              F.col("b").alias("other")).select(F.when(F.col("a") == 0, F.col("other"))
                                                                                .otherwise(F.col("a")).alias("a"), "b")
    with small_partitions(spark):
        moved = components._stars(edges.repartition(8), larger)
        assert "skew=true" in final_plan(moved)


def test_components_of_large_stars(spark):
    star = spark.range(1, 20_000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    chain = spark.range(30_000, 30_050).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    high = spark.range(40_000, 45_000).select(F.col("id").alias("a"), F.lit(50_000).cast("long").alias("b"))
    found = components.components(star.union(chain).union(high)).groupBy("root").count().collect()
    assert {tuple(r) for r in found} == {(0, 20_000), (30_000, 51), (40_000, 5_001)}


def test_a_set_of_half_of_all_documents_is_split(spark):
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.range(12_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit(text)).otherwise(F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), "id") for i in range(8)])).alias("text"))
    with small_partitions(spark):
        found = ngram_join.classes(docs)
        assert "skew=true" in final_plan(found)
    counts = found.groupBy((F.col("doc_id") % 2 == 0).alias("copy")).agg(
        F.countDistinct("class_id").alias("classes"), F.min("n_links").alias("least"), F.max("n_links").alias("most")).collect()
    assert {tuple(r) for r in counts} == {(True, 1, 5_999, 5_999), (False, 6_000, 0, 0)}


def test_shards_keep_the_columns_of_the_user(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * i, f"own{i}", i * 10) for i in range(50)], "doc_id long, text string, shard string, Slot long")
    placed = shards.place(docs, 5)
    assert shards.names(docs) == ("shard_", "slot_")
    assert placed.columns == ["doc_id", "text", "shard", "Slot", "shard_", "slot_"]
    assert sorted(map(tuple, placed.select(docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    digests = shards.shard(docs, 5)
    assert digests.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    for s in range(5):
        slots = sorted(r.slot for r in digests.filter(F.col("shard") == s).collect())
        assert slots == list(range(len(slots)))
    shards.save(placed, str(tmp_path / "out"), *shards.names(docs))
    again = spark.read.parquet(str(tmp_path / "out"))
    assert again.count() == 50 and again.select("shard_").distinct().count() == 5
