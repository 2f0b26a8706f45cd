"""Words numbered on Spark, sparse vectors from rows, and topics without a vocabulary on the driver."""

import pytest
from pyspark.sql import functions as F

from gleaner.functions.numbering import numbered
from gleaner.operators import cluster


def values(df, key="doc_id"):
    return {r[key]: (r.features.size, dict(zip(r.features.indices.tolist(), r.features.values.tolist()))) for r in df.collect()}


def test_numbers_have_no_gap_in_any_partitioning(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 4001).alias("v"), "id", F.lit("clash").alias("size"))
    for parts in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = numbered(rows.repartition(9), F.desc("v"), "id").collect()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        order = sorted(got, key=lambda r: (-r.v, r.id))
        assert [r.number for r in order] == list(range(5000)) and got[0].size == "clash"
    assert numbered(rows.limit(0), "v").collect() == []


def test_sparse_vectors(spark):
    lists = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["a", "c"]), (4, ["a"])], "doc_id bigint, lemmas array<string>")
    terms = cluster.doc_terms(lists)
    numbers = cluster.term_numbers(terms)
    assert sorted((r.number, r.lemma, r.n, r.df) for r in numbers.collect()) == [(0, "a", 3, 2), (1, "b", 2, 1), (2, "c", 1, 1)]
    assert values(cluster.sparse_vectors(terms, numbers)) == {
        1: (3, {0: 1.0, 1: 2.0}), 2: (3, {}), 3: (3, {}), 4: (3, {0: 2.0, 2: 1.0})}
    some = cluster.term_numbers(terms, limit=2, min_share=0.5)
    assert [(r.number, r.lemma) for r in some.collect()] == [(0, "a")]
    assert values(cluster.sparse_vectors(terms, some)) == {1: (1, {0: 1.0}), 2: (1, {}), 3: (1, {}), 4: (1, {0: 2.0})}


def test_topics_of_more_words_than_the_driver_sees(spark, monkeypatch):
    """Every record has words of its own: 240,000 in all; nothing longer than the topics' own words is collected."""
    own = F.transform(F.sequence(F.lit(1), F.lit(600)), lambda i: F.concat(F.col("id").cast("string"), F.lit("w"), i.cast("string")))
    common = F.when(F.col("id") % 2 == 0, F.array(*[F.lit(w) for w in ["storm", "coast"] * 40])).otherwise(
        F.array(*[F.lit(w) for w in ["dog", "cat"] * 40]))
    lists = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(own, common).alias("lemmas"))
    kind = type(lists)
    sizes, collect = [], kind.collect

    def counted(self):
        rows = collect(self)
        sizes.append(len(rows))
        return rows
    monkeypatch.setattr(kind, "collect", counted)
    swept = cluster.topic_sweep(lists, ks=(2,), num_words=2, passes=3).collect()
    assert {r.term for r in swept} <= {"storm", "coast", "dog", "cat"} and len(swept) == 4
    assert max(sizes) == 4
    terms = cluster.doc_terms(lists)
    assert cluster.term_numbers(terms).agg(F.max("number"), F.countDistinct("number")).first() == (240_003, 240_004)


def test_a_word_in_every_record_is_split(spark):
    """The join of words and numbers has two written sides and no broadcast hint, so a hot word's partition can be split."""
    lists = spark.range(200).select(F.col("id").alias("doc_id"), F.array(F.lit("hot"), F.col("id").cast("string")).alias("lemmas"))
    terms = cluster.doc_terms(lists)
    found = values(cluster.sparse_vectors(terms, cluster.term_numbers(terms)))
    assert all(v[0] == 201 and v[1][0] == 1.0 and len(v[1]) == 2 for v in found.values()) and len(found) == 200


def test_topic_weights_are_shares(spark):
    lists = spark.createDataFrame([(i, ["storm", "rain"] if i % 2 else ["dog", "cow"]) for i in range(20)], "doc_id bigint, lemmas array<string>")
    rows = cluster.topic_sweep(lists, ks=(2,), num_words=4, passes=5).collect()
    for topic in (0, 1):
        mine = [r for r in rows if r.topic == topic]
        assert sum(r.weight for r in mine) == pytest.approx(1.0, abs=1e-6)
        assert [r["rank"] for r in sorted(mine, key=lambda r: -r.weight)] == [0, 1, 2, 3]
