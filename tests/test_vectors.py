"""Vectors from rows: the rows that travel, and words that are not looked up by broadcast."""

from pyspark.sql import functions as F

from gleaner.operators import cluster, features, weights
from gleaner.plans import queries, tables


def values(df):
    return {r.doc_id: dict(zip(r.features.indices.tolist(), r.features.values.tolist())) for r in df.collect()}


def test_rare_and_long_words_keep_their_numbers(spark, monkeypatch):
    long = "x" * 100
    lists = spark.createDataFrame([(1, ["a", "b", "a", long]), (2, ["a", "c"]), (2, ["c", None, "a"]), (3, []), (None, ["b", long])],
                                  "doc_id bigint, lemmas array<string>")
    terms = cluster.doc_terms(lists)
    numbers = cluster.term_numbers(terms)
    at = {r.lemma: r.number for r in numbers.collect()}
    wanted = {1: {at["a"]: 2.0, at["b"]: 1.0, at[long]: 1.0}, 2: {at["a"]: 2.0, at["c"]: 2.0}, 3: {}, None: {at["b"]: 1.0, at[long]: 1.0}}
    for head in (cluster.HEAD, 2, 0):
        monkeypatch.setattr(cluster, "HEAD", head)
        found = values(cluster.sparse_vectors(terms, numbers))
        assert found == wanted and all(list(v) == sorted(v) for v in found.values())


def test_only_rare_words_are_joined_by_shuffle(spark, monkeypatch):
    """Without Spark's own broadcast, as for large tables: the rows of frequent words are not dealt out by word."""
    lists = spark.range(300).select(F.col("id").alias("doc_id"), F.array(F.lit("hot"), F.concat(F.lit("w"), F.col("id"))).alias("lemmas"))
    terms = cluster.doc_terms(lists)
    numbers = cluster.term_numbers(terms)
    joined, join = [], type(terms).join

    def counted(self, other, *args, **kwargs):
        if "lemma" in self.columns and "broadcast" not in other._jdf.queryExecution().logical().toString().lower():
            joined.append(self.count())
        return join(self, other, *args, **kwargs)
    monkeypatch.setattr(cluster, "HEAD", 1)
    monkeypatch.setattr(type(terms), "join", counted)
    cluster.sparse_vectors(terms, numbers)
    assert joined == [300]


def test_topics_of_records_are_found_once(spark, sf, monkeypatch):
    written, write = [], queries.stage
    monkeypatch.setattr(queries, "stage", lambda df, name="stage": written.append(name) or write(df, name))
    assert queries.cluster_exemplars_lda(spark, sf).count() > 0 and written == ["clustered"]


def test_bigrams_of_the_first_count_are_not_counted_again(spark, monkeypatch):
    lists = spark.createDataFrame([(i, ["a", "b", "a", "b", f"w{i}"]) for i in range(30)], "doc_id bigint, lemmas array<string>")
    stats = weights.stage(weights.term_stats(lists), "stats")
    exploded, explode = [], weights._exploded
    monkeypatch.setattr(weights, "_exploded", lambda *a: exploded.append(1) or explode(*a))
    found = weights.frequent_bigrams(lists, stats, 2).collect()
    assert [tuple(r) for r in found] == [("a b", 60), ("b a", 30)] and len(exploded) == 1


def test_only_words_with_a_listed_stem_are_grouped(spark):
    counts = spark.createDataFrame([("storm", 3), ("storming", 2), ("rain", 4), ("raining", 1)], "lemma string, n long")
    found = tables.thesaurus(None, counts, counts.filter("lemma = 'rain'"))
    assert sorted(map(tuple, found.collect())) == [("rain", "raining"), ("raining", "rain")]
    assert tables.thesaurus(None, counts).count() == 4


def test_terms_with_spaces_count_as_before(spark):
    lists = spark.createDataFrame([(1, ["a", "b c", "a b", "c", None, "a"])], "doc_id long, lemmas array<string>")
    labels = spark.createDataFrame([(0, "bigram", "a b c"), (1, "word", "a"), (2, "bigram", "a b"), (3, "word", "z")], "feature_id int, kind string, term string")
    assert features.feature_sets(lists, labels).first().count_feature_set == [2.0, 2.0, 1.0, 0.0]
