"""Plans and results that must hold on large or skewed tables."""

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from gleaner.functions import joins
from gleaner.operators import evaluate, groups, summary, weights
from gleaner.plans import tables as t
from gleaner.plans.queries import QUERIES
from gleaner.sources.staging import stage

LAZY = ["important_words", "word_count", "bigram_count", "slot_range", "slot_date_consensus", "doc_summary", "chi2_features"]


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_only_needed_columns_are_read(spark, sf):
    assert "ReadSchema: struct<text:string>" in plan(QUERIES["word_count"](spark, sf))


def test_counts_shuffle_once(spark):
    lists = spark.createDataFrame([(0, ["a"])], "doc_id bigint, lemmas array<string>")
    for df in (weights.word_count(lists), weights.bigram_count(lists), weights.term_stats(lists)):
        assert plan(df).count("Exchange hashpartitioning") <= 1 and plan(df).count("\nArguments: hashpartitioning") == 1


def test_top_k_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_words"](spark, sf))


def test_totals_share_the_exchange(spark, sf):
    df = weights.tf_idf(stage(t.lists(spark, sf)))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_join_equals_broadcast(spark, how):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    table = spark.range(0, 3000, 2).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")).union(
        spark.createDataFrame([("hot", 7)], "k string, v int"))
    small = joins.lookup_join(left, table, "k", how)
    large = joins.lookup_join(left, table, "k", how, limit=10)
    assert rows_of(small.columns, small.collect()) == rows_of(small.columns, large.select(small.columns).collect())


@pytest.mark.parametrize("name", ["important_words", "feature_presence", "slot_report", "doc_summary", "rouge_1",
                                  "rebuild_records", "corpus_summary"])
def test_results_do_not_depend_on_partitions(spark, sf, name):
    results = []
    for parts in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = QUERIES[name](spark, sf)
        results.append(rows_of(df.columns, df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2] and results[0]


@pytest.mark.parametrize("name", ["kmeans_clusters", "bisecting_clusters", "lda_clusters", "cluster_exemplars_kmeans",
                                  "cluster_exemplars_lda", "hashed_tfidf", "lda_topic_sweep", "mlp_predict", "rouge_l"])
def test_rows_only_queries(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    assert rows
    if name == "rouge_l":
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "mlp_predict":
        assert len(rows) == t.documents(spark, sf).count() and {r.label for r in rows} <= {0.0, 1.0}
    if name == "lda_topic_sweep":
        assert len(rows) == 2 * sum((10, 9, 8, 7, 6))


def test_thesaurus_groups_stay_small(spark, sf):
    lists = t.staged_lists(spark, sf)
    sizes = t.thesaurus(lists).groupBy("word").count()
    assert sizes.agg(F.max("count")).first()[0] <= 5
    assert groups.related_words(weights.word_count(lists), t.thesaurus(lists)).count() > 0


def test_best_pair_never_joins_a_gram_of_every_sentence(spark, monkeypatch):
    """A copy of a golden sentence is found by its rarest word; the word that all sentences hold is then ruled out."""
    predicted = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("storm coast w"), F.col("id").cast("string")).alias("text"))
    golden = spark.createDataFrame([(0, "storm rain w7"), (1, "storm coast w9"), (2, "storm coast x1"), (3, "w5 storm coast")], "item_id long, text string")
    written, write = {}, evaluate.stage

    def counted(df, name="stage"):
        out = write(df, name)
        written.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(evaluate, "stage", counted)
    rows = evaluate.rouge_best_pairs(predicted, golden, ["doc_id"], ["item_id"]).collect()
    assert sorted((r.kind, r.score, r.predicted_doc_id, r.golden_item_id) for r in rows) == [("1", 1.0, 5, 3), ("2", 1.0, 9, 1)]
    assert len(written["tokens"]) == 2 and max(written["pairs"]) <= 4 and sum(written["pairs"]) <= 8


def test_best_pair_where_every_gram_is_common(spark):
    predicted = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("storm coast storm").alias("text"))
    golden = spark.createDataFrame([(4, "storm storm storm rain"), (5, "coast")], "item_id long, text string")
    row = evaluate.rouge_best_pair(predicted, golden, ["doc_id"], ["item_id"]).first()
    assert (row.score, row.predicted_doc_id, row.golden_item_id, row.predicted_text) == (1.0, 0, 5, "storm coast storm")


def test_summaries_stay_in_the_row(spark, sf):
    text = plan(QUERIES["doc_summary"](spark, sf))
    assert "Exchange" not in text and "Window" not in text and text.count("Scan parquet") <= 2


def test_summary_of_a_very_long_text(spark):
    """Work grows with the text, not with its square: words are counted by sorting."""
    long_text = F.expr("array_join(transform(sequence(1, 60000), i -> concat('word', cast(i % 977 as string), if(i % 9 = 0, '. ', ' '))), '')")
    rows = spark.range(1).select(F.col("id").alias("doc_id"), long_text.alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(1, None), (2, ""), (3, "the of and."), (4, "Coast. Coast storm. Rain")], "doc_id long, text string"))
    found = {r.doc_id: r.summary for r in summary.doc_summary(rows, "storm").collect()}
    assert set(found) == {0, 4} and found[4] == "Coast. Coast storm. Rain" and found[0].count(".") == 5


def test_scratch_deletes_its_tables(spark):
    import os
    from gleaner.sources.staging import FREE_SHUFFLES, scratch, stage
    before = spark.conf.get(FREE_SHUFFLES, None)
    with scratch(spark) as keep:
        small = keep(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "small")
        path = small.inputFiles()[0].removeprefix("file:").lstrip("/")
        assert os.path.exists("/" + path)
        kept = stage(small.filter("k < 3").groupBy().count(), "kept")
    assert not os.path.exists("/" + path) and kept.first()[0] == 3
    assert spark.conf.get(FREE_SHUFFLES, None) == before
    with pytest.raises(ZeroDivisionError), scratch(spark):
        1 / 0
    assert spark.conf.get(FREE_SHUFFLES, None) == before
