"""Work that is done once: no expression of a text is computed again by a filter, and no table by a second reader."""

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from gleaner.functions import sampling, text as tx
from gleaner.operators import evaluate, features, mentions, slots, summary, text, weights
from gleaner.plans import tables as t
from gleaner.sources.staging import stage


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def rows(df):
    return rows_of(df.columns, df.collect())


def staged_names(monkeypatch, module):
    names = []
    monkeypatch.setattr(module, "stage", lambda df, name="stage": names.append(name) or stage(df, name))
    return names


def test_bootstrap_deals_its_draws_out(spark):
    scores = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") / 40).alias("score"))
    df = evaluate.rouge_bootstrap(scores.coalesce(1), 100)
    assert "RoundRobinPartitioning" in plan(df) and df.first().low < df.first().mean < df.first().high


def test_poisson_counts_thresholds(spark):
    cuts = sampling.POISSON_THRESHOLDS
    given = ["00000000", *cuts, *[f"{int(c, 16) - 1:08x}" for c in cuts], "ffffffff", None]
    found = spark.createDataFrame([(g,) for g in given], "d string").select("d", sampling.poisson(F.col("d")).alias("w")).collect()
    assert {r.d: r.w for r in found} == {g: sum(g >= c for c in cuts) if g else 0 for g in given}


def test_summaries_are_made_once(spark, sf, monkeypatch):
    names = staged_names(monkeypatch, summary)
    summary._ranked(summary.doc_summary(t.records(spark, sf).limit(20)).select("doc_id", F.col("summary").alias("text")), "doc_id")
    assert names[0] == "summaries"


def test_sentences_as_by_the_patterns(spark):
    given = ["Mr. Dr. St. John met U.S.A. envoys. Then a.b.c!d?e! Gen. X", "", "..a. Mr.", "Smr. x St. \U0001d400. A.\U0001d400. b", "x\nMt. y.é",
             "\U0001d400Mr. x", "\U0001f600Mr. x"]
    df = spark.createDataFrame([(g,) for g in given], "text string")
    column = F.col("text")
    for pattern, aside in tx.kept_marks():
        column = F.regexp_replace(column, pattern, f"$1{aside}$2")
    old = F.transform(tx.find_all(column, tx.SENTENCE), lambda s: F.trim(F.translate(s, tx.ASIDE, tx.MARKS)))
    assert [r[0] == r[1] for r in df.select(old, tx.split_sentences(F.col("text"))).collect()] == [True] * len(given)
    assert all("(?<=" in pattern for pattern, _ in tx._aside(tx.ABBREVIATIONS)[4:])


@pytest.mark.parametrize("count", [weights.bigram_count, weights.cooccurrence, weights.term_stats])
def test_lists_are_made_once(spark, sf, count):
    assert "(size(" not in plan(count(t.lists(spark, sf))).split("Condition", 1)[-1].split("\n")[0]
    assert "Filter (size(" not in count(t.lists(spark, sf))._jdf.queryExecution().optimizedPlan().toString().replace("Filter ((", "Filter (")


def test_term_stats_of_nulls_and_copies(spark):
    lists = spark.createDataFrame([(0, ["a", "a", None]), (1, ["a", "b", ""]), (2, []), (3, None)], "doc_id int, lemmas array<string>")
    found = {r.lemma: (r.n, r.df, r.records) for r in weights.term_stats(lists).collect()}
    assert found == {"": (1, 1, 3), "a": (3, 2, 0), "b": (1, 1, 0), None: (1, 0, 0)}


@pytest.mark.parametrize("pilot, listed", [(200, 2000), (3, 2000), (3, 1)])
def test_frequent_bigrams_are_the_top_ones(spark, monkeypatch, pilot, listed):
    monkeypatch.setattr(weights, "PILOT_WORDS", pilot)
    monkeypatch.setattr(weights, "LISTED_WORDS", listed)
    rows = [("a b a b c c d".split(),), ("d e d e d".split(),), ("it's b it's b".split(),), ([],), (["x"],), (["a", None, "b"],)]
    lists = spark.createDataFrame(rows, "lemmas array<string>")
    for k in (1, 3, 5):
        for some in (lists, lists.filter("NOT exists(lemmas, x -> x IS NULL)")):
            assert weights.frequent_bigrams(some, weights.term_stats(some), k).collect() == weights.top_bigrams(some, k).collect()


def test_feature_labels_count_the_words_once(spark, sf, monkeypatch):
    lists = stage(t.lists(spark, sf))
    plain = rows(features.feature_labels(lists, t.thesaurus(lists)))
    monkeypatch.setattr(weights, "word_count", None)
    monkeypatch.setattr(weights, "PILOT_WORDS", 5)
    assert rows(t.feature_labels(lists)) == plain


def test_places_inside_the_row_as_by_the_join(spark, monkeypatch):
    texts = spark.createDataFrame([("e", "Landfall in New York, York and St. Louis."), ("e", "landfall in New York City"), (None, "York"),
                                   ("f", None), ("f", "evacuation of O'Hara \\ 'x'"), ("f", "evacuation of O'Hara \\ 'x'")], "event_key string, text string")
    places = spark.createDataFrame([("GPE", "New York"), ("GPE", "York"), ("GPE", "New York City"), ("GPE", "St. Louis"), ("LOC", "York"),
                                    ("GPE", "O'Hara"), ("GPE", "\\"), (None, "City")], "type string, text string")

    def every():
        return [rows(mentions.place_mentions(texts, places, ("event_key",))), rows(mentions.mentions(texts, {"N": "[A-Z]+"}, places, ("event_key",))),
                rows(mentions.sentences_with_place(texts, places, "GPE", ["event_key", "text"])), rows(slots.facts(texts, places))]
    inside = every()
    assert "Join" not in plan(slots.facts(texts, places))
    monkeypatch.setattr(mentions, "LISTED_PLACES", 0)
    assert inside == every() and inside[2]


def test_names_are_written_once(spark, monkeypatch):
    names = staged_names(monkeypatch, slots)
    texts = spark.createDataFrame([("e", "Hurricane Ann on May 3, 2018."), ("e", "Before, on May 1, 2018.")], "event_key string, text string")
    first = slots.first_dates(texts, slots.modes(slots.facts(texts, None, ("name",)), ("name",)))
    assert str(first.first().first_date) == "2018-05-03" and names == ["names"]


def test_sentences_and_grams_are_made_once(spark, sf):
    for df in (text.sentences(t.records(spark, sf)), evaluate.rouge(t.records(spark, sf), t.golden(spark, sf), "su4")):
        predicted = df._jdf.queryExecution().optimizedPlan().toString().split("benchmark")[0]
        assert "Filter (size(" not in predicted and "AND (size(" not in predicted
