"""Worked examples and the fixed points of each operator's meaning, on small tables."""

import datetime

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gleaner.functions import numbers as nb, text as tx, vocab
from gleaner.operators import (cluster, evaluate, features, groups, label, mentions, model, slots, summary, text, weights)
from gleaner.sources import records as src


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def lists(spark, *rows):
    return spark.createDataFrame([(i, r.split()) for i, r in enumerate(rows)], "doc_id bigint, lemmas array<string>")


def counts(df, *columns):
    return {tuple(r[c] for c in columns[:-1]) if len(columns) > 2 else r[columns[0]]: r[columns[-1]] for r in df.collect()}


def test_slot_numbers_with_separators_and_points(spark):
    sentences = spark.createDataFrame([("e", "Officials counted 1,200 deaths."), ("e", "The radius was 1,000 miles."),
                                       ("e", "Its diameter was 74.5 miles.")], ["event_key", "text"])
    found = slots.facts(sentences, slots=("deaths", "size"))
    assert {(r.slot, r.value) for r in found.collect()} == {("deaths", "1200"), ("size", "2000"), ("size", "74.5")}


def test_sentence_ends(spark):
    given = ["Winds of 74.5 miles per hour hit the U.S. coast near St. Louis today. All left!", "One? Two... three",
             "No end", "Sept. 3 came.\nNext", "", None]
    rows = spark.createDataFrame([(t,) for t in given], "text string").select(tx.split_sentences(F.col("text")).alias("s"))
    assert [r.s for r in rows.collect()] == [
        ["Winds of 74.5 miles per hour hit the U.S. coast near St. Louis today.", "All left!"],
        ["One?", "Two...", "three"], ["No end"], ["Sept. 3 came.", "Next"], [], None]


def test_forms_of_quantities_and_dates(spark):
    texts = {"a 70-mph gust": ["70-mph"], "at 80mph": ["80mph"], "about 5 in of rain": ["5 in"], "1 mile off": ["1 mile"],
             "5 injured": [], "74.5 miles per hour": ["74.5 miles per hour"], "14 September 2018": ["14 September 2018"],
             "on Sept. 3 it": ["Sept. 3"], "on May 3 2018": ["May 3 2018"], "September 14, 2018": ["September 14, 2018"],
             "Mayor 5": [], "3 Marches": []}
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = mentions.mentions(rows, mentions.EVENT_PATTERNS, keep=("text",)).groupBy("text").agg(
        F.collect_list("mention").alias("m"))
    assert {r.text: r.m for r in found.collect()} == {t: m for t, m in texts.items() if m}
    day = rows.filter("text = '14 September 2018'").select(nb.date_of("text").alias("d")).first().d
    assert day == datetime.date(2018, 9, 14)


def test_long_and_punctuated_places(spark):
    gazetteer = spark.createDataFrame([("GPE", p) for p in ("United Republic of Tanzania", "St. Louis", "Mali")],
                                      "type string, text string")
    rows = spark.createDataFrame([(1, "From the United Republic of Tanzania to St. Louis, Mali."), (2, "St, Louis"), (3, None)],
                                 "doc_id int, text string")
    found = mentions.mentions(rows, {"DATE": nb.DATE}, gazetteer)
    assert sorted((r.doc_id, r.mention) for r in found.collect()) == [
        (1, "Mali"), (1, "St. Louis"), (1, "United Republic of Tanzania")]
    assert mentions.mentions(rows, {"DATE": nb.DATE}, gazetteer.limit(0)).count() == 0
    said = rows.select(F.lit("e").alias("event_key"), F.concat(F.lit("landfall: "), "text").alias("text"))
    facts = slots.facts(said, gazetteer, slots=("landfall_place",))
    assert {r.value for r in facts.collect()} == {"Mali", "St. Louis", "United Republic of Tanzania"}


def test_tokens_split_punctuation_and_contractions(spark):
    got = [r.token for r in text.tokens(docs(spark, "It’s 1,000 well-known dogs, a@b.com!")).orderBy("pos").collect()]
    assert got == ["it", "'s", "1,000", "well-known", "dogs", ",", "a", "@", "b.com", "!"]


def test_pos_tags_of_a_record(spark):
    tagged = text.tag_tokens(text.tokens(docs(spark, "the dog sleeping.")))
    assert [(r.token, r.tag) for r in tagged.orderBy("pos").collect()] == [
        ("the", "NN"), ("dog", "NN"), ("sleeping", "VBG"), (".", ".")]


def test_lexicon_wins_over_rules(spark):
    lexicon = spark.createDataFrame([("sleeping", "JJ", "sleep")], "token string, tag string, lemma string")
    out = text.lemmatize(text.tag_tokens(text.tokens(docs(spark, "sleeping walking")), lexicon)).orderBy("pos")
    assert [(r.tag, r.lemma) for r in out.collect()] == [("JJ", "sleep"), ("VBG", "walk")]


def test_nouns_of_records(spark):
    lexicon_free = docs(spark, "The fox jumped over the dog", "The phone is missing", "My car rolled the hill")
    nouns = weights.words_by_class(text.tagged_lists(lexicon_free)).filter("tag_class = 'noun'")
    assert counts(nouns, "doc_id", "lemmas") == {0: ["fox", "dog"], 1: ["phone"], 2: ["car", "hill"]}


def test_verbs_are_lemmatized_as_verbs(spark):
    verbs = weights.words_by_class(text.tagged_lists(docs(spark, "fox jumped rolling"))).filter("tag_class = 'verb'")
    assert verbs.first().lemmas == ["jump", "roll"]


def test_stop_words_in_any_case_and_apostrophe(spark):
    tokens = text.tokens(docs(spark, "The dog isn’t he’s MY"), lowercase=False)
    kept = [r.token for r in text.drop_stop_words(tokens).orderBy("pos").collect()]
    assert kept == ["dog"]


def test_extra_stop_words_as_list_and_as_table(spark):
    tokens = text.tokens(docs(spark, "able dog"))
    table = spark.createDataFrame([("able",)], "token string")
    assert [r.token for r in text.drop_stop_words(tokens, vocab.stop_words(["able"])).collect()] == ["dog"]
    assert [r.token for r in text.drop_stop_words(tokens, table).collect()] == ["dog"]


def test_numeric_tokens(spark):
    tokens = text.tokens(docs(spark, "12 1.5 1.2.3 5th dog"))
    assert sorted(r.token for r in text.drop_numeric(tokens).collect()) == ["1.2.3", "5th", "dog"]


def test_dictionary_or_proper_noun(spark):
    tagged = text.tag_tokens(text.tokens(docs(spark, "Florence dog qzx"), lowercase=False))
    words = spark.createDataFrame([("dog",)], "token string")
    assert sorted(r.token for r in text.keep_dictionary_words(tagged, words).collect()) == ["Florence", "dog"]


def test_long_path_equals_array_path(spark):
    df = docs(spark, "The dogs were walking and jumped 12 times.", "the of and", "Rain fell on the coast")
    none = spark.createDataFrame([], "token string, tag string, lemma string")
    plain = counts(text.lemma_lists(df), "doc_id", "lemmas")
    assert plain == counts(text.lemma_lists(df, lexicon=none), "doc_id", "lemmas")
    assert plain[1] == []


def test_short_records_and_missing_text_are_dropped(spark):
    df = spark.createDataFrame([(0, "x" * 99), (1, "x" * 100), (2, None)], "doc_id bigint, text string")
    assert [r.doc_id for r in src.long_records(df).collect()] == [1]


def test_word_and_bigram_counts(spark):
    df = lists(spark, "storm coast storm", "storm coast")
    assert counts(weights.word_count(df), "lemma", "n") == {"storm": 3, "coast": 2}
    assert counts(weights.bigram_count(df), "bigram", "n") == {"storm coast": 2, "coast storm": 1}


def test_cooccurrence_window(spark):
    df = lists(spark, "a b c d", "a", "")
    assert counts(weights.cooccurrence(df, 2), "bigram", "n") == counts(weights.bigram_count(df), "bigram", "n")
    assert counts(weights.cooccurrence(df, 3), "bigram", "n") == {"a b": 1, "a c": 1, "b c": 1, "b d": 1, "c d": 1}


def test_idf_is_log10_and_strict(spark):
    df = lists(spark, *(["rare common"] + ["common"] * 9))
    got = counts(weights.idf(df), "lemma", "idf")
    assert got == {"common": 0.0}  # 'rare' is in exactly a tenth of the records
    assert counts(weights.idf(df, 0.05), "lemma", "idf")["rare"] == pytest.approx(1.0)


def test_tf_idf_counts_records_without_lemmas(spark):
    got = weights.tf_idf(lists(spark, "storm storm coast", "", ""), 0.0).filter("lemma = 'storm'").first()
    assert (got.n, got.df) == (2, 1)
    assert got.score == pytest.approx(2 / 3 * 0.47712125472, abs=1e-9)


def test_important_words_limit_with_scores(spark):
    df = lists(spark, "a a b c", "b d", "e f")
    assert weights.important_words(df, 2).count() == 2
    assert weights.important_words(df, 2).columns == ["lemma", "n", "df", "score"]
    assert weights.important_words(df, None, scores=False).count() == 6


def test_words_with_and_without_counts(spark):
    words = spark.createDataFrame([("a",), ("z",)], "lemma string")
    table = spark.createDataFrame([("a", 3), ("b", 1)], "lemma string, n bigint")
    assert counts(weights.with_counts(words, table), "lemma", "n") == {"a": 3}
    assert [r.lemma for r in weights.without_counts(words, table).collect()] == ["z"]


def test_synonym_group_sums_listed_words(spark):
    words = spark.createDataFrame([("firing", 1), ("attack", 1000), ("fire", 900), ("make", 60), ("dog", 5)],
                                  "lemma string, n bigint")
    thesaurus = spark.createDataFrame([("firing", r) for r in ("attack", "fire", "make", "unlisted")],
                                      "word string, related string")
    found = {r.word: (r.total, r.members) for r in groups.synonym_groups(words, thesaurus).collect()}
    assert found["firing"] == (1961, ["attack", "fire", "firing", "make"])
    assert found["dog"] == (5, ["dog"])


def test_merge_takes_bigrams_greedily(spark):
    bigrams = spark.createDataFrame([("a b", 9), ("b c", 8), ("c d", 7), ("e e", 6), ("a x", 5)], "bigram string, n bigint")
    words = spark.createDataFrame([(w, 10 - i) for i, w in enumerate("abcde")], "lemma string, n bigint")
    merged = groups.merge_collocations(bigrams, words).orderBy("position").collect()
    assert [(r.kind, r.item) for r in merged] == [("bigram", "a b"), ("bigram", "c d"), ("word", "e")]
    many = spark.range(1500).select(F.format_string("w%04d v%04d", "id", "id").alias("bigram"), (-F.col("id")).alias("n"))
    both = many.select(F.explode(F.split("bigram", " ")).alias("lemma"), "n")
    whole = groups.merge_collocations(many, both, num_bigrams=1500, num_words=3000).orderBy("position").collect()
    assert [r.item for r in whole] == [f"w{i:04d} v{i:04d}" for i in range(1500)]


LABELS = [(0, "bigram", "storm coast"), (1, "word", "dog"), (2, "synset", "rain"), (2, "synset", "flood")]


def labels(spark):
    return spark.createDataFrame(LABELS, "feature_id int, kind string, term string")


def test_feature_sets_count_by_kind(spark):
    df = features.feature_sets(lists(spark, "storm coast storm coast dog dog rain rain", "cat"), labels(spark))
    got = {r.doc_id: (r.count_feature_set, r.presence_feature_set) for r in df.collect()}
    assert got == {0: ([2.0, 2.0, 1.0], [1.0, 1.0, 1.0]), 1: ([0.0, 0.0, 0.0], [0.0, 0.0, 0.0])}


def test_feature_sets_of_a_large_vocabulary(spark):
    """5,000 features, terms shared by features, a null list and an empty vocabulary."""
    import random
    rng = random.Random(5)
    words = [f"w{k}" for k in range(3000)]
    kinds = [(k, "word", [words[k]]) for k in range(3000)]
    kinds += [(k, "bigram", [" ".join(rng.choices(words[:60], k=2))]) for k in range(3000, 4000)]
    kinds += [(k, "synset", rng.sample(words, 6) + ["unseen"]) for k in range(4000, 5000)]
    table = spark.createDataFrame([(k, kind, x) for k, kind, terms in kinds for x in terms], "feature_id int, kind string, term string")
    texts = [(k, [rng.choice(words[:60] if k % 2 else words) for _ in range(400)]) for k in range(6)] + [(6, []), (7, None)]
    rows = spark.createDataFrame(texts, "doc_id bigint, lemmas array<string>")
    found = {r.doc_id: (r.count_feature_set, r.presence_feature_set) for r in features.feature_sets(rows, table).collect()}
    for k, lemmas in texts[:7]:
        held = lemmas + [f"{a} {b}" for a, b in zip(lemmas, lemmas[1:])]
        want = [float(len(set(terms) & set(held)) if kind == "synset" else held.count(terms[0])) for _, kind, terms in kinds]
        assert found[k] == (want, [min(n, 1.0) for n in want])
    assert found[7] == (None, None)
    none = features.feature_sets(rows, table.limit(0)).collect()
    assert {r.doc_id: (r.count_feature_set, r.presence_feature_set) for r in none} == {k: ([], []) for k in range(7)} | {7: (None, None)}


def test_presence_clips_counts(spark):
    row = spark.createDataFrame([([0.0, 2.0, 0.0, 4.0],)], "c array<double>").select(features.presence(F.col("c")).alias("p"))
    assert row.first().p == [0.0, 1.0, 0.0, 1.0]


def test_densify_inverts_feature_counts(spark):
    df = features.feature_sets(lists(spark, "dog dog rain", "cat"), labels(spark))
    dense = features.densify(features.feature_counts(df), 3, df.select("doc_id"))
    assert counts(dense, "doc_id", "count_feature_set") == counts(df, "doc_id", "count_feature_set")


def test_vocabulary_round_trip(spark, tmp_path):
    src.write_vocabulary(labels(spark), str(tmp_path / "labels"))
    assert sorted(map(tuple, src.read_vocabulary(spark, str(tmp_path / "labels")).collect())) == sorted(LABELS)


def test_auto_label_three_ways(spark):
    df = spark.createDataFrame([(i, float(c)) for i, c in enumerate([0, 1, 2, 2, 2, 2, 2, 2, 2, 9])],
                               "doc_id bigint, feature_count double")
    got = counts(label.auto_label(df), "doc_id", "label")
    assert (got[0], got[1], got[2], got[9]) == (0.0, 0.0, -1.0, 1.0)
    both = spark.createDataFrame([(0, 0.0), (1, 0.0), (2, 1.0)], "doc_id bigint, feature_count double")
    assert counts(label.auto_label(both, 2.0, 1.0), "doc_id", "label")[2] == 1.0  # relevant wins


def test_label_rules(spark):
    df = docs(spark, "HURRICANE Florence came", "Calm day").withColumn("label", F.lit(1.0))
    assert counts(label.augment_labels(df, False, "hurricane florence"), "doc_id", "label") == {0: 1.0, 1: 0.0}
    rows = docs(spark, "a plain sentence of normal length", "see the photo Gallery here now", "short", "x" * 401)
    out = label.augment_labels(rows.withColumn("label", F.lit(1.0)), True)
    assert counts(out, "doc_id", "label") == {0: 1.0, 1: 0.0, 2: 0.0, 3: 0.0}
    assert out.filter("filtered").count() == 4


def test_split_and_undersample_balance(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, 1.0).otherwise(0.0).alias("label"))
    split = label.train_test_split(df)
    share = split.filter("part = 'train'").count() / 4000
    assert 0.66 < share < 0.74
    even = label.undersample(split)
    sizes = counts(even.filter("part = 'train'").groupBy("label").count(), "label", "count")
    assert abs(sizes[0.0] - sizes[1.0]) < 120
    assert even.count() == 4000
    assert even.filter("label = 1.0").exceptAll(split.filter("label = 1.0")).count() == 0


def test_classifier_predicts_every_unlabelled_row(spark):
    rows = [(i, [float(i % 2), float(i % 3 == 0), 1.0], [1.0, 0.0, -1.0][i % 3] if i >= 20 else float(i % 2))
            for i in range(60)]
    df = model.with_vectors(spark.createDataFrame(rows, "id bigint, presence_feature_set array<double>, label double"))
    fitted = model.train_model(df.filter("label >= 0"), 3, hidden=(4,), max_iter=20)
    predicted = model.predict_unlabeled(df, fitted)
    merged = model.merge_predictions(df, predicted)
    assert {r.prediction for r in predicted.collect()} <= {0.0, 1.0}
    assert model.relevant(merged).count() + model.irrelevant(merged).count() == df.count() == merged.count()
    assert model.accuracy(fitted.transform(df.filter("label >= 0"))).first().total == df.filter("label >= 0").count()


def test_chi2_agrees_with_the_selector(spark):
    items = [[w for j, w in enumerate("abcdef") if (i * (j + 3)) % (j + 2) == 0 or (w == "a" and i % 2)] for i in range(90)]
    df = spark.createDataFrame([(i, x, float(i % 2)) for i, x in enumerate(items)],
                               "doc_id bigint, lemmas array<string>, prediction double")
    best = [r.item for r in model.top_chi2(model.chi2_scores(df), 2).collect()]
    sets = df.withColumn("presence_feature_set", F.array(*[
        F.array_contains("lemmas", w).cast("double") for w in "abcdef"]))
    names = spark.createDataFrame([(i, "word", w) for i, w in enumerate("abcdef")], "feature_id int, kind string, term string")
    assert sorted(r.term for r in model.select_features(sets, names, 2).collect()) == sorted(best)


def test_labeled_records_fill_missing_columns(spark):
    df = spark.createDataFrame([(1, "text", 1.0)], "id bigint, Sentences_t string, label double")
    row = src.labeled_records(df).first()
    assert (row.record, row.record_id, row.URL_s, row.label) == ("text", None, None, 1.0)


def test_labeled_dataset_file(spark, tmp_path):
    saved = spark.createDataFrame([(1, "u", "t", ["a"], [2.0], [1.0], 1.0, -1.0)],
                                  "id bigint, URL_s string, Sentences_t string, preprocessed_record array<string>, "
                                  "count_feature_set array<double>, presence_feature_set array<double>, "
                                  "feature_count double, label double")
    src.write_json(saved, str(tmp_path / "set"))
    row = src.read_labeled(spark, str(tmp_path / "set")).first()
    assert (row.count_feature_set, row.record_id, row.label) == ([2.0], None, -1.0)
    assert "Sentences_t" in model.saved_columns(src.read_labeled(spark, str(tmp_path / "set"))).columns


def test_part_files_only(spark, tmp_path):
    (tmp_path / "part-0.json").write_text('{"URL_s": "u", "Sentences_t": "' + "x" * 100 + '"}\n')
    (tmp_path / "other.json").write_text('{"URL_s": "v", "Sentences_t": "' + "y" * 100 + '"}\n')
    assert [r.url for r in src.read_records(spark, str(tmp_path), parts_only=True).collect()] == ["u"]
    assert src.read_records(spark, str(tmp_path)).count() == 2


def test_units(spark):
    df = spark.createDataFrame([("74.5 mph",), ("100 kph",), ("1,000 miles per hour",), ("10 inches",), ("50 cm",),
                                ("12 within",)], "t string")
    rows = {r.t: (r.mph, r.inches) for r in df.select("t", nb.to_mph(F.col("t")).alias("mph"),
                                                      nb.to_inches(F.col("t")).alias("inches")).collect()}
    assert rows["74.5 mph"][0] == 74.5 and rows["1,000 miles per hour"][0] == 1000
    assert rows["100 kph"][0] == pytest.approx(62.137)
    assert rows["10 inches"][1] == 10 and rows["50 cm"][1] == pytest.approx(50 / 2.54)
    assert rows["12 within"] == (-1.0, -1.0)
    digits = spark.range(1).select(nb.to_mph(F.lit("74.5 mph"), "digits").alias("x")).first().x
    assert digits == pytest.approx((74 + 5) / 2)


def test_dates(spark):
    df = spark.createDataFrame([("September 14, 2018",), ("Sept 14, 2018",), ("Margaret 3, 2018",), ("May 2018",),
                                ("Feb 30, 2018",)], "t string")
    got = {r.t: (r.m, r.d) for r in df.select("t", nb.month_of("t").alias("m"), nb.date_of("t").alias("d"))
           .collect()}
    day = datetime.date(2018, 9, 14)
    assert got == {"September 14, 2018": (9, day), "Sept 14, 2018": (9, day), "Margaret 3, 2018": (None, None),
                   "May 2018": (5, None), "Feb 30, 2018": (2, None)}


EVENT = [
    "Hurricane Florence made landfall in North Carolina as a Category 4 storm on September 14, 2018.",
    "Hurricane Florence made landfall in Virginia on September 14, 2018.",
    "Hurricane Florence brought winds of 100 mph.", "The winds reached 60 miles per hour.", "A wind of 20 mph blew.",
    "There were two deaths.", "Officials counted 4 deaths.", "The radius was 50 miles.", "Its diameter was 200 miles.",
    "Tropical Storm Florence formed on August 31, 2018.",
    "An evacuation moved 1,000 people out of Virginia.", "Some rain fell, 10 inches in Virginia.",
]


def event(spark):
    gazetteer = spark.createDataFrame([("GPE", "Virginia"), ("GPE", "North Carolina")], "type string, text string")
    return spark.createDataFrame([("e", s) for s in EVENT] + [("empty", "Nothing here.")],
                                 "event_key string, text string"), gazetteer


def test_event_slots(spark):
    sentences, gazetteer = event(spark)
    facts = slots.facts(sentences, gazetteer)
    spans = {r.slot: r for r in slots.ranges(facts).collect()}
    assert (spans["wind"].low, spans["wind"].high, spans["wind"].mean) == (60, 100, 80)  # 20 mph is below the floor
    assert spans["deaths"].mean == 3
    assert (spans["size"].mean, spans["size"].sd) == (150, 50)  # the radius counts twice
    modal = {r.slot: r.value for r in slots.modes(facts).collect()}
    assert (modal["name"], modal["storm"], modal["category"], modal["headcount"]) == ("Florence", "Florence", "4", "1,000")
    places = slots.top_values(facts, {"landfall_place": 2}).orderBy("rank").collect()
    assert [r.value for r in places] == ["North Carolina", "Virginia"]
    assert slots.consensus_dates(facts).first().date_text == "September 14, 2018"
    first = slots.first_dates(sentences, slots.modes(facts, ("name",)))
    assert first.first().first_date == datetime.date(2018, 8, 31)
    made = slots.report(slots.fields(facts, first)).collect()
    assert {r.outline for r in made} >= {"overview", "landfall", "wind", "size", "formation", "rain"}
    assert "preparation" not in {r.outline for r in made}  # a third place is missing
    assert any("September 14, 2018" in r.text for r in made if r.outline == "landfall")


def test_mentions(spark):
    sentences, gazetteer = event(spark)
    found = mentions.mentions(sentences, mentions.EVENT_PATTERNS, gazetteer, ("event_key",))
    kinds = counts(found.groupBy("type").count(), "type", "count")
    assert kinds == {"QUANTITY": 6, "DATE": 3, "GPE": 4}
    assert mentions.sentences_with_type(sentences, "DATE", mentions.EVENT_PATTERNS).count() == 3
    assert mentions.sentences_with_place(sentences, gazetteer, "GPE", ["event_key", "text"]).count() == 4
    cleaned = mentions.mentions_of(found, "DATE").select("mention").distinct().collect()
    assert ("September 14  2018",) in [tuple(r) for r in cleaned]


def test_kmeans_distance_is_cost(spark):
    rows = [(i, [float(i % 3) * 10 + (i % 5) * 0.1, float(i % 3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, v array<double>").select("doc_id", array_to_vector("v").alias("features"))
    for method in ("kmeans", "bisecting"):
        out, fitted = cluster.do_cluster(df, method, 3)
        assert out.agg(F.sum("distance")).first()[0] == pytest.approx(fitted.summary.trainingCost, rel=1e-6, abs=1e-6)
        assert sum(r["size"] for r in cluster.cluster_sizes(out).collect()) == 90
        best = counts(out.groupBy("cluster").agg(F.min("distance").alias("d")), "cluster", "d")
        assert counts(cluster.exemplars(out, method), "cluster", "distance") == best


def test_sparse_distance(spark):
    df = docs(spark, *["storm coast rain"] * 5, *["dog cat cow"] * 5)
    out, fitted = cluster.kmeans(cluster.compute_features(df, "count", 50), 2)
    assert out.agg(F.sum("distance")).first()[0] == pytest.approx(0.0, abs=1e-9)
    assert counts(out.groupBy("cluster").count(), "cluster", "count") == {0: 5, 1: 5}
    with pytest.raises(ValueError):
        cluster.compute_features(df, "other")


def test_topics(spark):
    df = lists(spark, *["storm coast rain storm"] * 8, *["dog cat cow dog"] * 8)
    swept = cluster.topic_sweep(df, ks=(3, 2), num_words=2, passes=5)
    assert counts(swept.groupBy("k").count(), "k", "count") == {3: 6, 2: 4}
    vectors = cluster._vectorize(df, "lemmas", 100, 1)[0]
    out, fitted = cluster.lda(vectors, 3, max_iter=5)
    for row in out.collect():
        assert 0 < row.closeness <= 1 and 0 <= row.cluster < 3
    assert cluster.log_perplexity(fitted, vectors) > 0
    chosen = cluster.exemplars(out, "lda")
    assert chosen.count() == out.select("cluster").distinct().count()


def test_cluster_size_stats_count_empty_clusters(spark):
    sizes = spark.createDataFrame([(0, 4), (1, 8)], "cluster int, size bigint")
    assert tuple(cluster.cluster_size_stats(sizes, 4).first()) == (0, 2.0, 5.0, 8)
    with pytest.raises(ValueError):
        cluster.do_cluster(sizes, "other")


def test_clusters_are_saved_apart(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "doc_id bigint, cluster int")
    src.write_clusters(df, str(tmp_path / "clusters"))
    one = src.read_cluster(spark, str(tmp_path / "clusters"), df.schema, 1)
    assert sorted(r.doc_id for r in one.collect()) == [1, 4, 7]


def test_exemplar_file(spark, tmp_path):
    path = src.exemplar_path(str(tmp_path / "set"), 5, "kmeans", "count", 100)
    src.write_small_json(spark.range(5), path)
    assert spark.read.json(path).count() == 5 and path.endswith("set_5_kmeans_count_100cluster_samples")


def test_rebuild_keeps_order_and_drops_copies(spark):
    rows = [(1, i, s) for i, s in enumerate("a b a c d e".split())] + [(2, 0, "x"), (2, 1, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, sent_no int, text string")
    assert counts(summary.rebuild_records(df), "doc_id", "text") == {1: "a b c d e"}


def test_doc_summary_keeps_order_and_title(spark):
    body = " ".join(f"Filler number{i} stands here." for i in range(9)) + " The storm of storms hit the storm coast."
    got = summary.doc_summary(docs(spark, body, "the of and."), "storm", 2).collect()
    assert len(got) == 1
    assert got[0].summary == "Filler number0 stands here. The storm of storms hit the storm coast."


def test_corpus_summary_ends_small(spark):
    df = docs(spark, *[f"Town{i} saw rain. People{i} left home. Nothing{i} else." for i in range(400)])
    left = summary.corpus_summary(df, "rain", top=2)
    assert left.count() == 20 and left.select("rank").distinct().count() == 20  # 400 -> 20, then a fan-in of one
    assert summary.corpus_summary(df.limit(10), "rain").count() == 10


def rouge_count(p, g):
    return sum(min(p.count(x), g.count(x)) for x in set(g)) / len(g)


def test_rouge_n(spark):
    p, g = docs(spark, "storm hit coast storm", "calm"), docs(spark, "storm hit storm", "north coast")
    got = counts(evaluate.rouge(p, g, 1), "doc_id", "score")
    assert got == {0: 0.8, 1: 0.0}
    assert counts(evaluate.rouge(p, g, 2), "doc_id", "score")[0] == pytest.approx(1 / 3, abs=1e-9)
    assert counts(evaluate.rouge(g, g.filter("doc_id = 0"), "su4"), "doc_id", "score")[0] == 1.0
    cut = evaluate.rouge(p, g, 1, length=1)
    assert counts(cut, "doc_id", "score") == {0: 0.5, 1: 0.0}


def test_rouge_by_key(spark):
    p = spark.createDataFrame([(0, "a", "storm coast"), (1, "b", "storm coast")], "doc_id bigint, s string, text string")
    g = spark.createDataFrame([("a", "storm"), ("b", "rain storm")], "s string, text string")
    assert counts(evaluate.rouge(p, g, 1, by=["s"]), "doc_id", "score") == {0: 1.0, 1: 0.5}


def test_rouge_l(spark):
    p, g = docs(spark, "storm north hit coast", "same words here"), docs(spark, "storm hit north coast", "same words here")
    assert counts(evaluate.rouge_l(p, g, "doc_id", drop_stop=False), "doc_id", "score") == {0: 0.75, 1: 1.0}


def test_rouge_l_keeps_texts_without_golden_words(spark):
    p, g = docs(spark, "storm hit coast", "storm", "storm", None), docs(spark, "storm hit", "!", None, "storm")
    g = g.filter("doc_id <> 1").unionByName(spark.createDataFrame([(9, "storm")], "doc_id bigint, text string"), True)
    assert counts(evaluate.rouge_l(p, g, "doc_id", drop_stop=False), "doc_id", "score") == {0: 1.0, 1: None, 2: None, 3: 0.0}


def test_lcs_against_table():
    import random
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randrange(0, 12))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(0, 12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert evaluate.lcs_length(a, b) == table[-1][-1]


def test_bootstrap_brackets_the_mean(spark):
    scores = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 10 / 10).alias("score"))
    row = evaluate.rouge_bootstrap(scores, 200).first()
    assert row.low < 0.45 < row.high and row.mean == pytest.approx(0.45, abs=0.02)


def test_best_pair_against_all_pairs(spark):
    import random
    rng = random.Random(5)
    for trial in range(3):
        def some(n):
            return [" ".join(rng.choice(["storm", "coast", "rain", "dog", "cat", "north", "river"])
                             for _ in range(rng.randrange(3, 9))) for _ in range(n)]
        p, g = some(25), some(12)
        frames = [spark.createDataFrame([(i, 0, s) for i, s in enumerate(x)], f"{k} bigint, sent_no int, text string")
                  for x, k in ((p, "doc_id"), (g, "item_id"))]
        for n in (1, 2):
            def grams(s):
                w = s.split()
                return [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
            best = max(((round(rouge_count(grams(a), grams(b)), 9), -i, -j) for i, a in enumerate(p) for j, b in enumerate(g)))
            row = evaluate.rouge_best_pair(*frames, ["doc_id", "sent_no"], ["item_id", "sent_no"], n).first()
            assert (row.score, -row.predicted_doc_id, -row.golden_item_id) == best


def test_best_pair_without_shared_words(spark):
    p, g = docs(spark, "storm coast"), docs(spark, "dog cat")
    row = evaluate.rouge_best_pair(p, g, ["doc_id"], ["doc_id"]).first()
    assert (row.score, row.predicted_doc_id, row.golden_doc_id) == (0.0, 0, 0)


def test_entity_coverage(spark):
    p = spark.createDataFrame([("a",), ("b",), ("b",)], "mention string")
    g = spark.createDataFrame([("b",), ("c",), ("b",)], "mention string")
    assert evaluate.entity_coverage(p, g).first().coverage == 0.5
    assert evaluate.entity_coverage(p, g.limit(0)).first().coverage is None
