"""Registered queries: name -> function of (session, table folder)."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gleaner.functions import numbers as nb
from gleaner.operators import (amounts, cluster, evaluate, features, groups, label, mentions, model, slots, summary, text,
                               weights)
from gleaner.plans import tables as t
from gleaner.sources import records as src
from gleaner.sources.staging import new_path, stage

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Sources and sinks

@query
def scan_records(spark, sf):
    return t.records(spark, sf)


@query
def load_labeled(spark, sf):
    saved = t.graded(spark, sf).select(F.col("doc_id").alias("id"), F.col("url").alias("URL_s"),
                                       F.col("text").alias("Sentences_t"), "label")
    return src.labeled_records(saved).filter(F.col("label").isin(0.0, 1.0))


@query
def summary_text(spark, sf):
    path = new_path(spark, "summaries")
    t.golden(spark, sf).select("item_id", "text").write.partitionBy("item_id").text(path)
    return src.read_summary_files(spark, path).select(F.col("item_id").cast("bigint").alias("item_id"), "text")


@query
def roundtrip_json(spark, sf):
    path = new_path(spark, "records")
    src.write_json(t.records(spark, sf).select(F.col("url").alias("URL_s"), F.col("text").alias("Sentences_t")), path)
    return src.read_records(spark, path, parts_only=True).select("url", "text")


# Text

@query
def tokens(spark, sf):
    return text.tokens(t.records(spark, sf))


@query
def tokens_cased(spark, sf):
    return text.tokens(t.records(spark, sf), lowercase=False)


@query
def tokens_ws(spark, sf):
    return text.whitespace_tokens(t.records(spark, sf)).select("doc_id", "token")


@query
def sentences(spark, sf):
    return text.sentences(t.records(spark, sf))


@query
def filter_stopwords(spark, sf):
    return text.drop_stop_words(text.tokens(t.records(spark, sf)))


@query
def filter_dictionary(spark, sf):
    tagged = text.tag_tokens(text.tokens(t.records(spark, sf), lowercase=False))
    return text.keep_dictionary_words(tagged, t.dictionary(spark, sf)).select("doc_id", "pos", "token", "tag")


@query
def filter_numeric(spark, sf):
    return text.drop_numeric(text.tokens(t.records(spark, sf)))


@query
def filter_tags(spark, sf):
    return text.keep_word_tags(text.tag_tokens(text.tokens(t.records(spark, sf))))


@query
def pos_tag(spark, sf):
    tagged = text.tag_tokens(text.tokens(t.records(spark, sf)), t.lexicon(spark, sf))
    return tagged.select("doc_id", "pos", "token", "tag")


@query
def lemmatize(spark, sf):
    tagged = text.tag_tokens(text.tokens(t.records(spark, sf)), t.lexicon(spark, sf))
    return text.lemmatize(text.keep_word_tags(tagged)).select("doc_id", "pos", "token", "tag", "lemma")


@query
def preprocess(spark, sf):
    done = text.lemma_lists(t.records(spark, sf), t.lexicon(spark, sf), t.dictionary(spark, sf))
    return done.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


@query
def bigrams(spark, sf):
    return text.bigrams(t.lists(spark, sf))


@query
def regex_matches(spark, sf):
    return text.regex_matches(t.records(spark, sf), r"([A-Z][a-z]+) License")


@query
def regex_sentences(spark, sf):
    return text.matching_sentences(text.sentences(t.records(spark, sf)), "[0-9]{3}").select("doc_id", "sent_no", "text")


@query
def relevant_sentences(spark, sf):
    found = text.relevant_sentences(text.sentences(t.records(spark, sf)), ["License", "license", "Copyright"])
    return found.select("doc_id", "sent_no", "text")


# Words

@query
def word_count(spark, sf):
    return weights.word_count(t.lists(spark, sf))


@query
def top_words(spark, sf):
    return weights.top_words(t.lists(spark, sf), 20)


@query
def bigram_count(spark, sf):
    return weights.bigram_count(t.lists(spark, sf))


@query
def top_bigrams(spark, sf):
    return weights.top_bigrams(t.lists(spark, sf), 10)


@query
def cooccurrence(spark, sf):
    return weights.cooccurrence(t.lists(spark, sf), 5)


@query
def term_frequency(spark, sf):
    return weights.term_frequency(t.lists(spark, sf)).select("lemma", "n", F.round("tf", 12).alias("tf"))


@query
def doc_frequency(spark, sf):
    return weights.doc_frequency(t.lists(spark, sf))


@query
def idf(spark, sf):
    return weights.idf(t.lists(spark, sf)).select("lemma", "df", F.round("idf", 9).alias("idf"))


@query
def tf_idf(spark, sf):
    return weights.tf_idf(t.lists(spark, sf))


@query
def important_words(spark, sf):
    return weights.important_words(t.lists(spark, sf), 20)


@query
def pos_words(spark, sf):
    found = weights.words_by_class(text.tagged_lists(t.records(spark, sf)))
    return found.select("doc_id", "tag_class", F.array_join("lemmas", " ").alias("words"))


@query
def pos_tfidf(spark, sf):
    return weights.class_tf_idf(weights.words_by_class(text.tagged_lists(t.records(spark, sf))))


def _listed_and_counted(spark, sf):
    lists = t.staged_lists(spark, sf)
    return weights.important_words(lists, 20), weights.top_words(lists, 200)


@query
def words_with_counts(spark, sf):
    return weights.with_counts(*_listed_and_counted(spark, sf))


@query
def words_without_counts(spark, sf):
    lists = t.staged_lists(spark, sf)
    return weights.without_counts(weights.important_words(lists, None), weights.top_words(lists, 20))


# Synonyms and features

@query
def related_words(spark, sf):
    lists = t.staged_lists(spark, sf)
    return groups.related_words(weights.word_count(lists), t.thesaurus(lists))


@query
def synonym_groups(spark, sf):
    lists = t.staged_lists(spark, sf)
    found = groups.synonym_groups(weights.word_count(lists), t.thesaurus(lists))
    return found.withColumn("members", F.array_join("members", " "))


@query
def top_synonym_groups(spark, sf):
    lists = t.staged_lists(spark, sf)
    found = groups.synonym_groups(weights.word_count(lists), t.thesaurus(lists))
    return groups.top_synonym_groups(found, 20).withColumn("members", F.array_join("members", " "))


@query
def merge_collocations(spark, sf):
    lists = t.staged_lists(spark, sf)
    return groups.merge_collocations(weights.bigram_count(lists), weights.word_count(lists), 20, 30)


@query
def feature_labels(spark, sf):
    return t.feature_labels(t.staged_lists(spark, sf))


@query
def feature_counts(spark, sf):
    return features.feature_counts(t.feature_table(spark, sf)).withColumn("n", F.col("n").cast("bigint"))


def _joined(column):
    return F.array_join(F.transform(column, lambda x: x.cast("int").cast("string")), ",")


@query
def feature_presence(spark, sf):
    return t.feature_table(spark, sf).select("doc_id", _joined("presence_feature_set").alias("presence"))


@query
def feature_dataset(spark, sf):
    found = t.feature_table(spark, sf, keep=("url", "text")).withColumnRenamed("lemmas", "preprocessed_record")
    return found.select("doc_id", "url", "text", F.array_join("preprocessed_record", " ").alias("lemmas"),
                        _joined("count_feature_set").alias("counts"),
                        _joined("presence_feature_set").alias("presence"))


# Labels and samples

@query
def feature_count(spark, sf):
    return label.with_feature_count(t.feature_table(spark, sf)).select("doc_id", "feature_count")


@query
def feature_stats(spark, sf):
    stats = label.feature_stats(t.counted(spark, sf))
    return stats.select(F.round("mean", 9).alias("mean"), F.round("sd", 9).alias("sd"))


@query
def auto_label(spark, sf):
    return label.auto_label(t.counted(spark, sf)).select("doc_id", "feature_count", "label")


@query
def augment_records(spark, sf):
    labeled = label.auto_label(t.counted(spark, sf, keep=("text",)))
    return label.augment_labels(labeled, False, phrase=t.PHRASE).select("doc_id", "label")


@query
def augment_sentences(spark, sf):
    start = text.sentences(t.records(spark, sf), min_length=1).withColumn("label", F.lit(-1.0))
    return label.augment_labels(start, True, boilerplate=t.BOILERPLATE).select("doc_id", "sent_no", "label", "filtered")


@query
def label_stats(spark, sf):
    return label.label_stats(label.auto_label(t.counted(spark, sf)))


@query
def train_test_split(spark, sf):
    return label.train_test_split(t.graded(spark, sf)).select("doc_id", "label", "part")


@query
def undersample(spark, sf):
    split = label.train_test_split(t.graded(spark, sf).select("doc_id", "label"))
    return label.undersample(split).select("doc_id", "label", "part")


# Classifier

@query
def mlp_predict(spark, sf):
    labeled = model.with_vectors(label.auto_label(t.counted(spark, sf), relevant_t=1.0))
    labeled = stage(labeled.select("doc_id", "features", "feature_count", "label"), "labeled")
    split = label.undersample(label.train_test_split(labeled))
    fitted = model.train_model(split.filter("part = 'train'"), labeled.first().features.size)
    merged = model.merge_predictions(labeled, model.predict_unlabeled(labeled, fitted))
    return merged.select("doc_id", "feature_count", "label")


@query
def relevant_records(spark, sf):
    graded = t.graded(spark, sf)
    merged = model.merge_predictions(graded, t.guess(graded.filter("label = -1.0")))
    return model.relevant(merged).select("doc_id", "url", "label")


@query
def accuracy(spark, sf):
    return model.accuracy(t.guess(t.graded(spark, sf).filter("label >= 0"))).select(
        "correct", "total", F.round("accuracy", 9).alias("accuracy"))


@query
def prediction_profile(spark, sf):
    graded = t.counted(spark, sf, keep=("n_chars",)).join(t.graded(spark, sf).select("doc_id", "label"), "doc_id")
    merged = model.merge_predictions(graded, t.guess(graded.filter("label = -1.0")))
    return model.prediction_profile(merged).withColumn("mean", F.round("mean", 9))


@query
def chi2_features(spark, sf):
    return model.top_chi2(model.chi2_scores(t.guess(t.lists(spark, sf, keep=("n_chars",)))), 50)


# Clusters and topics

def _vectors(spark, sf):
    vectors = array_to_vector(F.col("embedding").cast("array<double>"))
    return t.table(spark, sf, "embeddings").select("vec_id", vectors.alias("features"))


@query
def count_vocab(spark, sf):
    return cluster.count_vocabulary(t.records(spark, sf))


@query
def hashed_tfidf(spark, sf):
    found = cluster.compute_features(t.records(spark, sf), "tfidf", 1000)
    values = F.unwrap_udt("features")["values"]
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return found.select("doc_id", F.size(values).alias("terms"), F.round(total, 6).alias("weight"))


@query
def kmeans_clusters(spark, sf):
    return cluster.do_cluster(_vectors(spark, sf), "kmeans", 5)[0].select("vec_id", "cluster", "distance")


@query
def bisecting_clusters(spark, sf):
    return cluster.do_cluster(_vectors(spark, sf), "bisecting", 5)[0].select("vec_id", "cluster", "distance")


@query
def lda_clusters(spark, sf):
    vectors = cluster.compute_features(t.records(spark, sf), "count").select("doc_id", "features")
    return cluster.do_cluster(vectors, "lda", 5)[0].select("doc_id", "cluster", "closeness")


def _numbered(spark, sf):
    terms = cluster.doc_terms(t.lists(spark, sf))
    return terms, cluster.term_numbers(terms)


@query
def term_numbers(spark, sf):
    return _numbered(spark, sf)[1]


@query
def term_vectors(spark, sf):
    parts = F.unwrap_udt("features")
    found = cluster.sparse_vectors(*_numbered(spark, sf))
    return found.select("doc_id", F.array_join(parts["indices"].cast("array<string>"), ",").alias("numbers"),
                        F.array_join(parts["values"].cast("array<bigint>").cast("array<string>"), ",").alias("counts"),
                        parts["size"].cast("bigint").alias("size"))


@query
def count_vectors(spark, sf):
    vectors, _ = cluster.count_vectors(t.records(spark, sf))
    parts = F.unwrap_udt("features")
    return vectors.select("doc_id", F.array_join(parts["indices"].cast("array<string>"), ",").alias("numbers"),
                          F.array_join(parts["values"].cast("array<bigint>").cast("array<string>"), ",").alias("counts"))


@query
def lda_topic_sweep(spark, sf):
    return cluster.topic_sweep(t.lists(spark, sf))


@query
def cluster_exemplars_kmeans(spark, sf):
    clustered = cluster.kmeans(_vectors(spark, sf), 5)[0].select("vec_id", "cluster", "distance")
    return cluster.exemplars(clustered, "kmeans", "vec_id")


@query
def cluster_exemplars_lda(spark, sf):
    vectors = cluster.compute_features(t.records(spark, sf), "count").select("doc_id", "features")
    # Read twice, and the topics of a record cost as much as a pass of the fit.
    clustered = stage(cluster.lda(vectors, 5)[0].select("doc_id", "cluster", "closeness"), "clustered")
    return cluster.exemplars(clustered, "lda")


def _given_clusters(spark, sf):
    return t.table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("cluster"))


@query
def cluster_sizes(spark, sf):
    return cluster.cluster_sizes(_given_clusters(spark, sf))


@query
def cluster_size_stats(spark, sf):
    return cluster.cluster_size_stats(cluster.cluster_sizes(_given_clusters(spark, sf)))


# Mentions

def _mentions(spark, sf):
    return mentions.mentions(t.records(spark, sf), t.PATTERNS)


@query
def mentions_typed(spark, sf):
    return _mentions(spark, sf)


@query
def mentions_places(spark, sf):
    found = mentions.mentions(t.reports(spark, sf), mentions.EVENT_PATTERNS, t.gazetteer(spark, sf), ("event_key",))
    return mentions.entity_count(found, ("event_key", "type"))


@query
def mentions_clean(spark, sf):
    return mentions.mentions_of(_mentions(spark, sf), "EMAIL").select("doc_id", "ord", "mention")


@query
def sentences_with_type(spark, sf):
    return mentions.sentences_with_type(t.reports(spark, sf), "QUANTITY", mentions.EVENT_PATTERNS)


@query
def sentences_with_place(spark, sf):
    found = mentions.sentences_with_place(t.reports(spark, sf), t.gazetteer(spark, sf), "GPE", ["event_key", "text"])
    return found.groupBy("event_key", "text").agg(F.count(F.lit(1)).alias("n"))


@query
def document_phrases(spark, sf):
    """Sentences of the benchmark that stand in documents: a gazetteer of long entries."""
    entries = text.sentences(t.golden(spark, sf), key="item_id").select(F.lit("PASSAGE").alias("type"), "text").distinct()
    found = mentions.place_mentions(t.records(spark, sf), entries)
    return found.groupBy("doc_id", "mention").agg(F.count(F.lit(1)).alias("n"))


@query
def entity_count(spark, sf):
    return mentions.entity_count(_mentions(spark, sf))


@query
def top_entities(spark, sf):
    return mentions.top_entities(_mentions(spark, sf), 50)


# Event slots

def _facts(spark, sf, *names):
    return slots.facts(t.reports(spark, sf), t.gazetteer(spark, sf), names or slots.SLOTS, t.KEYWORDS)


def _quantities(spark, sf):
    found = mentions.mentions(t.reports(spark, sf), {"QUANTITY": mentions.QUANTITY}, keep=("event_key",))
    return found.groupBy("event_key", "mention").agg(F.count(F.lit(1)).alias("n"))


@query
def convert_mph(spark, sf):
    return _quantities(spark, sf).withColumn("mph", F.round(nb.to_mph(F.col("mention")), 6))


@query
def convert_inches(spark, sf):
    return _quantities(spark, sf).withColumn("inches", F.round(nb.to_inches(F.col("mention")), 6))


@query
def date_parts(spark, sf):
    return slots.date_parts(_facts(spark, sf, "date"))


@query
def slot_mode(spark, sf):
    return slots.modes(_facts(spark, sf, "name", "storm", "category"))


@query
def slot_top_places(spark, sf):
    return slots.top_values(_facts(spark, sf, *slots.PLACES), {"landfall_place": 2, "evacuation_place": 3})


@query
def slot_range(spark, sf):
    return slots.ranges(_facts(spark, sf, "wind")).select("event_key", "low", "high", "mean")


@query
def slot_range_len(spark, sf):
    return slots.ranges(_facts(spark, sf, "rain")).select("event_key", "low", "high", "mean")


@query
def slot_size(spark, sf):
    found = slots.ranges(_facts(spark, sf, "size"))
    return found.select("event_key", "mean", (F.col("mean") + F.col("sd")).alias("high"))


@query
def slot_count_mean(spark, sf):
    return slots.ranges(_facts(spark, sf, "deaths")).select("event_key", "mean")


@query
def slot_headcount(spark, sf):
    return slots.modes(_facts(spark, sf, "headcount")).select("event_key", "value", "n")


@query
def slot_mentions_by_type(spark, sf):
    return slots.mentions_by_type(t.reports(spark, sf), t.gazetteer(spark, sf), t.KEYWORDS["restoration"])


@query
def slot_amounts(spark, sf):
    return amounts.amount_facts(t.bulletins(spark, sf))


def _losses(spark, sf, slot):
    facts = amounts.amount_facts(t.bulletins(spark, sf)).filter(F.col("slot") == slot)
    return amounts.amount_summary(facts).select("event_key", "low", "median", "high", "n")


@query
def slot_damage(spark, sf):
    return _losses(spark, sf, "damage")


@query
def slot_injuries(spark, sf):
    return _losses(spark, sf, "injuries")


@query
def slot_restoration(spark, sf):
    return slots.mentions_by_type(t.bulletins(spark, sf), t.gazetteer(spark, sf), organisations=True)


@query
def date_intervals(spark, sf):
    return slots.periods(t.bulletins(spark, sf))


@query
def slot_likely_period(spark, sf):
    return slots.likely_period(slots.periods(t.bulletins(spark, sf)))


@query
def slot_date_consensus(spark, sf):
    return slots.consensus_dates(_facts(spark, sf, "landfall_date")).select("event_key", "date_text")


@query
def slot_month_year(spark, sf):
    return slots.consensus_dates(_facts(spark, sf, "date"), "date").select("event_key", "month_year")


@query
def slot_first_date(spark, sf):
    return slots.first_dates(t.reports(spark, sf), slots.modes(_facts(spark, sf, "name")))


@query
def slot_report(spark, sf):
    sentences = t.reports(spark, sf)
    facts = stage(_facts(spark, sf), "facts")
    first = slots.first_dates(sentences, slots.modes(facts, ("name",)))
    return slots.report(slots.fields(facts, first))


# Summaries

@query
def rebuild_records(spark, sf):
    return summary.rebuild_records(text.sentences(t.records(spark, sf)))


@query
def doc_summary(spark, sf):
    return summary.doc_summary(t.records(spark, sf), t.TITLE)


@query
def sentence_scores(spark, sf):
    return summary.sentence_scores(t.records(spark, sf), t.TITLE)


@query
def corpus_level(spark, sf):
    """The first level of the corpus summary: twenty summaries each, summarised against the title."""
    found = summary.doc_summary(t.records(spark, sf))
    level, _ = summary._ranked(found.select("doc_id", F.col("summary").alias("text")), "doc_id")
    return summary.next_level(level, t.TITLE, summary.LARGEST_FAN_IN)


@query
def corpus_summary(spark, sf):
    return summary.corpus_summary(t.records(spark, sf), t.TITLE)


# Evaluation

def _rouge(spark, sf, kind):
    return evaluate.rouge(t.records(spark, sf), t.golden(spark, sf), kind)


@query
def rouge_1(spark, sf):
    return _rouge(spark, sf, 1)


@query
def rouge_2(spark, sf):
    return _rouge(spark, sf, 2)


@query
def rouge_su4(spark, sf):
    return _rouge(spark, sf, "su4")


@query
def rouge_l(spark, sf):
    turns = t.table(spark, sf, "conversations")
    replies = turns.filter("role = 'assistant'")
    prompts = turns.filter("role = 'user'").withColumn("turn", F.col("turn") + 1)
    return evaluate.rouge_l(replies, prompts, ["conv_id", "turn"])


@query
def rouge_bootstrap(spark, sf):
    return evaluate.rouge_bootstrap(_rouge(spark, sf, 1), 1000)


@query
def rouge_best_pair(spark, sf):
    predicted = text.sentences(t.records(spark, sf))
    golden = text.sentences(t.golden(spark, sf), key="item_id")
    best = evaluate.rouge_best_pairs(predicted, golden, ["doc_id", "sent_no"], ["item_id", "sent_no"])
    return best.withColumn("kind", F.concat(F.lit("rouge_"), "kind")).withColumnRenamed("kind", "metric")


@query
def entity_coverage(spark, sf):
    golden = mentions.mentions(t.golden(spark, sf), t.PATTERNS, keep=("item_id",))
    return evaluate.entity_coverage(_mentions(spark, sf), golden)


QUERIES["mentions"] = QUERIES.pop("mentions_typed")
