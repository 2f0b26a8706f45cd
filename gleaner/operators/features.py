"""Feature vocabulary and per-record feature sets."""

import json

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions import text as tx
from gleaner.operators import groups, text, weights
from gleaner.sources.staging import stage


def feature_labels(lists: DataFrame, thesaurus, num_words: int = 20, num_bigrams: int = 10,
                   min_share: float = 0.1, stats: DataFrame = None) -> DataFrame:
    """The feature vocabulary: (feature_id, kind, term), kind is 'bigram', 'word' or 'synset' (one row per member).

    Built from the `num_words` most important words and the `num_bigrams` most frequent bigrams, so it is small
    whatever the size of the corpus. `stats` are the written rows of `weights.term_stats` on written lists: with them the
    words need no scan, and the bigrams only those of frequent words. `thesaurus` is a table, or a function that gives the table
    for the listed words.
    """
    # A list of num_words rows with four readers, so it is written out once.
    words = stage(weights.important_words(lists, num_words, min_share=min_share, stats=stats), "words")
    if stats is None:
        bigrams = weights.top_bigrams(lists, num_bigrams)
    else:
        bigrams = weights.frequent_bigrams(lists, stats, num_bigrams)
    merged = groups.merge_collocations(bigrams, words, num_bigrams, num_words,
                                       word_value="score")
    thesaurus = thesaurus(words) if callable(thesaurus) else thesaurus
    synonyms = groups.synonym_groups(words, thesaurus, "score").select(F.col("word").alias("item"), "members")
    joined = merged.join(synonyms, "item", "left")
    synset = (F.col("kind") == "word") & (F.size("members") > 1)
    return joined.select(
        F.col("position").alias("feature_id"), F.when(synset, "synset").otherwise(F.col("kind")).alias("kind"),
        F.explode(F.when(synset, F.col("members")).otherwise(F.array("item"))).alias("term"))


def feature_sets(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Add `count_feature_set` and `presence_feature_set`, one slot per feature, to rows with a `lemmas` array.

    Words and bigrams count their occurrences, a synset counts its members that occur. Works inside the row, so the
    records are not shuffled and those without any feature stay; null lemmas give null sets. Each lemma and bigram is looked
    up once in a hashed vocabulary, then each feature reads its terms' counts: linear in lemmas plus terms. The vocabulary
    comes to the driver; it has a few terms for each of the features that the parameters of `feature_labels` allow.
    """
    columns, features = lists.columns, {}
    for r in labels.select("feature_id", "kind", "term").collect():
        features.setdefault((r.feature_id, r.kind), set()).add(r.term)
    vocabulary = sorted(set().union(*features.values()))
    if not vocabulary:
        none = F.when(F.col("lemmas").isNotNull(), F.array().cast("array<double>"))
        return lists.withColumns({"count_feature_set": none, "presence_feature_set": none})
    at = {term: k for k, term in enumerate(vocabulary)}
    slots = [{"synset": kind == "synset", "at": [at[t] for t in sorted(terms)]} for (_, kind), terms in sorted(features.items())]
    # Only what can be a term is handed on: listed lemmas, and pairs whose halves are those of a term, parted at any of its spaces.
    halves = [(t[:i], t[i + 1:]) for t in vocabulary for i, c in enumerate(t) if c == " "]
    first, second = ({h[i] for h in halves} for i in (0, 1))
    terms = F.coalesce(F.expr(f"concat(filter(lemmas, t -> {tx.among('t', vocabulary)}), filter(zip_with(lemmas, slice(lemmas, 2, "
                              f"greatest(size(lemmas), 0)), (a, b) -> if({tx.among('a', first)} AND {tx.among('b', second)}, "
                              "concat(a, ' ', b), NULL)), p -> p IS NOT NULL))"), F.array().cast("array<string>"))
    counted = CountVectorizerModel.from_vocabulary(vocabulary, "_terms", "_counts").transform(lists.withColumn("_terms", terms))
    df = counted.select(*columns, vector_to_array("_counts").alias("_counts"))
    counts = F.transform(F.from_json(F.lit(json.dumps(slots)), "array<struct<synset: boolean, at: array<int>>>"), lambda f: F.when(
        f["synset"], F.size(F.filter(f["at"], lambda i: F.col("_counts")[i] > 0)).cast("double")).otherwise(F.col("_counts")[f["at"][0]]))
    df = df.select(*columns, F.when(F.col("lemmas").isNotNull(), counts).alias("count_feature_set"))
    return df.withColumn("presence_feature_set", presence(F.col("count_feature_set")))


def presence(counts: Column) -> Column:
    """Counts clipped to 0 or 1."""
    return F.transform(counts, lambda n: F.when(n > 0, 1.0).otherwise(0.0))


def feature_counts(features: DataFrame, key: str = "doc_id") -> DataFrame:
    """Non-zero counts as rows (key, feature_id, n)."""
    # The outer form: for the inner one Spark adds a size filter that computes the sets a second time.
    return features.select(key, F.posexplode_outer("count_feature_set").alias("feature_id", "n")).filter("n > 0")


def densify(counts: DataFrame, num_features: int, records: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows (key, feature_id, n) back to one `count_feature_set` per record, zeros included."""
    sparse = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("feature_id", "n"))).alias("_cells"))
    slots = F.sequence(F.lit(0), F.lit(num_features - 1))
    dense = F.transform(slots, lambda i: F.coalesce(F.element_at("_cells", i), F.lit(0.0)).cast("double"))
    return records.join(sparse, key, "left").withColumn("count_feature_set", dense).drop("_cells")


def feature_dataset(records: DataFrame, labels: DataFrame, lists=None, key: str = "doc_id") -> DataFrame:
    """Records with their text, lemmas and both feature sets.

    All four parts come from the same row, so no join is needed; pass `lists` to join lemma lists made elsewhere.
    """
    if lists is None:
        kept = [c for c in records.columns if c != key]
        lists = text.lemma_lists(records, key=key, keep=kept)
    else:
        lists = records.join(lists, key)
    return feature_sets(lists, labels).withColumnRenamed("lemmas", "preprocessed_record")
