"""Synonym groups, and merging of bigrams with a word list."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from gleaner.functions.numbering import numbered
from gleaner.operators.weights import top
from gleaner.sources.staging import stage


def related_words(words: DataFrame, thesaurus: DataFrame) -> DataFrame:
    """Each listed word with its related words from thesaurus(word, related), and with itself: (word, related)."""
    listed = words.select(F.col("lemma").alias("word"))
    found = listed.join(thesaurus.select("word", "related"), "word")
    return found.unionByName(listed.select("word", F.col("word").alias("related"))).distinct()


def synonym_groups(words: DataFrame, thesaurus: DataFrame, weight: str = "n") -> DataFrame:
    """Each word of words(lemma, weight) with its related words in the list and the sum of their weights.

    Rows: (word, total, members); the word itself is a member.
    """
    weights = words.select(F.col("lemma").alias("related"), F.col(weight).alias("_weight"))
    return (related_words(words, thesaurus).join(weights, "related")
            .groupBy("word").agg(F.sum("_weight").alias("total"),
                                 F.sort_array(F.collect_list("related")).alias("members")))


def top_synonym_groups(groups: DataFrame, k: int = 20) -> DataFrame:
    """The k groups with the largest non-zero total, ties in order of the word."""
    return groups.filter("total <> 0").orderBy(F.desc("total"), "word").limit(k)


def _matched(edges: DataFrame) -> DataFrame:
    """(rank, a, b): the edges that picking in order of rank takes, where an edge needs both its ends unused.

    In rounds: an edge that has the lowest rank at both its ends is taken, as nothing before it can use them, and the edges
    at its ends drop out. Each round is written once. A round takes all such edges at once; the number of rounds grows with
    the longest run of edges in which each waits for the one before.
    """
    taken, left = [], edges
    while True:
        ends = left.select("rank", F.explode(F.array("a", "b")).alias("word"))
        lowest, marked = ends.groupBy("word").agg(F.min("rank").alias("lowest")), left
        for end in ("a", "b"):
            marked = marked.join(lowest.select(F.col("word").alias(end), F.col("lowest").alias(f"lowest_{end}")), end)
        marked = marked.withColumn("taken", (F.col("rank") == F.col("lowest_a")) & (F.col("rank") == F.col("lowest_b")))
        marked = stage(marked.select("rank", "a", "b", "taken"), "marked")
        now = marked.filter("taken").select("rank", "a", "b")
        taken.append(now)
        used = now.select(F.explode(F.array("a", "b")).alias("word"))
        left = marked.filter("not taken").select("rank", "a", "b")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, taken)
        for end in ("a", "b"):
            left = left.join(used.withColumnRenamed("word", end), end, "left_anti").select("rank", "a", "b")


def merge_collocations(bigrams: DataFrame, words: DataFrame, num_bigrams: int = 10, num_words: int = 20,
                       bigram_value: str = "n", word_value: str = "n") -> DataFrame:
    """Bigrams whose two different words are both listed and still unused, in rank order; then the unused words.

    Takes the top `num_bigrams` of bigrams(bigram, value) and the top `num_words` of words(lemma, value). Both lists stay
    rows: words are found by joins, and the pick runs in rounds. Rows: (position, kind, item).
    """
    def ranked(df, value, item, k):
        best = top(df.select(item, F.col(value).alias("_value")), "_value", item, k)
        return stage(numbered(best, F.desc("_value"), F.asc(item), name="rank").select("rank", item), "ranked")
    best, listed = ranked(bigrams, bigram_value, "bigram", num_bigrams), ranked(words, word_value, "lemma", num_words)
    edges = best.select("rank", *[F.split_part("bigram", F.lit(" "), F.lit(i)).alias(c) for i, c in ((1, "a"), (2, "b"))])
    edges = edges.filter("a <> b")
    for end in ("a", "b"):
        edges = edges.join(listed.select(F.col("lemma").alias(end)), end, "left_semi")
    picked = stage(_matched(edges.select("rank", "a", "b")), "picked")
    used = picked.select(F.explode(F.array("a", "b")).alias("lemma"))
    items = (picked.join(best, "rank").select(F.lit(0).alias("_part"), "rank", F.lit("bigram").alias("kind"), F.col("bigram").alias("item"))
             .unionByName(listed.join(used, "lemma", "left_anti").select(
                 F.lit(1).alias("_part"), "rank", F.lit("word").alias("kind"), F.col("lemma").alias("item"))))
    placed = numbered(items, "_part", "rank", name="position")
    return placed.select(F.col("position").cast("int").alias("position"), "kind", "item")
