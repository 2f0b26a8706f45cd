"""Counts and weights of words: frequency, document frequency, TF-IDF, bigrams, co-occurrence, top lists."""

from pyspark.sql import DataFrame, Window, functions as F

from gleaner.functions import text as tx, vocab
from gleaner.sources.staging import stage


def _count(items: DataFrame, name: str) -> DataFrame:
    return items.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def _exploded(lists, items, name):
    # The outer form: for the inner one Spark adds a size filter that computes the items, and the lists below, again.
    return lists.select(F.posexplode_outer(items).alias("_pos", name)).filter("_pos IS NOT NULL").select(name)


def word_count(lists: DataFrame) -> DataFrame:
    """Occurrences of each lemma: (lemma, n)."""
    # The outer form: for the inner one Spark adds a size filter that computes the lists a second time.
    return _count(lists.select(F.explode_outer("lemmas").alias("lemma")).filter("lemma IS NOT NULL"), "lemma")


def bigram_count(lists: DataFrame) -> DataFrame:
    """Occurrences of each pair of neighbouring lemmas: (bigram, n)."""
    return _count(_exploded(lists, tx.pairs(F.col("lemmas")), "bigram"), "bigram")


def cooccurrence(lists: DataFrame, window: int = 5) -> DataFrame:
    """Ordered pairs of lemmas less than `window` places apart: (bigram, n). A window of 2 is `bigram_count`."""
    return _count(_exploded(lists, tx.skip_pairs(F.col("lemmas"), window - 1), "bigram"), "bigram")


def doc_frequency(lists: DataFrame) -> DataFrame:
    """Number of records that hold each lemma: (lemma, df)."""
    return (lists.select(F.explode(F.array_distinct("lemmas")).alias("lemma"))
            .groupBy("lemma").agg(F.count(F.lit(1)).alias("df")))


def term_stats(lists: DataFrame, by=()) -> DataFrame:
    """(lemma, n, df, records): one aggregate over one scan.

    The row with records > 0 counts the records themselves (n = df = 0), so that their number needs no second scan.
    """
    # A marker, every lemma, then each different one: the place tells which, so no array is sorted or taken apart by a lambda.
    # The outer form, as in `word_count`.
    cells = F.concat(F.array(F.lit("")), F.col("lemmas"), F.array_distinct("lemmas"))
    place, held = F.col("_place"), F.col("_size")
    return (lists.select(*by, F.size("lemmas").alias("_size"), F.posexplode_outer(cells).alias("_place", "lemma"))
            .filter("_place IS NOT NULL").groupBy(*by, "lemma").agg(
                F.count_if((place > 0) & (place <= held)).alias("n"),
                F.count_if((place > held) & F.col("lemma").isNotNull()).alias("df"),
                F.count_if(place == 0).alias("records")))


def counts_of(stats: DataFrame) -> DataFrame:
    """The counts of `word_count` from the rows of `term_stats`: (lemma, n)."""
    return stats.filter("lemma IS NOT NULL AND n > 0").select("lemma", "n")


def with_totals(stats: DataFrame) -> DataFrame:
    """The lemma rows of `term_stats` with the sum of all n as `total` and the number of records as `size`."""
    # The totals use every column of `stats`, so that both readers share one exchange.
    totals = stats.agg(F.struct(F.sum("n").alias("n"), F.sum("records").alias("records"), F.max("df").alias("df"))
                       .alias("totals")).scalar()
    # Coalesced, or a null check on the totals is pushed below the exchange and the two no longer match.
    return (stats.withColumn("_totals", totals).filter("records = 0")
            .select("lemma", "n", "df", F.coalesce("_totals.n", F.lit(0)).alias("total"),
                    F.coalesce("_totals.records", F.lit(0)).alias("size")))


def term_frequency(lists: DataFrame) -> DataFrame:
    """Share of each lemma in all lemmas: (lemma, n, tf)."""
    counts = word_count(lists)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("tf", F.col("n") / total)


def _frequent(lists, min_share, stats=None):
    return with_totals(term_stats(lists) if stats is None else stats).filter(F.col("df") > F.col("size") * F.lit(min_share))


def idf(lists: DataFrame, min_share: float = 0.1) -> DataFrame:
    """log10(records / df) of lemmas in more than `min_share` of the records: (lemma, df, idf)."""
    return _frequent(lists, min_share).select("lemma", "df", F.log10(F.col("size") / F.col("df")).alias("idf"))


def tf_idf(lists: DataFrame, min_share: float = 0.1, stats: DataFrame = None) -> DataFrame:
    """Corpus TF-IDF of lemmas in more than `min_share` of the records: (lemma, n, df, score).

    `stats` are the rows of `term_stats` on these lists where they have been written out.
    """
    score = F.col("n") / F.col("total") * F.log10(F.col("size") / F.col("df"))
    return _frequent(lists, min_share, stats).select("lemma", "n", "df", F.round(score, 12).alias("score"))


def top(df: DataFrame, value: str, item: str, k: int = None) -> DataFrame:
    """The k rows with the largest value, ties in order of the item; all rows in that order when k is None."""
    ordered = df.orderBy(F.desc(value), item)
    return ordered if k is None else ordered.limit(k)


def top_words(lists: DataFrame, k: int = 20, counts: bool = True) -> DataFrame:
    """The k most frequent lemmas, with or without counts."""
    best = top(word_count(lists), "n", "lemma", k)
    return best if counts else best.select("lemma")


def top_bigrams(lists: DataFrame, k: int = 10, window: int = 2) -> DataFrame:
    """The k most frequent bigrams (pairs within a larger window on request)."""
    return top(bigram_count(lists) if window == 2 else cooccurrence(lists, window), "n", "bigram", k)


PILOT_WORDS, LISTED_WORDS = 500, 2000  # words of the first count of `frequent_bigrams`, and words that a plan may list


def frequent_bigrams(lists: DataFrame, stats: DataFrame, k: int = 10) -> DataFrame:
    """The rows of `top_bigrams` for written lists and their written `term_stats`, without counting all bigrams.

    Exact: a bigram occurs no more often than either of its words. The k-th largest count among pairs of the most frequent
    words is a bound that the k best bigrams reach, so only words that reach it can be in them; they are counted again only where
    there are more of them than the most frequent words of the first count. All bigrams are counted where
    that leaves too many words, or where a lemma is null or holds a space, as then a
    bigram's words aren't known.
    """
    def among(words):
        listed = f"IN ({', '.join(map(tx.quote, words))})"
        # The last lemma meets null, which is not listed.
        pairs = ("filter(zip_with(lemmas, slice(lemmas, 2, greatest(size(lemmas), 0)), "
                 f"(a, b) -> if(a {listed} AND b {listed}, concat(a, ' ', b), NULL)), p -> p IS NOT NULL)")
        return _count(_exploded(lists, F.expr(pairs), "bigram"), "bigram")
    counts = counts_of(stats)
    words = [r.lemma for r in top(counts, "n", "lemma", PILOT_WORDS).collect()]
    if not words:
        return top_bigrams(lists, k)
    found = stage(top(among(words), "n", "bigram", k), "bigrams")
    best = sorted(found.collect(), key=lambda r: -r.n)
    bound = best[-1].n if len(best) == k else 1
    odd = F.col("lemma").isNull() | F.contains("lemma", F.lit(" "))
    reach, others = stats.filter("n > 0").agg(F.count_if(F.col("n") >= bound), F.count_if(odd)).first()
    if others or reach > LISTED_WORDS:
        return top_bigrams(lists, k)
    if reach <= len(words):  # the words of the first count are all that matter
        return top(found, "n", "bigram")
    words = [r.lemma for r in counts.filter(F.col("n") >= bound).select("lemma").collect()]
    return top(among(words), "n", "bigram", k)


def important_words(lists: DataFrame, k: int = 20, scores: bool = True, min_share: float = 0.1, stats: DataFrame = None) -> DataFrame:
    """The k lemmas with the largest TF-IDF."""
    best = top(tf_idf(lists, min_share, stats), "score", "lemma", k)
    return best if scores else best.select("lemma")


def words_by_class(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """Nouns and verbs of each record: (key, tag_class, lemmas), one row per record and class."""
    def of(tags):
        return F.filter("tagged", lambda x: x["tag"].isin(*tags)).getField("lemma")
    classes = F.array(F.struct(F.lit("noun").alias("tag_class"), of(vocab.NOUN_TAGS).alias("lemmas")),
                      F.struct(F.lit("verb").alias("tag_class"), of(vocab.VERB_TAGS).alias("lemmas")))
    return tagged.select(key, F.inline(classes))


def class_tf_idf(by_class: DataFrame, min_share: float = 0.1) -> DataFrame:
    """TF-IDF inside each word class, the top N of each where N is the number of records.

    Rows: (tag_class, lemma, n, df, score). Lemmas above the share are few (bounded by words per record over
    `min_share`), so ranking a class stays small.
    """
    stats = term_stats(by_class, by=("tag_class",))
    # Reads every column of `stats` (as `with_totals` does), so that both sides of the join share one exchange.
    totals = stats.groupBy("tag_class").agg(F.sum("n").alias("total"), F.sum("records").alias("count"),
                                            F.max("df").alias("_most"))
    scored = (stats.join(F.broadcast(totals), "tag_class")
              .filter((F.col("records") == 0) & (F.col("df") > F.col("count") * F.lit(min_share))
                      & (F.col("df") <= F.col("_most")))
              .withColumn("score", F.round(F.col("n") / F.col("total") * F.log10(F.col("count") / F.col("df")), 12)))
    rank = F.row_number().over(Window.partitionBy("tag_class").orderBy(F.desc("score"), "lemma"))
    return (scored.withColumn("rank", rank).filter(F.col("rank") <= F.col("count"))
            .select("tag_class", "lemma", "n", "df", "score"))


def with_counts(words: DataFrame, counts: DataFrame) -> DataFrame:
    """Listed words with their counts: (lemma, n)."""
    return words.select("lemma").join(counts.select("lemma", "n"), "lemma")


def without_counts(words: DataFrame, counts: DataFrame) -> DataFrame:
    """Listed words that the counts lack."""
    return words.select("lemma").join(counts.select("lemma"), "lemma", "left_anti")
