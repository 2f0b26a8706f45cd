"""The test tables bound to the inputs of the operators."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.functions import text as tx
from gleaner.operators import features, label, text, weights
from gleaner.sources.records import long_records
from gleaner.sources.staging import stage

PATTERNS = {
    "IP": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "ORG": r"[A-Z][a-z]+ (?:Public )?License",
    "EMAIL": r"[a-z0-9._]+@[a-z0-9.]+",
    "CARD": r"[0-9]{16}",
    "NAME": r"[A-Z][a-z]+(?: [A-Z][a-z]+)*",
}
PHRASE = "license"
BOILERPLATE = ["share", "license", "@"]
TITLE = "released license"
KEYWORDS = {"rain": ("rain", "Rain"), "restoration": ("evacuation", "landfall")}
LONG_TEXT = 1000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf, lang=None) -> DataFrame:
    """(doc_id, lang, url, text, n_chars), texts over 99 characters, optionally of one language."""
    df = long_records(table(spark, sf, "documents").select("doc_id", "lang", F.col("source").alias("url"), "text", "n_chars"))
    return df if lang is None else df.filter(F.col("lang") == lang)


def records(spark, sf, lang=None) -> DataFrame:
    return documents(spark, sf, lang).select("doc_id", "url", "text")


def lists(spark, sf, keep=()) -> DataFrame:
    return text.lemma_lists(documents(spark, sf), keep=keep)


def golden(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark")


def dictionary(spark, sf) -> DataFrame:
    words = F.explode(tx.find_all(F.lower("text"), r"\p{L}+"))
    return golden(spark, sf).select(words.alias("token")).distinct()


def lexicon(spark, sf) -> DataFrame:
    """Tags and lemmas for some dictionary words, different from what the rules give."""
    word = F.col("token")
    kind = F.when(word.endswith("er"), "JJR").when(word.endswith("es"), "NNS")
    return (dictionary(spark, sf).filter((F.length(word) >= 4) & kind.isNotNull())
            .select("token", kind.alias("tag"), F.left(word, F.length(word) - 2).alias("lemma")))


def thesaurus(lemma_lists: DataFrame, counts: DataFrame = None, listed: DataFrame = None) -> DataFrame:
    """Words related by stem: (word, related); `counts` are the lists' word counts where they have been written out.

    With a short list of words `listed`(lemma), only the words that have the stem of one of them are grouped.

    A stem has at most one word per suffix and one without, so a group holds at most six words.
    """
    counts = weights.word_count(lemma_lists) if counts is None else counts
    stem = F.regexp_replace("lemma", "(tion|ing|ed|ly|ble)$", "")
    stems = counts.select("lemma", stem.alias("stem")).filter(F.length("stem") >= 2)
    if listed is not None:
        stems = stems.join(F.broadcast(listed.select(stem.alias("stem")).distinct()), "stem", "left_semi")
    grouped = (stems.groupBy("stem").agg(F.collect_list("lemma").alias("words")))
    return (grouped.select(F.explode("words").alias("word"), "words")
            .select("word", F.explode("words").alias("related")).filter("word <> related"))


def staged_lists(spark, sf, keep=()) -> DataFrame:
    """(doc_id, lang, *keep, lemmas), written out for several readers."""
    return stage(lists(spark, sf, ("lang", *keep)), "lemmas")


def feature_labels(lemma_lists: DataFrame) -> DataFrame:
    """The feature vocabulary of written lists, from one written count of their words."""
    stats = stage(weights.term_stats(lemma_lists), "stats")
    return features.feature_labels(lemma_lists, lambda words: thesaurus(lemma_lists, weights.counts_of(stats), words), stats=stats)


def feature_table(spark, sf, keep=()) -> DataFrame:
    """(doc_id, *keep, lemmas, count_feature_set, presence_feature_set); the vocabulary is written out for reuse."""
    lemma_lists = staged_lists(spark, sf, keep)
    labels = stage(feature_labels(lemma_lists), "labels")
    return features.feature_sets(lemma_lists.drop("lang"), labels)


def counted(spark, sf, keep=()) -> DataFrame:
    """Feature sets with their count, written out without text or lemmas."""
    return stage(label.with_feature_count(feature_table(spark, sf, keep)).drop("lemmas"), "features")


def graded(spark, sf) -> DataFrame:
    """Documents with `label` from the quality table, -1 where there is none."""
    grades = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return (documents(spark, sf).join(grades, "doc_id", "left")
            .withColumn("label", F.coalesce("label", F.lit(-1.0))))


def guess(df: DataFrame) -> DataFrame:
    """A given prediction: long texts are relevant."""
    return df.withColumn("prediction", F.when(F.col("n_chars") > LONG_TEXT, 1.0).otherwise(0.0))


def reports(spark, sf) -> DataFrame:
    """(event_key, text): one sentence about a region per line item."""
    item = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    joined = (item.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
              .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    q = F.col("l_quantity").cast("int").cast("string")
    name = F.concat(F.upper(F.substring("r_name", 1, 1)), F.lower(F.expr("substring(r_name, 2)")))
    day, place, line = F.date_format("o_orderdate", "MMMM d, yyyy"), F.col("n_name"), F.col("l_linenumber")

    def say(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    kind = line % 6
    sentence = (
        F.when(kind == 0, say("Hurricane ", name, " brought winds of ", q, " miles per hour to ", place, " on ", day, "."))
        .when(kind == 1, say("Rain of ", q, " inches fell on ", place, " by ", day, "."))
        .when(kind == 2, say("Hurricane ", name, " made landfall in ", place, " as a Category ", line.cast("string"),
                             " storm on ", day, "."))
        .when(kind == 3, say("An evacuation moved ", q, "00 people out of ", place, "."))
        .when(kind == 4, say("Officials reported ", q, " deaths after ", day, "."))
        .otherwise(say("The diameter of Tropical Storm ", name, " was ", q, "0 miles.")))
    return joined.select(F.col("r_name").alias("event_key"), sentence.alias("text"))


def bulletins(spark, sf) -> DataFrame:
    """(event_key, text): one sentence on losses, help and times per order, in six forms."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    joined = (orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
              .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    date, place, number = F.col("o_orderdate"), F.col("n_name"), F.col("o_orderkey")
    price, people = F.floor("o_totalprice").cast("string"), (number % 97 + 2).cast("string")
    day, until = F.dayofmonth(date), F.greatest(F.dayofmonth(date), F.least(F.dayofmonth(date) + 2, F.lit(28))).cast("string")
    month, year = F.date_format(date, "MMMM"), F.date_format(date, "yyyy")

    def say(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    kind = F.floor(number / 4) % 6
    sentence = (
        F.when(kind == 0, say("Damage of $", price, " was reported in ", place, " during ", month, " ", year, "."))
        .when(kind == 1, say(people, " people were injured in ", place, " on ", day.cast("string"), "-", until, " ", month, " ", year,
                             ", and damages reached $", people, ".5 million."))
        .when(kind == 2, say("The toll rose to two deaths and ", people, " injuries in ", year, "."))
        .when(kind == 3, say("The Red Cross opened a shelter in ", place, " with aid of ", people, " million dollars on ", month, " ",
                             day.cast("string"), ", ", year, "."))
        .when(kind == 4, say("Damages of ", people, " billion dollars and 1,", F.lpad(people, 3, "0"), " injuries were counted by ", month, "."))
        .otherwise(say("Power was restored after three hundred injuries, said John ", F.initcap(place), " of the Coast Guard.")))
    return joined.select(F.col("r_name").alias("event_key"), sentence.alias("text"))


def gazetteer(spark, sf) -> DataFrame:
    return table(spark, sf, "nation").select(F.lit("GPE").alias("type"), F.col("n_name").alias("text"))
