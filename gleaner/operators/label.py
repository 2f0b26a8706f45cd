"""Weak labels from feature counts and phrases, and repeatable samples of labelled rows."""

from pyspark.sql import DataFrame, functions as F

from gleaner.functions import vocab
from gleaner.functions.sampling import uniform


def with_feature_count(features: DataFrame) -> DataFrame:
    """Add `feature_count`, the number of features present."""
    total = F.aggregate("presence_feature_set", F.lit(0.0), lambda a, x: a + x)
    return features.withColumn("feature_count", total)


def feature_stats(counted: DataFrame) -> DataFrame:
    """Mean and population standard deviation of the feature counts, one row."""
    return counted.agg(F.avg("feature_count").alias("mean"), F.stddev_pop("feature_count").alias("sd"))


def auto_label(counted: DataFrame, irrelevant_t: float = 2.0, relevant_t: float = 2.0) -> DataFrame:
    """Label 1.0 above mean + relevant_t * sd, else 0.0 below irrelevant_t, else -1.0."""
    stats = counted.agg(F.struct(F.avg("feature_count").alias("mean"),
                                 F.stddev_pop("feature_count").alias("sd"))).scalar()
    limit = stats["mean"] + F.lit(relevant_t) * stats["sd"]
    return counted.withColumn("label", F.when(F.col("feature_count") > limit, 1.0)
                              .when(F.col("feature_count") < irrelevant_t, 0.0).otherwise(-1.0))


def require_phrase(labeled: DataFrame, phrase: str, text: str = "text") -> DataFrame:
    """Label 0.0 for records without the phrase, in any letter case."""
    lacks = ~F.contains(F.lower(text), F.lit(phrase.lower()))
    return labeled.withColumn("label", F.when(lacks, 0.0).otherwise(F.col("label")))


def reject_boilerplate(labeled: DataFrame, boilerplate=None, shortest: int = 20, longest: int = 400,
                       text: str = "text") -> DataFrame:
    """Label 0.0 for sentences with a boilerplate token or an unusual length; adds `filtered`."""
    lowered = F.lower(text)
    bad = (F.length(lowered) < shortest) | (F.length(lowered) > longest)
    for token in vocab.BOILERPLATE if boilerplate is None else boilerplate:
        bad = bad | F.contains(lowered, F.lit(token))
    return (labeled.withColumn("label", F.when(bad, 0.0).otherwise(F.col("label")))
            .withColumn("filtered", F.lit(True)))


def augment_labels(labeled: DataFrame, contains_sentences: bool, phrase: str = None, boilerplate=None) -> DataFrame:
    """The rule for sentences or the rule for records."""
    if contains_sentences:
        return reject_boilerplate(labeled, boilerplate)
    return require_phrase(labeled, phrase)


def label_stats(labeled: DataFrame) -> DataFrame:
    """Positive, negative and all rows, one row."""
    return labeled.agg(F.count_if(F.col("label") == 1.0).alias("positive"),
                       F.count_if(F.col("label") == 0.0).alias("negative"), F.count(F.lit(1)).alias("total"))


def train_test_split(labeled: DataFrame, key: str = "doc_id", train: float = 0.7) -> DataFrame:
    """Rows labelled 0.0 or 1.0 with a `part` column ('train' or 'test'), drawn by key."""
    chosen = labeled.filter(F.col("label").isin(0.0, 1.0))
    return chosen.withColumn("part", F.when(uniform(F.col(key)) < train, "train").otherwise("test"))


def undersample(split: DataFrame, key: str = "doc_id") -> DataFrame:
    """Move surplus training rows of the larger class to the test part, drawn by key with probability 1 - min/max."""
    in_train = F.col("part") == "train"
    sizes = split.agg(F.struct(F.count_if(in_train & (F.col("label") == 1.0)).alias("positive"),
                               F.count_if(in_train & (F.col("label") == 0.0)).alias("negative"))).scalar()
    larger = F.when(sizes["positive"] > sizes["negative"], 1.0).otherwise(0.0)
    ratio = F.least(sizes["positive"], sizes["negative"]) / F.greatest(sizes["positive"], sizes["negative"], F.lit(1))
    surplus = in_train & (F.col("label") == larger) & (uniform(F.col(key), "undersample") >= ratio)
    return split.withColumn("part", F.when(surplus, "test").otherwise(F.col("part")))
