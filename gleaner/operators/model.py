"""Relevance classifier on presence features, its evaluation, and separation of relevant records."""

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

# Sizes of the hidden layers, and the columns dropped when relevant records are saved.
HIDDEN_LAYERS = (100, 50, 10)
NOT_SAVED = ["count_feature_set", "feature_count", "label", "presence_feature_set", "record", "features"]


def with_vectors(features: DataFrame, column: str = "presence_feature_set") -> DataFrame:
    """Add the feature array as an ML vector in `features`."""
    return features.withColumn("features", array_to_vector(F.col(column)))


def train_model(train: DataFrame, num_features: int, hidden=HIDDEN_LAYERS, max_iter: int = 100, block_size: int = 128,
                seed: int = 7):
    """Fit a multilayer perceptron [features, *hidden, 2] on rows with `features` and `label`."""
    classifier = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", predictionCol="prediction", layers=[num_features, *hidden, 2],
        maxIter=max_iter, blockSize=block_size, seed=seed)
    rows = train.select("features", "label").persist()
    try:
        return classifier.fit(rows)
    finally:
        rows.unpersist()


def predict_unlabeled(dataset: DataFrame, model) -> DataFrame:
    """Predictions for the rows labelled -1.0."""
    return model.transform(dataset.filter(F.col("label") == -1.0)).drop("rawPrediction", "probability")


def merge_predictions(dataset: DataFrame, predicted: DataFrame) -> DataFrame:
    """Labelled rows and predicted rows together, the prediction as label."""
    labeled = dataset.filter(F.col("label").isin(0.0, 1.0))
    guessed = predicted.drop("label").withColumnRenamed("prediction", "label")
    return labeled.unionByName(guessed, allowMissingColumns=True)


def relevant(merged: DataFrame) -> DataFrame:
    """Rows labelled relevant."""
    return merged.filter(F.col("label") == 1.0)


def irrelevant(merged: DataFrame) -> DataFrame:
    """Rows labelled irrelevant."""
    return merged.filter(F.col("label") == 0.0)


def accuracy(predicted: DataFrame) -> DataFrame:
    """Right predictions, all rows and their ratio, one row."""
    right = F.count_if(F.col("prediction") == F.col("label"))
    total = F.count(F.lit(1))
    return predicted.agg(right.alias("correct"), total.alias("total"), (right / total).alias("accuracy"))


def prediction_profile(merged: DataFrame) -> DataFrame:
    """Mean, least and largest feature count of each class: (label, mean, min, max)."""
    return merged.groupBy("label").agg(F.avg("feature_count").alias("mean"), F.min("feature_count").alias("min"),
                                       F.max("feature_count").alias("max"))


def chi2_scores(items: DataFrame, label: str = "prediction", item: str = "lemmas") -> DataFrame:
    """Chi-squared of the presence of each item against a 0/1 label: (item, df, chi2).

    Rows hold an array of items; one explode and one aggregate give every 2 x 2 table. As in any chi-squared test, an
    item in all rows or a constant label gives 0.
    """
    sizes = items.agg(F.struct(F.count(F.lit(1)).alias("n"),
                               F.count_if(F.col(label) == 1.0).alias("positive"))).scalar()
    cells = (items.select(label, F.explode(F.array_distinct(item)).alias("item")).groupBy("item")
             .agg(F.count(F.lit(1)).alias("df"), F.count_if(F.col(label) == 1.0).alias("a")))
    n, positive = sizes["n"].cast("double"), sizes["positive"].cast("double")
    a, b = F.col("a").cast("double"), (F.col("df") - F.col("a")).cast("double")
    c, d = positive - a, n - positive - b
    product = (a + b) * (c + d) * (a + c) * (b + d)
    chi2 = F.when(product == 0, 0.0).otherwise(n * F.pow(a * d - b * c, 2) / product)
    return cells.select("item", "df", F.round(chi2, 6).alias("chi2"))


def top_chi2(scores: DataFrame, k: int = 50) -> DataFrame:
    """The k items that tell the classes apart best, ties in order of the item."""
    return scores.orderBy(F.desc("chi2"), "item").limit(k)


def select_features(predicted: DataFrame, labels: DataFrame, k: int = 50) -> DataFrame:
    """Chi-squared selection on the feature vectors, named from the vocabulary: (feature_id, kind, term)."""
    rows = with_vectors(predicted).select("features", "prediction")
    selector = UnivariateFeatureSelector(featuresCol="features", labelCol="prediction", outputCol="selected",
                                         selectionMode="numTopFeatures")
    selector = selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(k)
    chosen = selector.fit(rows).selectedFeatures
    return labels.filter(F.col("feature_id").isin(*chosen))


def saved_columns(merged: DataFrame) -> DataFrame:
    """The columns kept when relevant records are saved; the text goes back to its source name."""
    return merged.withColumn("Sentences_t", F.col("record")).drop(*NOT_SAVED)
