"""Clusters and topics on Spark ML, with distances, exemplars and sizes."""

from contextlib import ExitStack

from pyspark.ml.clustering import LDA, BisectingKMeans, KMeans
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleaner.functions import text as tx
from gleaner.functions.numbering import numbered
from gleaner.operators import weights
from gleaner.operators.topics import sweep
from gleaner.sources.staging import new_path, scratch, stage

FEATURE_TYPES = ("count", "tfidf")
METHODS = ("kmeans", "bisecting", "lda")
HEAD, LONGEST = 100_000, 64  # words that are looked up by broadcast, and their longest in bytes


def _min_df(df: DataFrame, share: float) -> int:
    return int(df.count() * share)


def count_vocabulary(records: DataFrame, vocab_size: int = 10_000, min_share: float = 0.1) -> DataFrame:
    """The words a count vectorizer keeps: (term, n, df), by frequency."""
    lists = records.select(tx.words("text", lowercase=False).alias("lemmas"))
    floor = F.greatest(F.lit(1), (F.col("size") * F.lit(min_share)).cast("bigint"))
    kept = weights.with_totals(weights.term_stats(lists)).filter(F.col("df") >= floor)
    return weights.top(kept.select(F.col("lemma").alias("term"), "n", "df"), "n", "term", vocab_size)


def doc_terms(lists: DataFrame, column: str = "lemmas", key: str = "doc_id", write=stage) -> DataFrame:
    """(key, lemma, n), written out: the words of each record with their counts, and a row without lemma for the record itself."""
    none = F.array(F.lit(None).cast("string"))
    words = F.explode(F.concat(none, F.coalesce(F.col(column), F.array().cast("array<string>"))))
    # Whole lists travel to their key's partition, which also holds all of the key's words: one shuffle, of the lists.
    dealt = lists.select(key, column).repartition(key)
    return write(dealt.select(key, words.alias("lemma")).groupBy(key, "lemma").agg(F.count(F.lit(1)).alias("n")), "doc-terms")


def term_numbers(terms: DataFrame, limit: int = None, min_share: float = None) -> DataFrame:
    """(lemma, n, df, number): the words of `doc_terms` in order of frequency, numbered from 0.

    The numbers come from sorted ranges, so the list is never in one place. `min_share` is the share of the records that a
    word must be in, `limit` the length of the list.
    """
    counts = (terms.filter("lemma IS NOT NULL").groupBy("lemma")
              .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("df")))
    if min_share is not None:
        records = terms.filter("lemma IS NULL").agg(F.count(F.lit(1))).scalar()
        counts = counts.filter(F.col("df") >= F.greatest(F.lit(1), (records * F.lit(min_share)).cast("bigint")))
    if limit is not None:
        counts = weights.top(counts, "n", "lemma", limit)
    return stage(numbered(counts, F.desc("n"), F.asc("lemma")), "terms")


def sparse_vectors(terms: DataFrame, numbers: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, features): the counts of each record as a sparse vector along the numbers, written out.

    The `HEAD` most frequent words, most of all rows, are looked up where the rows lie; only rows of other words meet their numbers
    in a join by shuffle. Entries travel as one number, packed by record in each task.
    """
    size = numbers.count()
    # A word of any length may be in the list, so long ones are left to the shuffle.
    common = (F.col("number") < HEAD) & (F.octet_length("lemma") <= LONGEST)
    words = numbers.select("lemma", "number")
    found = terms.join(F.broadcast(words.filter(common)), "lemma", "left")
    rows = found.filter("number IS NOT NULL OR lemma IS NULL").select(key, "number", "n")
    rare = words.filter(~common)
    if not rare.isEmpty():
        others = found.filter("number IS NULL AND lemma IS NOT NULL").select(key, "lemma", "n")
        rows = rows.unionByName(others.join(rare, "lemma").select(key, "number", "n"))
    entry = F.shiftleft("number", 32).bitwiseOR(F.col("n"))  # null for the row of the record itself
    rows = rows.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))  # the words of one record
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(max(1, size)).alias("size"),
                      F.transform("_entries", lambda e: F.shiftright(e, 32).cast("int")).alias("indices"),
                      F.transform("_entries", lambda e: e.bitwiseAND(F.lit((1 << 32) - 1)).cast("double")).alias("values"))
    path = new_path(terms.sparkSession, "vectors")
    rows.select(key, vector.alias("features")).write.parquet(path)
    # The struct is how Spark stores a vector, so it is read back as one.
    schema = T.StructType([terms.schema[key], T.StructField("features", VectorUDT())])
    return terms.sparkSession.read.schema(schema).parquet(path)


def count_vectors(records: DataFrame, vocab_size: int = 10_000, min_share: float = 0.1, key: str = "doc_id"):
    """Bag-of-words vectors (key, features), and their words (lemma, n, df, number)."""
    terms = doc_terms(records.select(key, tx.words("text", lowercase=False).alias("lemmas")), key=key)
    numbers = term_numbers(terms, vocab_size, min_share)
    return sparse_vectors(terms, numbers, key), numbers


def _vectorize(df, column, vocab_size, min_df, key="doc_id"):
    terms = doc_terms(df, column, key)
    numbers = term_numbers(terms, vocab_size)
    numbers = numbers if min_df <= 1 else stage(numbered(numbers.drop("number").filter(F.col("df") >= min_df), F.desc("n"), "lemma"), "terms")
    return sparse_vectors(terms, numbers, key), numbers


def hashed_tfidf(records: DataFrame, num_features: int = 10_000, min_share: float = 0.1) -> DataFrame:
    """Hashed TF-IDF vectors of white-space tokens in `features`."""
    words = Tokenizer(inputCol="text", outputCol="words").transform(records)
    tf = HashingTF(numFeatures=num_features, inputCol="words", outputCol="tf").transform(words)
    model = IDF(inputCol="tf", outputCol="features", minDocFreq=_min_df(records, min_share)).fit(tf)
    return model.transform(tf).drop("words", "tf")


def compute_features(records: DataFrame, feature_type: str = "count", size: int = 10_000) -> DataFrame:
    """Vectors for clustering: 'count' (with the key alone) or 'tfidf'."""
    if feature_type == "count":
        return count_vectors(records, size)[0]
    if feature_type == "tfidf":
        return hashed_tfidf(records, size)
    raise ValueError(f"feature type must be one of {FEATURE_TYPES}")


def _own_distance(features: Column, centre: Column, centre_norm: Column) -> Column:
    # |x - c|^2 = |c|^2 + sum over the stored entries of x of x_i^2 - 2 x_i c_i, so sparse vectors stay sparse.
    parts = F.unwrap_udt(features)
    values = parts["values"]
    picked = F.when(parts["indices"].isNull(), centre).otherwise(
        F.transform(parts["indices"], lambda i: F.get(centre, i)))
    terms = F.zip_with(values, picked, lambda v, c: v * v - 2.0 * v * c)
    return F.greatest(F.lit(0.0), centre_norm + F.aggregate(terms, F.lit(0.0), lambda s, t: s + t))


def _with_distance(clustered: DataFrame, centres) -> DataFrame:
    rows = [(i, [float(v) for v in c], float((c * c).sum())) for i, c in enumerate(centres)]  # k rows
    table = clustered.sparkSession.createDataFrame(rows, "cluster int, _centre array<double>, _norm double")
    joined = clustered.join(F.broadcast(table), "cluster")
    return (joined.withColumn("distance", _own_distance(F.col("features"), F.col("_centre"), F.col("_norm")))
            .drop("_centre", "_norm"))


def _fit(estimator, vectors):
    rows = vectors.select("features").persist()
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def kmeans(vectors: DataFrame, k: int = 5, seed: int = 7, max_iter: int = 20):
    """K-means: rows with `cluster` and the squared `distance` to the own centre; and the model (cost, sizes)."""
    model = _fit(KMeans(k=k, featuresCol="features", predictionCol="cluster", seed=seed, maxIter=max_iter), vectors)
    return _with_distance(model.transform(vectors), model.clusterCenters()), model


def bisecting_kmeans(vectors: DataFrame, k: int = 5, seed: int = 7, max_iter: int = 20):
    """Bisecting k-means, same columns as `kmeans`."""
    estimator = BisectingKMeans(k=k, featuresCol="features", predictionCol="cluster", seed=seed, maxIter=max_iter)
    model = _fit(estimator, vectors)
    return _with_distance(model.transform(vectors), model.clusterCenters()), model


def lda(vectors: DataFrame, k: int = 5, seed: int = 7, max_iter: int = 20):
    """Topic clusters: rows with the strongest topic as `cluster` and its share as `closeness`; and the model."""
    from pyspark.ml.functions import vector_to_array
    estimator = LDA(k=k, featuresCol="features", topicDistributionCol="topics", seed=seed, maxIter=max_iter)
    model = _fit(estimator, vectors)
    shares = model.transform(vectors).withColumn("topics", vector_to_array("topics"))
    best = shares.withColumn("closeness", F.array_max("topics"))
    return best.withColumn("cluster", (F.array_position("topics", F.col("closeness")) - 1).cast("int")
                           ).drop("topics"), model


def log_perplexity(model, vectors: DataFrame) -> float:
    """Log perplexity bound of a topic model."""
    return model.logPerplexity(vectors)


def do_cluster(vectors: DataFrame, method: str = "kmeans", k: int = 5, seed: int = 7):
    """Cluster by 'kmeans', 'bisecting' or 'lda'."""
    methods = {"kmeans": kmeans, "bisecting": bisecting_kmeans, "lda": lda}
    if method not in methods:
        raise ValueError(f"method must be one of {METHODS}")
    return methods[method](vectors, k, seed)


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    """Rows of each cluster: (cluster, size)."""
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def cluster_size_stats(sizes: DataFrame, k: int = None) -> DataFrame:
    """Least, median, interquartile range and largest of cluster sizes, one row; `k` adds the empty clusters."""
    if k is not None:
        every = sizes.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
        sizes = every.join(sizes, "cluster", "left").select("cluster", F.coalesce("size", F.lit(0)).alias("size"))
    cuts = sizes.agg(F.min("size").alias("min"), F.percentile("size", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
                     .alias("cuts"), F.max("size").alias("max"))
    return cuts.select("min", F.col("cuts")[1].alias("median"), (F.col("cuts")[2] - F.col("cuts")[0]).alias("iqr"),
                       "max")


def exemplars(clustered: DataFrame, method: str = "kmeans", key: str = "doc_id") -> DataFrame:
    """The most typical row of each cluster: least distance, or largest closeness for topics; ties by key.

    Only key and score are aggregated; the k rows are then picked by a semi-join.
    """
    score = -F.col("closeness") if method == "lda" else F.col("distance")
    chosen = (clustered.groupBy("cluster").agg(F.min(F.struct(score.alias("score"), F.col(key).alias("key")))
                                               .getField("key").alias(key)).select("cluster", key))
    return clustered.join(chosen, ["cluster", key], "left_semi")


def topics(model, numbers: DataFrame, num_words: int = 2) -> DataFrame:
    """Strongest words of each topic: (topic, rank, term, weight), from the words' numbers(lemma, number)."""
    described = model.describeTopics(num_words)  # k x num_words entries
    rows = described.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "entry"))
    rows = rows.select("topic", "rank", F.col("entry.termIndices").cast("bigint").alias("number"),
                       F.col("entry.termWeights").alias("weight"))
    return (numbers.select("number", F.col("lemma").alias("term")).join(F.broadcast(rows), "number")
            .select("topic", "rank", "term", "weight"))


def topic_sweep(lists: DataFrame, ks=(10, 9, 8, 7, 6), num_words: int = 2, vocab_size: int = None, passes: int = 20,
                seed: int = 7, key: str = "doc_id") -> DataFrame:
    """Topic models for several k on lemma lists: (k, topic, rank, term, weight); without `vocab_size` on all lemmas.

    Fitted by expectation-maximisation on blocks of records, several models in the same passes: neither the words nor the topics'
    weights come to the driver, only the strongest `num_words` of each topic. The words of the records are deleted when they
    are in the blocks.
    """
    spark = lists.sparkSession
    with scratch(spark), ExitStack() as read:
        terms = doc_terms(lists, key=key, write=read.enter_context(scratch(spark)))
        numbers = term_numbers(terms, vocab_size)
        found = sweep(terms, numbers, ks, num_words, passes, seed, key, packed=read.close)
    return (numbers.select("number", F.col("lemma").alias("term")).join(F.broadcast(found), "number")
            .select("k", "topic", "rank", "term", "weight"))
