"""Sources and sinks: page records, labelled datasets, summary files, vocabularies."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MIN_RECORD_LENGTH = 100

RECORD_SCHEMA = T.StructType([
    T.StructField("URL_s", T.StringType()),
    T.StructField("Timestamp_s", T.StringType()),
    T.StructField("Sentences_t", T.StringType()),
])

VOCABULARY_SCHEMA = T.StructType([
    T.StructField("feature_id", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("term", T.StringType()),
])


def read_records(spark: SparkSession, path: str, parts_only: bool = False) -> DataFrame:
    """Page records from a JSON-lines folder as (doc_id, url, ts, text); `parts_only` reads only part files."""
    reader = spark.read.schema(RECORD_SCHEMA)
    if parts_only:
        reader = reader.option("pathGlobFilter", "part-*.json")
    df = reader.json(path).select(F.col("URL_s").alias("url"), F.col("Timestamp_s").alias("ts"),
                                  F.col("Sentences_t").alias("text"))
    return with_id(long_records(df))


def with_id(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add a unique id when the table has none; stage the result when several jobs must see the same ids."""
    return df if key in df.columns else df.select(F.monotonically_increasing_id().alias(key), "*")


def long_records(df: DataFrame, text: str = "text", min_length: int = MIN_RECORD_LENGTH) -> DataFrame:
    """Keep records whose text has at least `min_length` characters; missing text is dropped."""
    return df.filter(F.length(text) >= min_length)


def labeled_records(df: DataFrame) -> DataFrame:
    """Classifier input: text renamed to `record`, missing optional columns as nulls, features as arrays."""
    optional = {"URL_s": "string", "record_id": "bigint"}
    for name, kind in optional.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    kept = [c for c in ("count_feature_set", "presence_feature_set", "feature_count", "preprocessed_record")
            if c in df.columns]
    return df.select("id", "record_id", "URL_s", F.col("Sentences_t").alias("record"), *kept,
                     F.col("label").cast("double").alias("label"))


def feature_dataset_schema(extra=()) -> T.StructType:
    """Schema of a saved feature dataset; `extra` lists (name, type) pairs, for example the label columns."""
    fields = [("id", "bigint"), ("record_id", "bigint"), ("URL_s", "string"), ("Sentences_t", "string"),
              ("preprocessed_record", "array<string>"), ("count_feature_set", "array<double>"),
              ("presence_feature_set", "array<double>")] + list(extra)
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields))


def read_labeled(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved, automatically labelled dataset as classifier input."""
    schema = feature_dataset_schema([("feature_count", "double"), ("label", "double")])
    return labeled_records(spark.read.schema(schema).json(path))


def read_summary_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files, one row per file, line breaks replaced by spaces."""
    text = F.regexp_replace(F.regexp_replace("value", r"\n$", ""), "\n", " ")
    return spark.read.text(path, wholetext=True).withColumn("value", text).withColumnRenamed("value", "text")


def write_json(df: DataFrame, path: str) -> None:
    """Save a dataset as JSON lines, replacing an older one."""
    df.write.mode("overwrite").json(path)


def write_small_json(df: DataFrame, path: str) -> None:
    """Save a table that its maker has aggregated to few rows (one exemplar per cluster) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def exemplar_path(dataset: str, k: int, method: str, feature_type: str, vocab_size: int) -> str:
    """Output name that records the parameters of a clustering."""
    return "_".join([dataset, str(k), method, feature_type, str(vocab_size)]) + "cluster_samples"


def write_clusters(clustered: DataFrame, path: str) -> None:
    """Save the rows in one folder per cluster, in one pass."""
    clustered.write.mode("overwrite").partitionBy("cluster").json(path)


def read_cluster(spark: SparkSession, path: str, schema: T.StructType, cluster: int) -> DataFrame:
    """The rows of one saved cluster; the other folders are not read."""
    return spark.read.schema(schema).json(path).filter(F.col("cluster") == cluster)


def write_vocabulary(labels: DataFrame, path: str) -> None:
    """Save a feature vocabulary for reuse by later runs."""
    labels.select("feature_id", "kind", "term").coalesce(1).write.mode("overwrite").json(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved feature vocabulary."""
    return spark.read.schema(VOCABULARY_SCHEMA).json(path)
