"""From documents to packed sequences: five stages, each written as Parquet and read again by the next one."""

from pyspark.sql import DataFrame, functions as F

from gleaner.llm import lines, ngram_join, packing, quality, substring
from gleaner.llm.queries import WORD_BPE
from gleaner.sources.staging import stage


def _as_documents(edited: DataFrame, docs: DataFrame) -> DataFrame:
    # The columns of documents; the length of an edited text is counted anew.
    count = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in docs.columns else None
    return edited.select(*[count if c == "n_chars" else F.col(c) for c in docs.columns])


def quality_rules(spark, docs, sf_dir):
    """Documents whose posterior quality and base counts pass."""
    return quality.keep(docs)


def line_dedup(spark, docs, sf_dir):
    """Texts without the lines that later three-line windows cover."""
    return _as_documents(lines.dedup_lines(docs), docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of similar ones."""
    return ngram_join.one_of_each(docs)


def substring_dedup(spark, docs, sf_dir):
    """Texts without passages that occur earlier."""
    return _as_documents(substring.dedup(docs), docs)


def pack(spark, docs, sf_dir):
    """Sequences of binary length."""
    return packing.pack(docs, WORD_BPE)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("substring dedup", substring_dedup), ("packing", pack)]

#: SQL can't express the expectation-maximisation, the substring units or the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents; the result of each is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
