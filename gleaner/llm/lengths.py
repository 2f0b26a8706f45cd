"""Token counts by an exact length histogram: suffix sums answer totals, quantiles and truncated totals for every limit.

Null text counts as empty, of length 0. Equal rows count one by one, ids are not looked at; an empty table gives an empty
result. Only the text is read.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from gleaner.llm.tokens import chunks, encoder

BLOCK = 4096


def encoded_lengths(docs: DataFrame, tokenizer: str, text: str = "text", kept: tuple[str, ...] = ()) -> DataFrame:
    """The columns `kept` and n_tokens, the number of ids of the whole text."""
    def run(batches):
        for batch in batches:
            counts = [len(ids) // 4 for held in chunks(x.as_py() for x in batch.column(0)) for ids in encoder(tokenizer).encode_all(held)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(counts, pa.int64())],
                                             names=[*kept, "n_tokens"])
    source = docs.select(F.col(text).alias("text"), *kept)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:])
    return source.mapInArrow(run, ", ".join(filter(None, [types, "n_tokens bigint"])))


def histogram(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n_tokens, n_docs): the number of rows of each length."""
    return rows.groupBy(*by, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The histogram with what holds at a context limit of n_tokens, as long columns.

    docs_over and tokens_over: documents of at least this length and their ids; docs_under: shorter ones; total_docs and
    total_tokens: all; truncated_tokens: the ids left when each document is cut at this limit. The lengths are added up
    by block of BLOCK lengths first, so no window holds more than BLOCK rows, or one row per block.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", tokens)
    blocks = rows.groupBy(*by, "block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = W.partitionBy(*by).orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(*by)
    ends = blocks.select(*by, "block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
                         F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
                         F.sum("d").over(every).alias("total_docs"), F.sum("t").over(every).alias("total_tokens"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in (*by, "block")]
    joined = rows.alias("r").join(ends.alias("e"), same).select("r.*", "d_above", "t_above", "total_docs", "total_tokens")
    inside = W.partitionBy(*by, "block").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, 0)
    summed = joined.withColumns({"docs_over": F.sum("n_docs").over(inside) + F.col("d_above"),
                                 "tokens_over": F.sum("tokens").over(inside) + F.col("t_above")})
    return summed.select(
        *by, "n_tokens", "n_docs", "docs_over", "tokens_over", (F.col("total_docs") - F.col("docs_over")).alias("docs_under"),
        "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("truncated_tokens"))


def quantile(sums: DataFrame, share: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n_tokens): the smallest length that at least `share` of the documents do not exceed."""
    reached = F.col("docs_under") + F.col("n_docs") >= F.lit(share) * F.col("total_docs")
    return sums.filter(reached).groupBy(*by).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(sums: DataFrame, limit: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, tokens): ids left when each document is cut at `limit`, which need not be a length that occurs."""
    over = F.coalesce(F.sum(F.when(F.col("n_tokens") >= limit, F.col("n_docs") * limit)), F.lit(0))
    under = F.coalesce(F.sum(F.when(F.col("n_tokens") < limit, F.col("n_docs") * F.col("n_tokens"))), F.lit(0))
    return sums.groupBy(*by).agg((over + under).alias("tokens"))
