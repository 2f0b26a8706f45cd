"""Packing by power-of-two decomposition: each document is cut into pieces of binary lengths, and each piece is a sequence.

The pieces of a document of n ids are full sequences of the longest length, then one piece for each bit of the rest,
longest first. A sequence never crosses documents and has no padding; equal lengths share a bucket, which `save` writes
as a folder of its own.

Null text counts as empty: a document without words is the end id alone. A null id is kept, equal rows are packed one
by one, very long texts give more full sequences, an empty table gives an empty result; other columns are not read.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.merges import packed
from gleaner.llm.tokens import chunks, encoder

SCHEMA = "key bigint, start bigint, length bigint, ids binary, doc_tokens bigint"


def lengths(n: int, longest: int) -> Iterator[int]:
    """Binary lengths that add up to n, none above `longest`, a power of two."""
    yield from [longest] * (n // longest)
    rest = n % longest
    while rest:
        yield (piece := 1 << (rest.bit_length() - 1))
        rest -= piece


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", longest: int = 4096,
           end: int = 2) -> DataFrame:
    """Rows (key, start, length, ids as packed little-endian 32-bit integers, doc_tokens) of every document."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches):
        last = packed([end])
        for batch in batches:
            keys, at = batch.column(0).to_pylist(), 0
            for held in chunks(x.as_py() for x in batch.column(1)):
                out = [[], [], [], [], []]
                for ids in encoder(tokenizer).encode_all(held):
                    ids, start, total = ids + last, 0, len(ids) // 4 + 1
                    for length in lengths(total, longest):
                        row = (keys[at], start, length, ids[4 * start:4 * (start + length)], total)
                        for column, value in zip(out, row):
                            column.append(value)
                        start += length
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                    names=["key", "start", "length", "ids", "doc_tokens"])
    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", longest: int = 4096,
         end: int = 2) -> DataFrame:
    """`pieces` with the number of the sequence that each one fills, its offset there, and its bucket.

    One scan without a shuffle. Sequence numbers are unique, not gapless.
    """
    found = pieces(docs, tokenizer, key, text, longest, end)
    return found.select(F.col("key").alias(key), "start", "length", "ids", "doc_tokens",
                        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                        F.log2("length").cast("int").alias("bucket"))


def save(packed_docs: DataFrame, path: str) -> None:
    """Write the sequences, one folder for each length."""
    packed_docs.write.mode("overwrite").partitionBy("bucket").parquet(path)
