"""Sharding by sampled splitters: size-weighted key samples give quantile boundaries for range partitioning.

Ranges that still hold too much (one key with very many rows) are subdivided by a row number that was written with the
rows. Sizes are added up by range first, then inside each range, so each row knows its byte offset in key order, and
shard boundaries fall at equal shares of all bytes: shards differ by the size of one record at most. Whole records are
written once with their row number and shuffled once, to their ranges; `save` writes a folder of each shard.

Null text counts as empty, a null key sorts first. Rows with equal keys are ordered by checksum and size; rows that
equal each other in those too may swap slots. An empty table gives an empty result. All columns are kept; where the
table has a column `shard` or `slot`, the operator's own gets underscores appended (`names`).
"""

import math

from pyspark.sql import DataFrame, Window as W, functions as F

from gleaner.llm.names import free_name
from gleaner.sources.staging import stage

OVERHEAD = 16  # fixed value: bytes that each record takes besides its text


def _size_and_checksum(text: F.Column) -> list[F.Column]:
    whole = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    return [(F.octet_length(whole) + OVERHEAD).cast("long").alias("size"), F.crc32(whole).cast("long").alias("text_crc32")]


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, record) of each row; the record holds all its columns."""
    return docs.select(F.col(key).cast("long").alias("key"), *_size_and_checksum(F.col(text)), F.struct("*").alias("record"))


def splitters(rows: DataFrame, ranges: int, total: int, per_range: int = 32) -> list[int]:
    """At most `ranges` - 1 boundaries between keys, from a sample that takes a row in proportion to its size.

    The sample has about `ranges` x `per_range` rows; `ranges` grows with the table.
    """
    chance = F.col("size") * (ranges * per_range / max(total, 1))
    drawn = F.pmod(F.xxhash64("tie", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(drawn < chance).select(F.col("range_key"))
    shares = [k / ranges for k in range(1, ranges)]
    found = sample.agg(F.percentile_approx("range_key", shares, 100 * ranges).alias("at")).first()["at"] if shares else []
    return sorted(set(found or []))


def range_of(column: str, bounds: list[int]) -> F.Column:
    """Number of boundaries that are not above the value, by binary search over one literal array."""
    if not bounds:
        return F.lit(0)
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]
    at = "array(" + ", ".join(f"{b}L" if b != -(1 << 63) else "bigint('-9223372036854775808')" for b in bounds) + ")"
    found = (f"aggregate(array({', '.join(map(str, steps))}), 0, (n, s) -> "
             f"if(coalesce(get({at}, n + s - 1) <= `{column}`, false), n + s, n))")
    return F.expr(found)


def names(docs: DataFrame) -> tuple[str, str]:
    """The columns of shard and slot that `place` adds to a table."""
    return free_name("shard", docs.columns), free_name("slot", docs.columns)


def place(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", rows_per_range: int = 1_000_000,
          overfull: float = 2.0, bytes_per_range: int = 128 * 1024 * 1024) -> DataFrame:
    """The whole records with their shard and slot, in the partitions of their ranges.

    Shard s holds the records whose first byte, in key order, is in the s-th of `shards` equal parts of all bytes.
    """
    lowest = F.lit(-(1 << 63))
    rows = stage(sized(docs, key, text).withColumn("tie", F.monotonically_increasing_id())
                 .withColumn("range_key", F.coalesce("key", lowest)), "sized")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(shards, math.ceil(n / rows_per_range), math.ceil(total / bytes_per_range))
    bounds = splitters(rows, ranges, total)
    ranged = rows.withColumn("range", range_of("range_key", bounds))

    # A range with more than its share is cut into pieces of about one share by a hash of the written row number, so
    # that no piece depends on the number of equal keys.
    loads = ranged.groupBy("range").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("rows"))
    parts = F.greatest(F.ceil(F.col("load") * ranges / max(total, 1)), F.ceil(F.col("rows") / rows_per_range))
    full = (F.col("load") * ranges > overfull * total) | (F.col("rows") > overfull * rows_per_range)
    pieces = loads.select("range", F.when(full, parts).otherwise(1).cast("int").alias("pieces"))
    # One row per range, at most `ranges` of them.
    split = (ranged.join(F.broadcast(pieces), "range")
             .withColumn("piece", F.pmod(F.xxhash64("tie"), F.col("pieces")).cast("int")))
    totals = split.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))
    before = W.orderBy("range", "piece").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("range", "piece", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                           F.coalesce(F.sum("records").over(before), F.lit(0)).alias("records_before"))
    inside = W.partitionBy("range", "piece").orderBy("range_key", "text_crc32", "size", "tie")
    offset = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    placed = split.select("*", offset.alias("offset"), (F.row_number().over(inside) - 1).alias("rank"))
    placed = placed.join(F.broadcast(starts), ["range", "piece"]).select(
        "record", F.least(F.floor((F.col("bytes_before") + F.col("offset")) / F.lit(max(total, 1) / shards)),
                          F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("records_before") + F.col("rank")).alias("rank"))
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard, from the narrow columns alone
    kept = [F.col("record")[c].alias(c) for c in docs.columns]
    shard_name, slot_name = names(docs)
    return placed.join(F.broadcast(first), "shard").select(
        *kept, F.col("shard").alias(shard_name), (F.col("rank") - F.col("first")).cast("long").alias(slot_name))


def shard(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", rows_per_range: int = 1_000_000,
          overfull: float = 2.0, bytes_per_range: int = 128 * 1024 * 1024) -> DataFrame:
    """Digests of the placed records: key, size, text_crc32, shard, slot."""
    shard_name, slot_name = names(docs)
    return place(docs, shards, key, text, rows_per_range, overfull, bytes_per_range).select(
        F.col(key).cast("long").alias(key), *_size_and_checksum(F.col(text)),
        F.col(shard_name).alias("shard"), F.col(slot_name).alias("slot"))


def save(placed: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Write the records, one folder for each shard, in order of slot within each file; see `names` for the columns."""
    placed.sortWithinPartitions(shard, slot).write.mode("overwrite").partitionBy(shard).parquet(path)
