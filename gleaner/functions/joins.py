"""Lookup joins that broadcast only after a size check."""

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits(table: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most `limit` rows and `size` bytes of text; looks at no more rows than that."""
    width = F.octet_length(F.to_json(F.struct(*table.columns)))
    rows, total = table.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= limit and total <= size


def lookup_join(left: DataFrame, table: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a large table with a lookup table.

    A lookup table within `limit` rows is broadcast. A larger one is joined by shuffle, where adaptive execution splits
    the partition of a hot key on the left by its measured size; the result is the same.
    """
    on = [on] if isinstance(on, str) else list(on)
    if fits(table, limit):
        return left.join(F.broadcast(table), on, how)
    return left.join(table, on, how)
