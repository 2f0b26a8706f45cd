"""Repeatable random numbers from row keys."""

from pyspark.sql import Column, functions as F


def uniform(key: Column, seed: str = "") -> Column:
    """A number in [0, 1) fixed by the key and seed, so a recomputed task draws the same rows."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def poisson_digits(key: Column, block: Column) -> Column:
    """Four times eight hex digits fixed by key and block number, as an array, from one MD5."""
    digest = F.md5(F.concat(key.cast("string"), F.lit("/"), block.cast("string")))
    return F.array(*[F.substring(digest, 8 * i + 1, 8) for i in range(4)])


def poisson(digits: Column) -> Column:
    """The Poisson(1) draw of eight hex digits.

    Fixed-width hex compares like the number it spells, so a draw is the count of cumulative thresholds passed. Few draws pass
    many, so the first threshold not passed ends the search.
    """
    draw = F.when(digits < POISSON_THRESHOLDS[0], 0)
    for n, threshold in enumerate(POISSON_THRESHOLDS[1:], start=1):
        draw = draw.when(digits < threshold, n)
    return draw.when(digits.isNotNull(), len(POISSON_THRESHOLDS)).otherwise(0)


def _thresholds(limit: int = 12):
    total, term, out = 0.0, 2.718281828459045 ** -1, []
    for n in range(1, limit + 1):
        total += term
        term /= n
        cut = round(total * 4294967296)
        if cut < 4294967296:
            out.append(f"{cut:08x}")
    return out


POISSON_THRESHOLDS = _thresholds()
