"""Connected components of a table of links, by alternating star rounds that are written out one by one."""

from pyspark.sql import DataFrame, functions as F

from gleaner.sources.staging import stage


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or smaller) neighbours of each node, and the node, to its smallest neighbour or itself."""
    if larger:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    # Written, so that adaptive execution can split the join at the centre of a large star.
    least = stage(around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
    joined = around.join(least, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("m").alias("a"), "b")
    else:
        moved = joined.select(F.col("m").alias("a"), "b").union(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return moved.filter("a < b").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of edges(a, b): the smallest id that it is linked to, directly or through others.

    The number of rounds grows with the logarithm of the number of nodes. Null ends and loops are no links.
    """
    now = stage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    state = _state(now)
    while state[0]:
        after = stage(_stars(_stars(now, True), False), "links")
        was, state, now = state, _state(after), after
        if was == state:
            break
    return now.select(F.col("b").alias("id"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())
