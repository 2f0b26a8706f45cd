"""Gap-free numbers along an order, without bringing the rows together."""

from pyspark.sql import DataFrame, Window, functions as F

from gleaner.sources.staging import stage


def numbered(df: DataFrame, *order, name: str = "number") -> DataFrame:
    """Adds `name`, the place of each row from 0 in the order given (columns or sort expressions), and writes the rows out.

    Sorted ranges of rows are numbered inside each partition; the offsets come from one count per partition.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(ordered.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_id", 33).cast("int"), F.col("_id").bitwiseAND((1 << 33) - 1)
    rows = rows.withColumns({"_part": part, "_place": place})
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("size"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_offset"))
    return (rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_place"))
            .select(*df.columns, name))
