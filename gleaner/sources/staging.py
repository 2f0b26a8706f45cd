"""Written intermediate tables: they cut lineage and survive the loss of executors."""

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; beside the tables of the warehouse where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_staging"
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the staging folder."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table to the staging folder as Parquet and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """Where the list of staged tables ends now, for a later `release`."""
    return len(_made)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete what was staged after `since = mark()`; called by whoever has read the result that depends on it."""
    for path in _made[since:]:
        _delete(spark, path)
    del _made[since:]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A `stage` for the steps of one operator: its tables are deleted when the block ends.

    Inside the block the shuffle files of a finished query are deleted too, as what it wrote is all that later steps read.
    What outlives the block is written with the plain `stage`.
    """
    made, before = [], spark.conf.get(FREE_SHUFFLES, None)

    def keep(df: DataFrame, name: str = "scratch", **options) -> DataFrame:
        path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
        made.append(path)
        df.write.options(**options).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield keep
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
        for path in made:
            _delete(spark, path)
