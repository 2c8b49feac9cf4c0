"""Tables that cut lineage, written to the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenforge.sources.staging import removed, scratch_path, staged

__all__ = ["input_partitions", "offsets_by_part", "removed", "scratch_path", "table", "written"]


#: Bytes of rows that go to a Python worker at once. Spark's own 64 MB take several times that in both processes of a task.
BATCH_BYTES = 4 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def small_batches(spark: SparkSession) -> None:
    """Sets BATCH_BYTES for the session, unless it has a choice of its own."""
    if spark.conf.get(_BATCH_SETTING).rstrip("b") == str(_BATCH_DEFAULT):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read again; removed() deletes it when its last reader is done."""
    small_batches(df.sparkSession)
    return staged(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def input_partitions(df: DataFrame) -> int:
    """How many tasks read df; it follows the input's bytes and needs no job."""
    return df.rdd.getNumPartitions()


def offsets_by_part(counts: DataFrame, part: str, size: str, alias: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Running totals of `size` before each `part` (within `keys`). One row a partition file comes in, so the window is small."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    w = w.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(alias, F.coalesce(F.sum(size).over(w), F.lit(0)).cast("long"))
