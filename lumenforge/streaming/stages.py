"""The row-wise stages on a stream of new files: they keep no state, so every row is written once as it comes."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lumenforge.operators.gaia import gaia_stage


def stream_gaia(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, mag_limit: float | None = None):
    """Runs the Gaia stage over the Parquet files that are there and returns the query; new files are taken up by the next call."""
    rows = gaia_stage(spark.readStream.schema(schema).parquet(source), mag_limit)
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
