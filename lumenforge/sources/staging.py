"""Stage outputs at rest: each stage's table is written once and read by the next, as a job at scale would."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only in local mode, where driver and executors are one, may it be unset: then a
    temporary folder is made and named there."""
    known = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="lumenforge-")
    spark.conf.set(SETTING, made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def at_once(spark: SparkSession, *tasks: Callable[[], object]) -> list:
    """The results of tasks that need nothing of each other, their jobs run side by side: small ones do not wait for a large one."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [t.result() for t in [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]]


def removed(*tables: DataFrame) -> None:
    """Deletes tables made by staged() that nothing will read again."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
