"""Where intermediate results are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only a session on one machine (tests) may leave it unset, where a folder under /tmp
    takes its place; a cluster's executors wouldn't find that again, so there it fails.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        context.setCheckpointDir(named or "/tmp/checkpoints")
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder and cut off from its lineage."""
    folder(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt out to tasks on all cores, for work that is long for short rows: of a file, a task reads whole row groups, and there may be one only."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def swept(spark: SparkSession) -> None:
    """Asks the driver to collect what nothing refers to any more, as the files of its shuffles go only then."""
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that nothing reads any more, on whatever file system it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
