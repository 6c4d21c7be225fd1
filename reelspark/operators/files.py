"""Files by a listing: which of the files that rows name are there, on whatever file system.

A listing is a table, read in parallel through the engine's file system interface
without opening a file; rows meet it in an equi-join on the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal(path: Column, folder: str | None = None) -> Column:
    """A path as a listing has it: a local one without its scheme, a relative one under folder, slashes not repeated."""
    bare = F.regexp_replace(path, r"^file:/*", "/")
    under = F.when(bare.rlike(r"^(/|[A-Za-z][A-Za-z0-9+.-]*://)"), bare).otherwise(F.concat(F.lit((folder or "").rstrip("/") + "/"), bare)) if folder else bare
    local = F.regexp_replace(under, r"^file:/*", "/")
    return F.regexp_replace(F.regexp_replace(local, r"(?<!:)/{2,}", "/"), r"(?<=[^/:])/(\./)+", "/")


def listing(spark: SparkSession, *folders: str) -> DataFrame:
    """(path, size) of all files with bytes in them under folders; empty files, and those whose names begin with _ or ., aren't listed."""
    none = T.StructType([T.StructField("path", T.StringType()), T.StructField("size", T.LongType())])
    held = [x for x in folders if _has_files(spark, x)]
    if not held:
        return spark.createDataFrame([], none)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(held)
    return found.select(normal(F.col("path")).alias("path"), F.col("length").alias("size")).distinct()


def _has_files(spark: SparkSession, folder: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.exists(where)


def with_presence(df: DataFrame, files: DataFrame, *, uri: str = "video_uri", folder: str | None = None) -> DataFrame:
    """df with present and file_size: whether the listing has the file of column uri, with bytes in it.

    Relative paths are looked up under folder. A null path is absent; an empty one
    stands for the working folder, which is there. A path that many rows name is a large
    key of the join, whose large partitions the engine splits; rows stay as many.
    """
    listed = files.select(F.col("path").alias("_path"), F.col("size").alias("file_size"))
    met = df.withColumn("_named", normal(F.col(uri), folder)).join(listed, F.col("_named") == F.col("_path"), "left")
    there = F.when(F.col(uri) == "", True).otherwise(F.coalesce(F.col("file_size") > 0, F.lit(False)))
    return met.withColumn("present", there).drop("_named", "_path")
