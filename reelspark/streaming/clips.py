"""Records as a stream: the batch operators, and ids that are let through once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.taxonomy import ScenarioSpec
from reelspark.operators.validation import checked


def record_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(ord, raw, seen_at) of newline-delimited records in files that come to a folder."""
    return spark.readStream.text(folder).filter(F.trim("value") != "").select(F.lit(0).alias("ord"), F.col("value").alias("raw"), F.current_timestamp().alias("seen_at"))


def valid_once(stream: DataFrame, spec: ScenarioSpec, *, relaxed: bool = False, memory: str = "1 day") -> DataFrame:
    """(clip_id, seen_at, record) of valid records; an id that comes again within memory is left out, and state stays bounded."""
    clips = checked(stream.withColumn("ord", F.col("seen_at")), spec, relaxed=relaxed).filter("ok")
    rows = clips.select("record.clip_id", F.col("ord").alias("seen_at"), "record")
    return rows.withWatermark("seen_at", memory).dropDuplicatesWithinWatermark(["clip_id"])
