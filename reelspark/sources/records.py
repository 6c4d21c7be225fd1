"""Records and manifests from files, and the offline stand-ins of the snapshot service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import fixed_values as V
from reelspark.functions.fields import opened
from reelspark.sources import json_arrays

RESPONSE, DISCOVERY = "vendor_response.json", "discovery_response.json"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(ord, raw) of JSON arrays of records: their place and their own text, read in byte ranges (see json_arrays)."""
    return json_arrays.read_elements(spark, path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, raw) of newline-delimited records; ord grows with the file, it isn't dense."""
    return spark.read.text(path).filter(F.trim("value") != "").select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias("raw"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, raw) of all physical lines, empty ones too, numbered from 0 over the files of path in the order of their names.

    Ranges of bytes are read apart; a first pass counts the lines of each, and the counts
    (one for each range) say where a range's numbers start.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    counted = lines.groupBy("file", "block").agg(F.min("id").alias("least"), F.count("*").alias("n")).collect()
    firsts, total = [], 0
    for r in sorted(counted, key=lambda r: (r.file, r.block)):
        firsts.append((r.file, r.block, total - r.least))
        total += r.n
    if not firsts:
        return spark.createDataFrame([], "ord long, raw string")
    known = spark.createDataFrame(firsts, "file string, block long, shift long")  # a row for each range of bytes
    return lines.join(F.broadcast(known), ["file", "block"]).select((F.col("id") + F.col("shift")).alias("ord"), F.col("value").alias("raw"))


def stamped(records: DataFrame, snapshot_id: str, vendor: str, dataset_id: str | None = None) -> DataFrame:
    """records with where they come from and when, in place of what they say themselves."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    marks = {"_vendor": F.lit(vendor), "_snapshot_id": F.lit(snapshot_id), "_fetched_at": now} | ({"_dataset_id": F.lit(dataset_id)} if dataset_id is not None else {})
    body = F.regexp_replace(F.rtrim("raw"), r"\}$", "")
    # the marks stand last, and of repeated keys the last one counts; fields marked before are cut
    for name in marks:
        body = F.regexp_replace(body, rf',?\s*"{name}"\s*:\s*(?:"(?:[^"\\]|\\.)*"|null|[-\w.]+)', "")
    body = F.regexp_replace(body, r"^\{\s*,", "{")
    glue = F.when(body.rlike(r"^\{\s*$"), F.lit("")).otherwise(F.lit(","))
    tail = F.substring(F.to_json(F.struct(*[v.alias(k) for k, v in marks.items()])), 2, 1 << 20)
    return records.withColumn("raw", F.concat(body, glue, tail))


def collect_offline(spark: SparkSession, folder: str) -> DataFrame:
    return stamped(read_records(spark, f"{folder}/{RESPONSE}"), "s_mock_local", "mock")


def discover_offline(spark: SparkSession, folder: str, queries: list[str], dataset_id: str, limit_per_input: int = 20) -> DataFrame:
    """Found records, as many for each query at most as limit_per_input says, in the file's order."""
    from pyspark.errors import AnalysisException

    try:
        found = read_records(spark, f"{folder}/{DISCOVERY}")
    except AnalysisException:
        found = read_records(spark, f"{folder}/{RESPONSE}")
    if limit_per_input:
        found = found.filter(F.col("ord") < limit_per_input * len(queries))
    return stamped(found, "s_mock_discovery", "mock", dataset_id)


def offline_datasets(spark: SparkSession) -> DataFrame:
    rows = [(i, *row) for i, row in enumerate(V.OFFLINE_DATASETS)]
    return spark.createDataFrame(rows, "ord int, id string, name string, type string")


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(header, rows) as (raw) and (ord, raw): the header is the first physical line, if it says that it is one."""
    lines = opened(numbered_lines(spark, path).filter(F.trim("raw") != ""))
    is_header = (F.col("ord") == 0) & F.coalesce(F.try_element_at("_m", F.lit("_type")) == "manifest_header", F.lit(False))
    return lines.filter(is_header).select("raw"), lines.filter(~is_header).select("ord", "raw")
