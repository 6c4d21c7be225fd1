"""Manifests: a header with distributions, a line for each clip, and the view that training reads.

A manifest is written in shards by the tasks (sources.shards), with an index of byte
offsets; a single file is a copy of those shards.
"""

from __future__ import annotations

import json
import shutil
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import fixed_values as V
from reelspark.functions.parsing import tenths
from reelspark.sources import shards
from reelspark.sources.records import read_manifest

#: Columns of the view by the record's fields.
SAMPLE = {"video_uri": "video_uri", "clip_id": "clip_id", "scenario": "scenario_type", "actions": "actions", "start_ms": "start_ms", "end_ms": "end_ms", "fps": "fps", "camera_pov": "camera_pov"}
_SCHEMA = "video_uri string, clip_id string, scenario_type string, actions array<string>, start_ms long, end_ms long, fps double, camera_pov string"
#: Distributions of a header.
KINDS = {"scenario": "scenario_type", "pov": "camera_pov", "geo": "geo_region", "label_source": "provenance.label_source"}


def _or_default(value: Column, default: str) -> Column:
    return F.coalesce(F.when(value != "", value), F.lit(default))


def distribution(df: DataFrame, value: Column, default: str | None = None) -> DataFrame:
    """(value, n); the default stands for null and empty values."""
    value = value if default is None else _or_default(value, default)
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def _flat(clips: DataFrame) -> DataFrame:
    """The columns that a header is made of; a region that is null or empty is unknown."""
    kinds = {k: F.col(f"record.{c}") for k, c in KINDS.items()}
    kinds["geo"] = _or_default(kinds["geo"], "unknown")
    return clips.select(*[c.alias(k) for k, c in kinds.items()], F.coalesce("record.duration_ms", F.lit(0)).alias("duration_ms"))


def header_rows(clips: DataFrame) -> DataFrame:
    """(what, value, n) of (ord, record) clips: all distributions, n_samples and total_duration_s, out of one aggregate over grouping sets.

    total_duration_s is rounded to tenths as functions.parsing.tenths says.
    """
    flat = _flat(clips)
    sets = [[F.col(k)] for k in KINDS] + [[]]
    summed = flat.groupingSets(sets, *KINDS).agg(F.grouping_id().alias("_set"), F.count("*").alias("n"), F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("ms"))
    # in a grouping id the bit of a column that isn't grouped by is set, the first column's is the highest
    ids = {(1 << len(KINDS)) - 1 - (1 << (len(KINDS) - 1 - i)): k for i, k in enumerate(KINDS)}
    name = F.create_map(*[F.lit(x) for i, k in ids.items() for x in (i, f"{k}_distribution")])
    value = F.coalesce(*[F.when(F.col("_set") == i, F.col(k)) for i, k in ids.items()])
    whole = F.col("_set") == (1 << len(KINDS)) - 1
    number = lambda what, n: F.struct(F.lit(what).alias("what"), F.lit("").alias("value"), n.cast("double").alias("n"))
    parts = F.when(whole, F.array(number("n_samples", F.col("n")), number("total_duration_s", tenths(F.col("ms"))))).otherwise(
        F.array(F.struct(F.element_at(name, F.col("_set").cast("int")).alias("what"), value.alias("value"), F.col("n").cast("double").alias("n")))
    )
    # without clips the grouping sets give no rows, and the numbers are 0
    none = clips.sparkSession.range(1).select(F.inline(F.array(number("n_samples", F.lit(0)), number("total_duration_s", F.lit(0)))))
    return summed.select(F.inline(parts)).unionByName(none).groupBy("what", "value").agg(F.sum("n").alias("n"))


def _head(dataset_name: str, version: str, n: int, counts: dict[str, dict], total_s: float) -> dict:
    return {"_type": "manifest_header", "dataset_name": dataset_name, "version": version, "schema_version": V.SCHEMA_VERSION, "n_samples": n, **{f"{k}_distribution": counts.get(k, {}) for k in KINDS}, "total_duration_s": total_s}


def header(clips: DataFrame, dataset_name: str, version: str) -> dict:
    """The header of (ord, record) clips, counted on the executors in one aggregate."""
    counts: dict[str, dict] = {}
    numbers = {"n_samples": 0.0, "total_duration_s": 0.0}
    for r in header_rows(clips).collect():  # as many rows as the header has entries
        if r.what in numbers:
            numbers[r.what] = r.n
        else:
            counts.setdefault(r.what.removesuffix("_distribution"), {})[r.value] = int(r.n)
    return _head(dataset_name, version, int(numbers["n_samples"]), counts, numbers["total_duration_s"])


def lines(clips: DataFrame) -> DataFrame:
    """(ord, raw) of (ord, record) clips."""
    return clips.select("ord", F.to_json("record", {"ignoreNullFields": "false"}).alias("raw"))


def write_shards(clips: DataFrame, path: str, *, dataset_name: str, version: str) -> dict:
    """Writes (ord, record) clips by ord to the folder path, in shards; the header comes out of the tasks' commit messages."""
    kinds = {f"_{k}": c for k, c in ((k, F.col(f"record.{c}")) for k, c in KINDS.items())}
    kinds["_geo"] = _or_default(kinds["_geo"], "unknown")
    told = clips.select("ord", F.to_json("record", {"ignoreNullFields": "false"}).alias("raw"), *[c.alias(k) for k, c in kinds.items()], F.coalesce("record.duration_ms", F.lit(0)).alias("_ms"))
    done = shards.write_shards(told, path, count_by=tuple(kinds), sum_of="_ms", header={"dataset_name": dataset_name, "version": version})
    return head_of(done)


def head_of(done: dict) -> dict:
    """The header of a manifest in shards, as the first line of a single file has it."""
    return _head(done["dataset_name"], done["version"], done["rows"], {k: done["counts"][f"_{k}"] for k in KINDS}, round(done["sum"] / 1000, 1))


def write_manifest(clips: DataFrame, path: str, *, dataset_name: str, version: str) -> dict:
    """Writes one local file, header first, rows by ord: a copy of shards that the tasks write beside it and that go afterwards."""
    scratch = f"{path}.{uuid.uuid4().hex}"
    try:
        head = write_shards(clips, scratch, dataset_name=dataset_name, version=version)
        shards.joined_file(scratch, path, json.dumps(head, ensure_ascii=False))
    finally:
        shutil.rmtree(scratch, ignore_errors=True)
    return head


def samples(clips: DataFrame, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The training view of (ord, record) clips; transform maps it as a whole."""
    view = clips.select(*[F.col(f"record.{field}").alias(name) for name, field in SAMPLE.items()])
    return view.transform(transform) if transform else view


def read_samples(spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    _, rows = read_manifest(spark, path)
    return samples(rows.select(F.from_json("raw", _SCHEMA).alias("record")), transform)


class ClipDataset:
    """Samples of a manifest in shards by their number, for training loops that want random access (see shards.ManifestIndex).

    transform maps each sample. Works as a map-style dataset: it has a length, takes a
    number, and opens its files anew in each process that it is sent to.
    """

    def __init__(self, path: str, transform: Callable[[dict], object] | None = None):
        self.path, self.transform, self.index = path, transform, shards.ManifestIndex(path)

    def __len__(self) -> int:
        return len(self.index)

    def __getitem__(self, i: int):
        found = self.index[i]
        sample = {name: found[field] for name, field in SAMPLE.items()}
        return self.transform(sample) if self.transform else sample

    def __getstate__(self) -> dict:
        return {"path": self.path, "transform": self.transform}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)
