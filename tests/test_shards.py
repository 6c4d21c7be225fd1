"""Manifests in shards: what tasks and commits leave, and samples by number."""

import json
import os
import pickle

import pytest
from pyspark.sql import functions as F

from reelspark.functions.parsing import tenths
from reelspark.functions.taxonomy import WAREHOUSE
from reelspark.operators import manifest, validation
from reelspark.sources import shards

from test_operators import GOOD, records


def numbered(spark, n, parts=5):
    return spark.range(n).select(F.col("id").alias("ord"), F.to_json(F.struct("id", F.repeat(F.lit("ü\n"), (F.col("id") % 7).cast("int")).alias("t"))).alias("raw"), (F.col("id") % 3).cast("string").alias("kind"), "id").repartition(parts)


def test_lines_come_back_in_order(spark, tmp_path):
    path = str(tmp_path / "m")
    head = shards.write_shards(numbered(spark, 1000), path, count_by=("kind",), sum_of="id", header={"dataset_name": "d"}, parts=5)
    assert head["rows"] == 1000 and head["counts"] == {"kind": {"0": 334, "1": 333, "2": 333}} and head["sum"] == 499500 and head["dataset_name"] == "d"
    assert len(head["shards"]) > 1
    back = shards.read_shards(spark, path).collect()
    assert sorted((r.ord, json.loads(r.raw)["id"]) for r in back) == [(i, i) for i in range(1000)]
    index = shards.ManifestIndex(path, lambda x: (x["id"], x["t"]))
    assert len(index) == 1000 and all(index[i] == (i, "ü\n" * (i % 7)) for i in (0, 1, 500, 999)) and index[-1][0] == 999
    assert [x[0] for x in index] == [*range(1000)] and len(index.files) <= index.HANDLES
    for bad in (1000, -1001):
        with pytest.raises(IndexError):
            index[bad]
    asked = spark.createDataFrame([(5, "a"), (999, "b"), (5, "c"), (None, "d"), (1000, "e")], "ord long, other string")
    assert sorted((r.other, json.loads(r.raw)["id"] if r.raw else None) for r in shards.lines_at(asked, path).collect()) == [("a", 5), ("b", 999), ("c", 5), ("d", None), ("e", None)]


def test_a_second_write_replaces_the_first_and_append_fails(spark, tmp_path):
    path = f"file:{tmp_path}/m"
    shards.write_shards(numbered(spark, 50), path)
    assert shards.write_shards(numbered(spark, 20), path)["rows"] == 20
    named = {s["name"] for s in shards.header_of(path)["shards"]}
    assert named == {str(f.relative_to(tmp_path / "m")).rsplit(".", 1)[0] for f in (tmp_path / "m").rglob("part-*")}
    with pytest.raises(Exception, match="holds a manifest already"):
        numbered(spark, 5).select("raw").write.format("clip_manifest").option("path", path).mode("append").save()
    assert shards.read_shards(spark, path).count() == 20
    assert shards.write_shards(numbered(spark, 0), path)["shards"] == [] and shards.read_shards(spark, path).count() == 0 and len(shards.ManifestIndex(path)) == 0


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "m")
    broken = numbered(spark, 400).withColumn("raw", F.when(F.col("ord") != 399, F.col("raw")))
    with pytest.raises(Exception, match="a line of a manifest is null"):
        shards.write_shards(broken, path, parts=8)
    assert os.listdir(path) == []
    # what was there before stays, whole
    shards.write_shards(numbered(spark, 30), path)
    before = sorted(os.listdir(path))
    with pytest.raises(Exception, match="a line of a manifest is null"):
        shards.write_shards(broken, path, parts=8)
    assert sorted(os.listdir(path)) == before and shards.read_shards(spark, path).count() == 30


def test_clips_in_shards(spark, tmp_path):
    rows = [GOOD | {"source_url": f"https://e/{i}", "geo_region": ("", "DE", None)[i % 3], "camera_pov": ("third_person", "wrist_mounted")[i % 2]} for i in range(40)]
    clips = validation.checked(records(spark, rows), WAREHOUSE).select("ord", F.col("record").withField("duration_ms", (F.col("ord") * 50 + 25).cast("long")).alias("record"))
    told = manifest.write_shards(clips, str(tmp_path / "m"), dataset_name="d", version="v1")
    assert told == manifest.header(clips, "d", "v1") and told["n_samples"] == 40 and told["geo_distribution"] == {"unknown": 27, "DE": 13}
    data = manifest.ClipDataset(str(tmp_path / "m"))
    view = {r.clip_id: r for r in manifest.samples(clips).collect()}
    assert len(data) == 40
    for i in (0, 17, 39):
        assert data[i] == view[data[i]["clip_id"]].asDict() and data[i]["clip_id"] == clips.filter(F.col("ord") == i).first().record.clip_id
    again = pickle.loads(pickle.dumps(manifest.ClipDataset(str(tmp_path / "m"), transform=len)))
    assert again[3] == len(manifest.SAMPLE)
    head = manifest.write_manifest(clips, str(tmp_path / "m.jsonl"), dataset_name="d", version="v1")
    text = (tmp_path / "m.jsonl").read_text().splitlines()
    assert json.loads(text[0]) == head == told and [json.loads(x)["source_url"] for x in text[1:]] == [f"https://e/{i}" for i in range(40)]
    assert sorted(os.listdir(tmp_path)) == ["m", "m.jsonl"]
    none = clips.limit(0)
    assert manifest.header(none, "d", "v") == manifest.write_shards(none, str(tmp_path / "n"), dataset_name="d", version="v")


def test_tenths_round_as_the_binary_number(spark):
    values = [*range(0, 4000, 50), 250, 350, 50, 150, 750, 12_345_650, 99_999_950, 10**12 + 50, 10**14 + 250, 1, 49, 51, 149, 151]
    got = spark.createDataFrame([(v,) for v in values], "ms long").select("ms", tenths(F.col("ms")).alias("s")).collect()
    assert {r.ms: r.s for r in got} == {v: round(v / 1000, 1) for v in values}
