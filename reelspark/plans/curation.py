"""From records to a manifest: fetch, validate, download, probe, drop near-duplicates, package."""

from __future__ import annotations

import json
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.perceptual import FRAMES, hex_of
from reelspark.functions.taxonomy import REGISTRY
from reelspark.operators import files, manifest, media, near_duplicates, validation
from reelspark.operators.lineage import checkpoint
from reelspark.operators.report import Observed, per, summary
from reelspark.sources import snapshot


def run(
    spark: SparkSession, folder: str, out: str, *, scenario: str = "warehouse_pick_and_place", relaxed: bool = False, dataset_id: str | None = None, client=None,
    download_folder: str | None = None, url_field: str = "source_url", threshold: float = 8.0, total_cost: float = 0.0, version: str | None = None, tool: media.Tool = media.run_tool, downloader: media.Downloader = media.DOWNLOADER,
    video_folder: str | None = None, sharded: bool = False,
) -> dict:
    """Writes manifest.jsonl (sharded: the folder manifest, by the tasks) and report.json to out, and returns the report.

    Records, validation, download and probe are one pass, which leaves its counts behind
    as it is written; signatures are a second one. With video_folder, files are looked
    for in a listing of that folder, which may be on any file system, and not one by one.
    """
    spec, seen, seconds = REGISTRY.get(scenario), Observed(), {}
    clock = time.time()

    def timed(stage: str) -> None:
        nonlocal clock
        seconds[f"{stage}_s"], clock = round(time.time() - clock, 2), time.time()

    raw = snapshot.fetch(spark, folder, payload=[spec.to_filter_params()], dataset_id=dataset_id, client=client)
    timed("fetch")
    judged = seen.watch(validation.checked(raw, spec, relaxed=relaxed), {"fetched": F.lit(True), "schema_valid": F.col("ok")}, reasons="reasons", kinds=validation.RECORD_REASONS)
    clips = judged.filter("ok").select("ord", "record")
    named = ("clip_id", "video_uri", "source_url", "start_ms", "end_ms")
    flat = lambda df: df.select("*", *[F.col(f"record.{c}").alias(c) for c in dict.fromkeys((*named, url_field))])
    if client is not None and download_folder:
        media.check_downloader(tool, downloader)
        done = media.downloaded(flat(clips), download_folder, url_field=url_field, tool=tool, downloader=downloader)
        done = seen.watch(done, reasons="download_error", kinds=("no_download_url", "download_failed"))
        clips = done.filter("download_error is null").select("ord", F.col("record").withField("video_uri", F.col("video_uri")).alias("record"))
    rows = clips.select("ord", "record", F.col("record.video_uri").alias("video_uri"))
    if video_folder:
        rows = files.with_presence(checkpoint(rows), files.listing(spark, video_folder), folder=video_folder).drop("file_size")
    probe = F.struct(*[f.split()[0] for f in media.PROBE_SCHEMA.split(", ")])
    met = media.probed(rows, tool).withColumn("_p", probe)
    start, end = F.col("record.start_ms"), F.col("record.end_ms")
    problems = F.when(F.col("present"), validation.probe_problems(end - start, F.col("record.fps"), F.col("_p"), spec)).otherwise(F.array(F.lit("file_missing")))
    met = met.select("ord", validation.enriched(F.col("record"), F.col("_p")).alias("record"), "present", problems.alias("reasons"))
    met = seen.watch(met, {"file_present": F.col("present"), "probe_valid": F.size("reasons") == 0}, reasons="reasons", kinds=validation.FILE_REASONS)
    good = checkpoint(met.filter(F.size("reasons") == 0).select("ord", "record"))
    counts, reasons = seen.counts(), seen.reasons()
    timed("probe")

    size = (F.coalesce(F.col("record.width"), F.lit(0)) * F.coalesce(F.col("record.height"), F.lit(0))).alias("quality")
    sigs = checkpoint(media.signed(good.select("ord", "record", size, F.col("record.video_uri").alias("video_uri"), F.col("record.duration_ms").alias("duration_ms")), FRAMES, tool).select("ord", "record", "quality", "sig"))
    groups = near_duplicates.clusters(sigs.select("ord", "sig"), threshold, FRAMES).join(sigs.select("ord", "quality"), "ord")
    won = near_duplicates.winners(groups).filter("keep").select("ord")
    kept = sigs.join(won, "ord").select("ord", F.col("record").withField("phash", hex_of(F.col("sig")[0])).alias("record"))

    Path(out).mkdir(parents=True, exist_ok=True)
    write, target = (manifest.write_shards, f"{out}/manifest") if sharded else (manifest.write_manifest, f"{out}/manifest.jsonl")
    head = write(kept, target, dataset_name=f"{scenario}_web", version=version or time.strftime("v%Y%m%d"))
    counts |= {"unique": head["n_samples"], "training_ready": head["n_samples"]}  # the tasks that write have counted
    if counts["probe_valid"]:
        reasons["near_duplicate"] = counts["probe_valid"] - counts["unique"]
    timed("dedup")
    report = summary(counts, reasons, seconds, head) | ({"cost_per_usable_clip": per(total_cost, counts["training_ready"], float("inf"))} if total_cost else {})
    Path(f"{out}/report.json").write_text(json.dumps(report, ensure_ascii=False, indent=2), encoding="utf-8")
    return report
