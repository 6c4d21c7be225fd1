"""From keyword search to candidate clips, in the layout that curation reads."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.taxonomy import REGISTRY, ScenarioSpec
from reelspark.operators import labelling, media
from reelspark.operators.lineage import checkpoint
from reelspark.operators.validation import clip_id
from reelspark.sources import records, snapshot


def platform_records(spark: SparkSession, folder: str | None, platform: str, spec: ScenarioSpec, datasets: DataFrame, *, client=None, per_query: int = 20) -> DataFrame | None:
    """Records that the platform finds for the scenario's queries; None if it has no dataset."""
    try:
        dataset_id = snapshot.match_dataset_id(datasets, platform)
    except snapshot.DatasetNotAvailable:
        return None
    queries = spec.to_search_queries()
    if client is None:
        return records.discover_offline(spark, folder, queries, dataset_id, per_query)
    return snapshot.discover(spark, dataset_id, queries, limit_per_input=per_query, client=client).select("ord", "raw")


def deduplicated(candidates: DataFrame, max_clips: int) -> DataFrame:
    """The first clip of each URL (so of windows of one video the first), max_clips at most, in the order they were met."""
    order = ("platform_order", "ord", "win")
    return labelling.first_per_url(candidates, "source_url", *order).orderBy(*order).limit(max_clips)


def run(
    spark: SparkSession, folder: str, out: str, *, scenario: str = "warehouse_pick_and_place", platforms=("youtube", "tiktok"), client=None,
    min_score: float = 4.0, per_query: int = 20, max_clips: int = 60, max_windows: int = 3, download_folder: str | None = None, tool: media.Tool = media.run_tool, downloader: media.Downloader = media.DOWNLOADER, show: Callable[[str], object] | None = None,
) -> dict:
    """Writes vendor_response.json and discovery_report.json to out; returns the report. show, say print, gets the catalogue."""
    began, spec = time.time(), REGISTRY.get(scenario)
    datasets = checkpoint(snapshot.listed(spark, client))
    if show:
        show(snapshot.catalogue(datasets))
    parts, rejects, found = [], {}, 0
    for i, platform in enumerate(platforms):
        raw = platform_records(spark, folder, platform, spec, datasets, client=client, per_query=per_query)
        if raw is None:
            continue
        judged = checkpoint(labelling.judged(labelling.adapt(raw, platform), spec, min_score, max_windows))
        found += judged.count()
        for r in labelling.rejects(judged).collect():
            rejects[r.reason] = rejects.get(r.reason, 0) + r.n
        parts.append(labelling.clips(judged, spec).withColumn("platform_order", F.lit(i)))
    final, labelled, duplicates, failures = [], 0, 0, {}
    if parts:
        every = checkpoint(reduce(DataFrame.unionByName, parts))
        labelled = every.count()
        duplicates = labelled - every.select("source_url").distinct().count()
        kept = checkpoint(deduplicated(every, max_clips))
        if client is not None and download_folder:
            media.check_downloader(tool, downloader)
            # ids of curation, so that a second run finds what the first has fetched
            told = kept.withColumn("clip_id", clip_id(F.col("source_url"), F.col("video_uri"), F.col("start_ms").cast("string"), F.col("end_ms").cast("string")))
            done = checkpoint(media.downloaded(told, download_folder, tool=tool, downloader=downloader))
            failures = {r.download_error: r["count"] for r in done.filter("download_error is not null").groupBy("download_error").count().collect()}
            kept = done.filter("download_error is null").drop("download_error", "clip_id")
        # max_clips rows at most
        final = [json.loads(r.raw) for r in labelling.as_records(kept, "platform_order", "ord", "win").orderBy("ord").collect()]
    rejects["url_duplicate"] = duplicates
    Path(out).mkdir(parents=True, exist_ok=True)
    Path(f"{out}/{records.RESPONSE}").write_text(json.dumps(final, ensure_ascii=False, indent=2), encoding="utf-8")
    report = {
        "scenario": scenario, "platforms": list(platforms), "min_score": min_score, "per_query": per_query, "max_clips": max_clips,
        "funnel": {"discovered": found, "labeled": labelled, "url_deduped": len(final) + duplicates, "final": len(final)},
        "reject_reasons": rejects, "download_failures": failures, "download_skipped": download_folder is None, "is_real_api": client is not None,
        "timings_s": round(time.time() - began, 2), "label_source": "inferred_from_text", "clip_boundary": "fixed_window",
        "next_step": f"curation.run(spark, {out!r}, ..., relaxed=True)",
    }
    Path(f"{out}/discovery_report.json").write_text(json.dumps(report, ensure_ascii=False, indent=2), encoding="utf-8")
    return report
