"""From platform records to weakly labelled candidate clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import fixed_values as V
from reelspark.functions import parsing, relevance
from reelspark.functions.fields import first_of, listed, opened, or_default, settled
from reelspark.functions.taxonomy import ScenarioSpec

UNKNOWN_FPS = 30.0


def _text(part: Column) -> Column:
    """A field as text: lists by their non-empty elements, anything else stripped."""
    joined = F.array_join(F.filter(listed(part["value"]), lambda x: x.isNotNull() & ~x.isin("", "0", "false", "[]", "{}")), " ")
    return F.coalesce(F.when(part["kind"].startswith("ARRAY"), joined).otherwise(parsing.stripped(part["value"])), F.lit(""))


def _seconds(part: Column) -> Column:
    return F.when(part["kind"] == "BOOLEAN", (part["value"] == "true").cast("int").cast("string")).otherwise(part["value"])


def _adapted(records: DataFrame, platform: str, text_keys) -> DataFrame:
    found = opened(records)
    said = [f"_said{i}" for i in range(len(text_keys))]
    # one at a time: together they are more code than the JVM takes in one method
    for name, keys in (("_url", V.URL_KEYS), ("_duration", V.DURATION_KEYS), ("_size", V.RES_KEYS), ("_fps", V.FPS_KEYS), *zip(said, text_keys)):
        found = settled(found, **{name: first_of(keys)})
    read = settled(found, source_url=F.coalesce("_url.value", F.lit("")), duration_ms=parsing.duration_ms(_seconds(F.col("_duration"))), _pixels=parsing.resolution(F.col("_size.value")), text=relevance.joined_text(*[_text(F.col(c)) for c in said]))
    return read.select(
        "ord", "raw", "source_url", "duration_ms", "text", F.lit(platform).alias("platform"), parsing.declared_fps(F.col("_fps.value")).alias("fps"),
        F.coalesce("_pixels.width", F.lit(0)).alias("width"), F.coalesce("_pixels.height", F.lit(0)).alias("height"),
    )


def adapt_youtube(records: DataFrame) -> DataFrame:
    return _adapted(records, "youtube", (V.TITLE_KEYS, V.DESC_KEYS, V.TAGS_KEYS))


def adapt_tiktok(records: DataFrame) -> DataFrame:
    """Short videos have no title."""
    return _adapted(records, "tiktok", (V.DESC_KEYS, V.TAGS_KEYS))


#: Platform to adapter of (ord, raw) records; more may be added.
ADAPTERS = {"youtube": adapt_youtube, "tiktok": adapt_tiktok}


def adapt(records: DataFrame, platform: str) -> DataFrame:
    """(ord, raw, source_url, duration_ms, text, platform, fps, width, height)."""
    if platform not in ADAPTERS:
        raise ValueError(f"no adapter for {platform!r}; there are {sorted(ADAPTERS)}")
    return ADAPTERS[platform](records)


def windows(duration: Column, platform: Column, spec: ScenarioSpec, max_windows: int = 3) -> Column:
    """array<struct(start_ms, end_ms)>: equal segments without a tail that is too short, or the whole of a short video."""
    span = lambda a, b: F.struct(a.cast("bigint").alias("start_ms"), b.cast("bigint").alias("end_ms"))
    longest, n = spec.max_duration_ms, F.ceil(duration / F.lit(spec.max_duration_ms))
    parts = F.transform(F.sequence(F.lit(0), F.least(n, F.lit(max_windows)).cast("int") - 1), lambda i: span(i * longest, F.least((i + 1) * longest, duration)))
    cut = F.filter(parts, lambda x: x["end_ms"] - x["start_ms"] >= spec.min_duration_ms)
    none = F.expr("cast(array() as array<struct<start_ms:bigint,end_ms:bigint>>)")
    whole = F.when(duration >= spec.min_duration_ms, F.array(span(F.lit(0), duration))).otherwise(none)
    return F.when((duration <= 0) | F.lit(max_windows <= 0) & (platform != "tiktok"), none).when(platform == "tiktok", whole).otherwise(cut)


def judged(videos: DataFrame, spec: ScenarioSpec, min_score: float = 4.0, max_windows: int = 3, lexicon: relevance.Lexicon = relevance.Lexicon()) -> DataFrame:
    """videos with score, actions, scenario, env, windows and reason: why it is rejected (the first check that fails), or null."""
    scored = settled(
        videos, _r=relevance.relevance(F.col("text"), spec, lexicon), scenario=relevance.scenario_of(F.col("text"), spec, lexicon),
        env=relevance.env_of(F.col("text"), lexicon), windows=windows(F.col("duration_ms"), F.col("platform"), spec, max_windows),
    )
    reason = (
        F.when(F.col("source_url") == "", F.lit("no_url"))
        .when(F.col("duration_ms") <= 0, F.lit("no_duration"))
        .when(F.col("_r.score") < min_score, F.lit("low_score"))
        .when((F.col("scenario") == "unknown") & (F.col("env") == "unknown"), F.lit("no_env"))
        .when(F.size("windows") == 0, F.lit("no_window"))
    )
    return scored.select("*", F.col("_r.score").alias("score"), F.col("_r.actions").alias("actions"), reason.alias("reason")).drop("_r")


def clips(labelled: DataFrame, spec: ScenarioSpec, default_vendor: str = "unknown") -> DataFrame:
    """(ord, win, ...) candidate clips of the videos that judged() let pass, a row for each window."""
    rows = opened(labelled.filter("reason is null")).select("*", F.posexplode("windows").alias("win", "_w"))
    return rows.select(
        "ord", "win", F.col("scenario").alias("scenario_type"),
        F.when(F.col("env") != "unknown", F.col("env")).otherwise(F.lit(spec.environments[0])).alias("env_context"),
        F.lit("third_person").alias("camera_pov"), "actions", "_w.start_ms", "_w.end_ms",
        F.when(F.col("fps") > 0, F.col("fps")).otherwise(F.lit(UNKNOWN_FPS)).alias("fps"), "source_url", F.lit("").alias("video_uri"),
        F.lit("inferred_from_text").alias("_label_source"), F.when(F.col("platform") == "tiktok", F.lit("whole_video")).otherwise(F.lit("fixed_window")).alias("_clip_boundary"),
        F.round("score", 2).alias("_relevance_score"), F.col("platform").alias("_platform"),
        or_default("_vendor", default_vendor).alias("_vendor"), or_default("_snapshot_id", None).alias("_snapshot_id"), or_default("_fetched_at", None).alias("_fetched_at"),
        F.col("width").alias("_declared_width"), F.col("height").alias("_declared_height"),
    )


def rejects(labelled: DataFrame) -> DataFrame:
    return labelled.filter("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def first_per_url(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key: a minimum by key, which is summed up in the map tasks first."""
    place = F.struct(*order)
    return rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), place).alias("_row")).select(key, "_row.*").select(*rows.columns)


def as_records(candidates: DataFrame, *order: str) -> DataFrame:
    """(ord, raw) of candidate clips: the vendor's own layout."""
    columns = [c for c in candidates.columns if c not in ("ord", "win", "platform_order")]
    return candidates.select(F.struct(*order).alias("ord"), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("raw"))
