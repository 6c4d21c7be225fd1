"""Validation of records against a scenario, and of clips against their measured files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions import fixed_values as V
from reelspark.functions.fields import kind, listed, missing, opened, or_default, settled, text
from reelspark.functions.parsing import float_of, int_of
from reelspark.functions.taxonomy import ScenarioSpec


#: Kinds of reasons: of a record, and of a clip against its file.
RECORD_REASONS = ("missing_field", "type_error", "invalid_window", "fps_too_low", "too_short", "too_long", "scenario_mismatch", "unknown_pov", "pov_out_of_scope", "unknown_env", "unknown_actions", "incomplete_actions")
FILE_REASONS = ("probe_failed", "resolution_too_low", "real_fps_too_low", "real_duration_too_short", "not_a_video", "duration_mismatch", "fps_mismatch", "file_missing")


def _reasons(*pairs: tuple[Column, Column | str]) -> Column:
    """Reasons of the conditions that hold, in this order."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(reason) if isinstance(reason, str) else reason) for condition, reason in pairs]))


def _joined(head: str, value: Column) -> Column:
    return F.concat(F.lit(head), F.coalesce(value.cast("string"), F.lit("None")))


def _vocab(values) -> Column:
    return F.array(*map(F.lit, values))


def clip_id(source_url: Column, video_uri: Column, start_ms: Column, end_ms: Column) -> Column:
    """A stable id: SHA-1 of source (or file) and times, as they are written."""
    source = F.coalesce(F.when(source_url != "", source_url), F.when(video_uri != "", video_uri), F.lit(""))
    return F.concat(F.lit("clip_"), F.substring(F.sha1(F.concat_ws("|", source, F.coalesce(start_ms, F.lit("None")), F.coalesce(end_ms, F.lit("None")))), 1, 16))


def checked(records: DataFrame, spec: ScenarioSpec, *, relaxed: bool = False, video_uri: str | None = None) -> DataFrame:
    """(ord, raw, ok, reasons, record) of (ord, raw) records; record is null where reasons are given.

    Missing fields hide all other checks, times that can't be read hide the later ones,
    actions that are no list hide those on actions. relaxed: actions may be an empty
    list and needn't be complete, and defaults say that labels are inferred.
    An infinite time, or an action that is no string, is a reason here and no error.
    """
    rows = settled(opened(records), _start_kind=kind("start_ms"), _end_kind=kind("end_ms"), _fps_kind=kind("fps"), _actions_kind=kind("actions"))
    nothing = text("actions").isin("0", "0.0", "false", "{}") & ~F.col("_actions_kind").startswith("STRING")
    rows = settled(
        rows, _start=int_of(text("start_ms"), F.col("_start_kind")), _end=int_of(text("end_ms"), F.col("_end_kind")), _fps=float_of(text("fps"), F.col("_fps_kind")),
        _actions=F.when(F.col("_actions_kind").startswith("ARRAY"), listed(text("actions"))).when(nothing | missing("actions"), F.expr("cast(array() as array<string>)")),
    )
    absent = _reasons(*[(missing(f, empty_list=not (relaxed and f == "actions")), f"missing_field:{f}") for f in V.REQUIRED_FIELDS])
    start, end, fps, actions = F.col("_start"), F.col("_end"), F.col("_fps"), F.col("_actions")
    length = end - start
    ranged = [
        (end <= start, "invalid_window:end<=start"),
        ((fps < spec.min_fps) & ~F.isnan(fps), _joined("fps_too_low:", fps)),
        (length < spec.min_duration_ms, F.concat(_joined("too_short:", length), F.lit("ms"))),
        (length > spec.max_duration_ms, F.concat(_joined("too_long:", length), F.lit("ms"))),
        (text("scenario_type") != spec.scenario_type, _joined("scenario_mismatch:", text("scenario_type"))),
        (~text("camera_pov").isin(*V.CAMERA_POVS), _joined("unknown_pov:", text("camera_pov"))),
        (text("camera_pov").isin(*V.CAMERA_POVS) & ~text("camera_pov").isin(*spec.camera_povs), _joined("pov_out_of_scope:", text("camera_pov"))),
        (~text("env_context").isin(*V.ENV_TYPES), _joined("unknown_env:", text("env_context"))),
    ]
    # a filter, as the difference of arrays would drop repeats
    unknown = F.filter(actions, lambda a: ~F.coalesce(F.array_contains(_vocab(V.ACTION_VOCAB), a), F.lit(False)))
    lacking = F.filter(_vocab(spec.actions), lambda a: ~F.array_contains(actions, a))
    on_actions = [
        (actions.isNull(), "type_error:actions_not_list"),
        (F.size(unknown) > 0, F.concat(F.lit("unknown_actions:"), F.array_join(unknown, ",", "None"))),
        *([] if relaxed else [((F.size(lacking) > 0), F.concat(F.lit("incomplete_actions:missing="), F.array_join(lacking, ",")))]),
    ]
    unread = start.isNull() | end.isNull() | fps.isNull()
    reasons = F.when(F.size(absent) > 0, absent).when(unread, F.array(F.lit("type_error:timestamps_or_fps"))).otherwise(_reasons(*ranged, *on_actions))
    uri = F.coalesce(F.lit(video_uri or None), F.when(text("video_uri") != "", text("video_uri")), F.lit(""))
    record = F.struct(
        clip_id(text("source_url"), text("video_uri"), F.when(F.lit(True), text("start_ms")), text("end_ms")).alias("clip_id"), uri.alias("video_uri"),
        *[text(f).alias(f) for f in ("scenario_type", "env_context", "camera_pov")], actions.alias("actions"), start.alias("start_ms"), end.alias("end_ms"), fps.alias("fps"),
        text("geo_region").alias("geo_region"), text("source_url").alias("source_url"),
        F.lit(None).cast("bigint").alias("duration_ms"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("string").alias("codec"), F.lit(None).cast("string").alias("phash"), F.lit(V.SCHEMA_VERSION).alias("schema_version"),
        F.struct(
            or_default("_vendor", "unknown").alias("vendor"), or_default("_snapshot_id", None).alias("snapshot_id"), or_default("_fetched_at", None).alias("fetched_at"),
            or_default("_label_source", "inferred_from_text" if relaxed else "vendor_provided").alias("label_source"), or_default("_clip_boundary", "fixed_window" if relaxed else "pre_cut").alias("clip_boundary"),
        ).alias("provenance"),
    )
    judged = settled(rows, reasons=reasons)
    return judged.select("ord", "raw", (F.size("reasons") == 0).alias("ok"), "reasons", F.when(F.size("reasons") == 0, record).alias("record"))


def histogram(df: DataFrame, reasons: str = "reasons") -> DataFrame:
    """(reason, n): how often each kind of reason is given; a row with two reasons counts twice."""
    return df.select(F.explode(reasons).alias("_r")).groupBy(F.split_part("_r", F.lit(":"), F.lit(1)).alias("reason")).agg(F.count("*").alias("n"))


def probe_problems(declared_ms: Column, declared_fps: Column, probe: Column, spec: ScenarioSpec, tolerance: float = 0.15, fps_tolerance: float = 0.05) -> Column:
    """Reasons why a file doesn't bear out what is declared; a failed probe is the only reason then."""
    ms, fps = probe["duration_ms"], probe["fps"]
    real = lambda x: ~F.isnan(x) & (x > 0)  # noqa: E731  NaN is above all numbers here
    drift = F.try_divide(F.abs(ms - declared_ms), declared_ms)
    fps_drift = F.try_divide(F.abs(declared_fps - fps), declared_fps)
    two = lambda x: F.format_string("%.2f", x)
    problems = _reasons(
        (probe["height"] < spec.min_height, F.concat(_joined("resolution_too_low:", probe["width"]), F.lit("x"), probe["height"].cast("string"))),
        ((fps < spec.min_fps) & ~F.isnan(fps), F.concat(F.lit("real_fps_too_low:"), two(fps))),
        (ms < spec.min_duration_ms, F.concat(_joined("real_duration_too_short:", ms), F.lit("ms"))),
        (probe["nb_frames"] <= 1, "not_a_video"),
        ((declared_ms > 0) & (ms > 0) & (drift > tolerance), F.concat(_joined("duration_mismatch:declared=", declared_ms), F.lit("ms,"), _joined("real=", ms), F.lit("ms"))),
        (real(declared_fps) & real(fps) & (fps_drift > fps_tolerance), F.concat(_joined("fps_mismatch:declared=", declared_fps), F.lit(",real="), two(fps))),
    )
    return F.when(probe["ok"], problems).otherwise(F.array(F.concat(F.lit("probe_failed:"), F.coalesce(probe["error"], F.lit("")))))


def enriched(record: Column, probe: Column) -> Column:
    """record with what was measured; a measured rate of 0 leaves the declared one."""
    out = record
    for name in ("duration_ms", "width", "height", "codec"):
        out = out.withField(name, probe[name])
    return out.withField("fps", F.when(probe["fps"] != 0, probe["fps"]).otherwise(record["fps"]))
