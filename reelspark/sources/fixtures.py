"""Synthetic records with known defects, and what a probe and a hash of their files would have said.

No video is made: each fixture carries its record as JSON, whether its file is there, the
file's measures and its frames' hashes. So the whole funnel runs without media tools, and
every stage's count is known beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.perceptual import FRAMES
from reelspark.functions.taxonomy import WAREHOUSE, ScenarioSpec

#: Kinds of fixtures: percent of n and the least number. The last but one pair shares its number, the first half rounded down.
KINDS = {"clean": (62, 0), "near_copy": (11, 0), "exact_copy": (3, 2), "short_file": (5, 2), "slow": (4, 2), "partial_actions": (6, 2), "other_scenario": (5, 4), "no_pov": (5, 4), "corrupt": (3, 1), "absent": (2, 1)}
REGIONS = ("DE", "US", "CN", "JP", "GB", "FR")
FOLDER = "fixtures/clips"


def counts(n: int) -> dict[str, int]:
    """How many fixtures of each kind; they need not add up to n."""
    found = {kind: max(least, n * percent // 100) for kind, (percent, least) in KINDS.items()}
    both = found["other_scenario"]
    return found | {"other_scenario": both // 2, "no_pov": both - both // 2}


def expected(n: int) -> dict[str, int]:
    """The count of each stage of the funnel, if hashes group just the copies."""
    k = counts(n)
    total = sum(k.values())
    valid = total - sum(k[x] for x in ("slow", "partial_actions", "other_scenario", "no_pov"))
    there = valid - k["absent"]
    probed = there - k["corrupt"] - k["short_file"]
    return {"fetched": total, "schema_valid": valid, "file_present": there, "probe_valid": probed, "unique": k["clean"], "training_ready": k["clean"]}


def _drawn(seed: int, name: str, low: int, high: int) -> Column:
    """A number from low to high, told by the seed, the name and the row."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(name), F.col("id")), F.lit(high - low + 1)) + low).cast("long")


def _one_of(seed: int, name: str, values) -> Column:
    return F.get(F.array(*map(F.lit, values)), _drawn(seed, name, 0, len(values) - 1).cast("int"))


def _uri(number: Column) -> Column:
    return F.concat(F.lit(f"{FOLDER}/clip_"), F.lpad(number.cast("string"), 4, "0"), F.lit(".mp4"))


def fixtures(spark: SparkSession, n: int = 120, seed: int = 2026, spec: ScenarioSpec = WAREHOUSE) -> DataFrame:
    """(ord, kind, video_uri, raw, present, probe, sig) in an order drawn from the seed; n of 0 gives the least numbers."""
    sizes = counts(n)
    ends, at = {}, 0
    for kind, size in sizes.items():
        at = ends[kind] = at + size
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        kind = F.when(F.col("id") < ends[name], F.lit(name)).otherwise(kind)
    is_ = lambda *names: F.col("kind").isin(*names)

    own = spark.range(at).withColumn("kind", kind).withColumn("video_uri", _uri(F.col("id")))
    own = own.select(
        "id", "kind", "video_uri", F.concat(F.lit("https://example.com/watch?v=src"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("source_url"),
        _drawn(seed, "start", 0, 200_000).alias("start_ms"), F.when(is_("short_file"), F.lit(15_000).cast("long")).otherwise(_drawn(seed, "length", 4_000, 20_000)).alias("length"),
        F.when(is_("slow"), _one_of(seed, "fps", (10, 12, 15))).otherwise(_one_of(seed, "fps", (25, 30))).alias("fps"), F.when(is_("slow"), F.lit(360)).otherwise(_one_of(seed, "height", (480, 540, 720))).alias("height"),
        _one_of(seed, "pov", spec.camera_povs).alias("pov"), _one_of(seed, "region", REGIONS).alias("region"),
        F.array(*[F.xxhash64(F.lit(seed), F.lit(i), F.col("id")) for i in range(FRAMES)]).alias("sig"),
        # copies name the file that they are copies of, each another one
        F.when(is_("near_copy", "exact_copy"), _uri(F.col("id") - ends["clean"])).alias("original"),
    )
    first = own.filter("kind = 'clean'").select(F.col("video_uri").alias("original"), *[F.col(c).alias(f"{c}_of") for c in ("length", "fps", "height", "pov", "region", "sig", "start_ms")])
    met = own.join(first, "original", "left")
    copied = lambda c: F.coalesce(f"{c}_of", c)
    masks = F.array(*[F.lit(5 << 7 * i).cast("long") for i in range(FRAMES)])  # two bits of each hash
    flipped = F.zip_with(copied("sig"), masks, lambda x, mask: F.when(F.col("kind") == "near_copy", x.bitwiseXOR(mask)).otherwise(x))
    start = F.when(is_("exact_copy"), F.col("start_ms_of")).otherwise(F.col("start_ms"))
    actions = F.when(is_("partial_actions"), F.slice(F.array(*map(F.lit, spec.actions)), 1, len(spec.actions) - 1)).otherwise(F.array(*map(F.lit, spec.actions)))
    record = F.struct(
        F.when(is_("other_scenario"), F.lit("other_scenario")).otherwise(F.lit(spec.scenario_type)).alias("scenario_type"), F.lit(spec.environments[0]).alias("env_context"),
        F.when(~is_("no_pov"), copied("pov")).alias("camera_pov"), actions.alias("actions"), start.alias("start_ms"), (start + copied("length")).alias("end_ms"), copied("fps").alias("fps"),
        F.when(~is_("no_pov"), copied("region")).alias("geo_region"), "source_url", "video_uri",
    )
    broken = is_("corrupt", "absent")
    height = F.when(is_("near_copy"), F.lit(540)).otherwise(copied("height")).cast("int")
    probe = F.struct(
        (~broken).alias("ok"), F.when(broken, F.lit(0)).when(is_("short_file"), _drawn(seed, "real", 2_000, 4_000)).otherwise(copied("length")).cast("long").alias("duration_ms"), copied("fps").cast("double").alias("fps"),
        F.floor(height * 16 / 9).cast("int").alias("width"), height.alias("height"), F.lit("h264").alias("codec"), F.lit(100).alias("nb_frames"), F.when(broken, F.lit("ffprobe_failed")).otherwise(F.lit("")).alias("error"),
    )
    rows = met.select("kind", "video_uri", F.to_json(record).alias("raw"), (~is_("absent")).alias("present"), probe.alias("probe"), F.when(broken, F.array_repeat(F.lit(0).cast("long"), FRAMES)).otherwise(flipped).alias("sig"), F.xxhash64(F.lit(seed), F.lit("order"), F.col("id")).alias("_drawn"))
    # the order is drawn; a few hundred fixtures need no distributed numbering
    numbered = rows.sort("_drawn", "video_uri").coalesce(1).withColumn("ord", F.monotonically_increasing_id())
    return numbered.select("ord", "kind", "video_uri", "raw", "present", "probe", "sig")
