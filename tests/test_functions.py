import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.functions import fixed_values as V
from reelspark.functions import parsing, perceptual, relevance
from reelspark.functions.taxonomy import KITCHEN, REGISTRY, WAREHOUSE, Scenarios, ScenarioSpec


def each(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_taxonomy():
    assert WAREHOUSE.to_search_queries() == ["warehouse robot reach grasp", "warehouse reach place demonstration"]
    assert WAREHOUSE.to_filter_params()["limit"] == 500 and "min_fps" not in WAREHOUSE.to_filter_params()
    assert KITCHEN.max_duration_ms == 60_000 and WAREHOUSE.as_dict()["actions"] == ("reach", "grasp", "lift", "place")
    with pytest.raises(KeyError):
        REGISTRY.get("none")
    with pytest.raises(ValueError):
        Scenarios(KITCHEN, WAREHOUSE).register(KITCHEN)  # the same spec again, too
    for bad in ({"task_family": "x"}, {"actions": ("fly",)}, {"camera_povs": ("x",)}, {"environments": ("moon",)}, {"min_duration_ms": 60_000}):
        with pytest.raises(ValueError):
            ScenarioSpec(**(dict(scenario_type="s", task_family="driving", environments=("highway",), actions=("turn",), camera_povs=("overhead",)) | bad))
    assert [len(x) for x in (V.ACTION_VOCAB, V.CAMERA_POVS, V.ENV_TYPES, V.NEGATIVE_KEYWORDS, V.SUBJECT_KEYWORDS)] == [21, 5, 8, 30, 12]


def test_durations(spark):
    values = ["120", "1:02:03", "2:03", "1::2", "1:2:3:4", "-5", "x", "", None, " 5.9 ", "0.5", "nan", "1_0", "　5　"]
    assert each(spark, values, parsing.duration_ms) == [120000, 3723000, 123000, 0, 0, -5000, 0, 0, 0, 5900, 500, 0, 10000, 5000]


def test_resolutions(spark):
    found = each(spark, ["720p", "1280×720", "1280 x 720", "4k", "1080p60", "12800", "", None, "480"], parsing.resolution)
    assert [tuple(x) for x in found] == [(1280, 720), (1280, 720), (1280, 720), (0, 0), (1920, 1080), (2274, 1280), (0, 0), (0, 0), (852, 480)]


def test_rates(spark):
    assert each(spark, ["30000/1001", "0/0", "25", "x", None, "1/2/3", "10/4"], parsing.rate) == [30000 / 1001, 0.0, 25.0, 0.0, 0.0, 0.0, 2.5]
    assert each(spark, ["29.97", "fast", None, ""], parsing.declared_fps) == [29.97, 0.0, 0.0, 0.0]


def test_urls(spark):
    assert each(spark, ["https://a.b/c d", "HTTP://x", "ftp://x", "https://", "/a", None], parsing.is_url) == [True, True, False, False, False, False]


def test_integers_and_floats(spark):
    rows = spark.createDataFrame([("5.9", "DOUBLE"), (" 5 ", "STRING"), ("1_000", "STRING"), ("5.5", "STRING"), ("true", "BOOLEAN"), ("1e3", "DOUBLE"), ("[1]", "ARRAY<BIGINT>"), ("99999999999999999999", "DECIMAL(20,0)")], "v string, k string")
    assert [r.x for r in rows.select(parsing.int_of(F.col("v"), F.col("k")).alias("x")).collect()] == [5, 5, 1000, None, 1, 1000, None, None]
    rows = spark.createDataFrame([("5.9", "DOUBLE"), ("inf", "STRING"), ("NaN", "STRING"), ("x", "STRING"), ("false", "BOOLEAN")], "v string, k string")
    got = [r.x for r in rows.select(parsing.float_of(F.col("v"), F.col("k")).alias("x")).collect()]
    assert got[:2] == [5.9, math.inf] and math.isnan(got[2]) and got[3:] == [None, 0.0]


def test_relevance(spark):
    texts = ["warehouse robot arm grasp pick place demonstration", "isaac sim simulation gameplay tutorial review", "robotic farm", "", "warehouse storage shelf rack pallet"]
    got = each(spark, texts, lambda t: relevance.relevance(t, WAREHOUSE))
    assert [(r.score, r.actions) for r in got] == [(8.0, ["grasp", "place"]), (-18.0, []), (4.5, []), (0.0, []), (6.0, [])]
    assert each(spark, ["a kitchen in an office", "nothing", "路口"], relevance.env_of) == ["residential_kitchen", "unknown", "urban_street"]
    assert each(spark, ["kitchen", "货架"], lambda t: relevance.scenario_of(t, WAREHOUSE)) == ["unknown", WAREHOUSE.scenario_type]


def scalar_hash(frame):
    n = perceptual.SIDE
    basis = [[(math.sqrt(1 / n) if k == 0 else math.sqrt(2 / n)) * math.cos(math.pi * (2 * i + 1) * k / (2 * n)) for i in range(n)] for k in range(8)]
    b = np.array(basis)
    block = [float(b[u] @ frame @ b[v]) for u in range(8) for v in range(8)]
    rest = sorted(block[1:])
    return sum(1 << (63 - i) for i, x in enumerate(block) if x > rest[31])


def test_perceptual_hashes(spark):
    rng = np.random.default_rng(3)
    frames = rng.integers(0, 256, (40, 32, 32), np.uint8)
    got = perceptual.hashes(frames).view(np.uint64).tolist()
    assert got == [scalar_hash(f.astype(float)) for f in frames]
    assert perceptual.signature([]) == [0] * 5
    one, two = frames[0].tobytes(), frames[1].tobytes()
    assert perceptual.signature([one, two], 4)[1:] == [perceptual.signature([two])[0]] * 3
    rows = spark.createDataFrame([([one],), (None,)], "f array<binary>").select(perceptual.signatures("f").alias("s"))
    assert [r.s for r in rows.collect()] == [perceptual.signature([one]), [0] * 5]
    assert spark.createDataFrame([(-1,), (10,)], "v long").select(perceptual.hex_of(F.col("v")).alias("h")).collect()[0].h == "f" * 16
