import json
import random
import subprocess
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelspark.functions.taxonomy import WAREHOUSE
from reelspark.operators import labelling, manifest, media, near_duplicates, report, validation

GOOD = {"scenario_type": "warehouse_pick_and_place", "env_context": "industrial_warehouse", "camera_pov": "third_person", "actions": ["reach", "grasp", "lift", "place"], "start_ms": 5200, "end_ms": 19800, "fps": 30, "source_url": "https://example.com/v/abc"}


def records(spark, rows):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) for i, r in enumerate(rows)], "ord long, raw string")


def reasons(spark, rows, **options):
    return [[x.split(":")[0] for x in r.reasons] for r in validation.checked(records(spark, rows), WAREHOUSE, **options).orderBy("ord").collect()]


def test_validation_reasons(spark):
    rows = [
        GOOD, GOOD | {"actions": ["grasp"], "fps": 8, "end_ms": 6000}, {k: v for k, v in GOOD.items() if k != "camera_pov"}, GOOD | {"fps": ""}, GOOD | {"start_ms": 0}, GOOD | {"start_ms": "x"},
        GOOD | {"start_ms": "1_000", "end_ms": " 9000 "}, GOOD | {"start_ms": 19800, "end_ms": 100}, GOOD | {"actions": "grasp"}, GOOD | {"actions": []}, GOOD | {"actions": 0}, GOOD | {"env_context": "office"},
        GOOD | {"env_context": "moon", "camera_pov": "x", "scenario_type": "y"}, GOOD | {"camera_pov": "overhead"}, GOOD | {"actions": [*GOOD["actions"], "fly", "fly"]}, GOOD | {"end_ms": 90000}, GOOD | {"fps": "nan"}, GOOD | {"fps": True}, "{}",
    ]
    assert reasons(spark, rows) == [
        [], ["fps_too_low", "too_short", "incomplete_actions"], ["missing_field"], ["missing_field"], [], ["type_error"], [], ["invalid_window", "too_short"], ["type_error"], ["missing_field"], ["incomplete_actions"], [],
        ["scenario_mismatch", "unknown_pov", "unknown_env"], ["pov_out_of_scope"], ["unknown_actions"], ["too_long"], [], ["fps_too_low"], ["missing_field"] * 7,
    ]
    assert reasons(spark, [GOOD | {"actions": []}, GOOD | {"actions": ""}, GOOD | {"actions": ["grasp"]}, GOOD | {"actions": None}], relaxed=True) == [[], ["missing_field"], [], ["missing_field"]]


def test_validated_records(spark):
    dup = '{"start_ms": 1, ' + json.dumps(GOOD)[1:]
    got = validation.checked(records(spark, [GOOD, GOOD | {"_vendor": None, "_label_source": "x"}, GOOD | {"start_ms": 5200.0}, GOOD | {"source_url": "", "video_uri": "a.mp4"}, dup]), WAREHOUSE).orderBy("ord").collect()
    assert got[0].record.clip_id == "clip_061ba2d471913ce0" and got[0].record.provenance.vendor == "unknown" and got[0].record.provenance.label_source == "vendor_provided"
    assert got[1].record.provenance.vendor is None and got[1].record.provenance.label_source == "x"
    assert got[2].record.start_ms == 5200 and got[2].record.clip_id != got[0].record.clip_id
    assert got[3].record.video_uri == "a.mp4" and got[4].record.start_ms == 5200
    assert validation.checked(records(spark, []), WAREHOUSE).count() == 0
    relaxed = validation.checked(records(spark, [GOOD]), WAREHOUSE, relaxed=True).first()
    assert (relaxed.record.provenance.label_source, relaxed.record.provenance.clip_boundary) == ("inferred_from_text", "fixed_window")


def test_histogram_counts_reasons(spark):
    found = validation.histogram(validation.checked(records(spark, [GOOD | {"fps": 1, "end_ms": 5300}] * 3 + [GOOD]), WAREHOUSE))
    assert {r.reason: r.n for r in found.collect()} == {"fps_too_low": 3, "too_short": 3}


def test_labelling(spark):
    tube = {"url": "https://youtube.com/watch?v=abc", "video_length": 120, "title": "Warehouse robot", "description": " arm grasp ", "tags": ["Pick", ""], "current_optimal_res": "720p"}
    rows = [tube, tube | {"url": ""}, tube | {"video_length": "x"}, tube | {"title": "cats", "description": ""}, tube | {"video_length": 2}, tube | {"video_length": "0:47"}]
    judged = labelling.judged(labelling.adapt(records(spark, rows), "youtube"), WAREHOUSE)
    assert [r.reason for r in judged.orderBy("ord").collect()] == [None, "no_url", "no_duration", "low_score", "no_window", None]
    first = labelling.adapt(records(spark, rows), "youtube").orderBy("ord").first()
    assert (first.duration_ms, first.height, first.text) == (120000, 720, "warehouse robot arm grasp pick")
    clips = labelling.clips(judged, WAREHOUSE).orderBy("ord", "win").collect()
    assert [(c.ord, c.win, c.start_ms, c.end_ms) for c in clips] == [(0, 0, 0, 45000), (0, 1, 45000, 90000), (0, 2, 90000, 120000), (5, 0, 0, 45000)]
    assert clips[0]._vendor == "unknown" and clips[0].fps == 30.0 and clips[0]._declared_height == 720
    tok = {"网址": "https://t/1", "video_duration": 30, "description": "warehouse robot arm", "hashtags": ["grasp"], "title": "unused"}
    short = labelling.judged(labelling.adapt(records(spark, [tok, tok | {"video_duration": 1}, tok | {"video_duration": 100}]), "tiktok"), WAREHOUSE).orderBy("ord").collect()
    assert [[tuple(w) for w in r.windows] for r in short] == [[(0, 30000)], [], [(0, 100000)]] and "unused" not in short[0].text
    with pytest.raises(ValueError):
        labelling.adapt(records(spark, [tok]), "other")


def test_probe_problems(spark):
    fields = "ok boolean, duration_ms long, fps double, width int, height int, nb_frames int, error string, codec string"
    good = (True, 14600, 30.0, 1280, 720, 400, "", "h264")
    rows = [good, (False, *good[1:6], "ffprobe_failed", ""), (True, 2000, 10.0, 640, 360, 1, "", "h264"), (True, 14600, float("nan"), 1280, 720, 400, "", "h264"), (True, 14600, 28.5, 1280, 720, 400, "", "h264"), (True, 14600, 28.4, 1280, 720, 400, "", "h264")]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, p struct<{fields.replace(' ', ':').replace(',:', ',')}>")
    got = df.select("i", validation.probe_problems(F.lit(14600), F.lit(30.0), F.col("p"), WAREHOUSE).alias("x")).orderBy("i").collect()
    assert [[x.split(":")[0] for x in r.x] for r in got] == [[], ["probe_failed"], ["resolution_too_low", "real_fps_too_low", "real_duration_too_short", "not_a_video", "duration_mismatch", "fps_mismatch"], [], [], ["fps_mismatch"]]


def brute_clusters(sigs, most):
    group = list(range(len(sigs)))
    for i in range(len(sigs)):
        for j in range(i):
            if sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(sigs[i], sigs[j])) <= most and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_against_brute_force(spark, seed):
    rng = random.Random(seed)
    sigs = [[rng.getrandbits(63) for _ in range(5)] for _ in range(25)] + [[0] * 5] * 3
    for base in rng.sample(sigs[:25], 12):
        near = list(base)
        for b in rng.sample(range(315), rng.choice([0, 20, 39, 40, 41, 60])):
            near[b // 63] ^= 1 << (b % 63)
        sigs.append(near)
    df = spark.createDataFrame([(i, s, rng.choice([1.0, 2.0, None])) for i, s in enumerate(sigs)], "ord long, sig array<long>, quality double")
    found = near_duplicates.clusters(df.select("ord", "sig"), 8.0, 5)
    group = {r.ord: r.cluster for r in found.collect()}
    assert [group[i] for i in range(len(sigs))] == brute_clusters(sigs, 40)
    won = near_duplicates.winners(found.join(df.select("ord", "quality"), "ord"))
    quality = {r.ord: r.quality if r.quality is not None else -1 for r in df.collect()}
    kept = {r.cluster: r.ord for r in won.filter("keep").collect()}
    assert kept == {c: min((i for i in group if group[i] == c), key=lambda i: (-quality[i], i)) for c in set(group.values())}
    rate = near_duplicates.rates(won).first()
    assert rate.n == len(sigs) and rate.clusters + rate.dropped == rate.n
    assert near_duplicates.rates(won.limit(0)).first().duplicate_rate == 0.0


def test_crowded_signatures_have_few_links(spark):
    """5,000 signatures next to one, and others at random, against all pairs."""
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 5, np.uint64)
    rows = []
    for i in range(5000):
        near = base.copy()
        for b in rng.choice(320, rng.integers(0, 9), replace=False):
            near[b // 64] ^= np.uint64(1 << int(b % 64))
        rows.append(near)
    edge = base.copy()  # only some of the crowd are near enough to it
    for b in range(38):
        edge[b % 5] ^= np.uint64(1 << b)
    rows += [edge, *rng.integers(0, 1 << 63, (300, 5), np.uint64)]
    sigs = np.unique(np.array(rows), axis=0)
    df = spark.createDataFrame([(i, [int(x) for x in s.view(np.int64)]) for i, s in enumerate(sigs)], "ord long, sig array<long>")
    edges = near_duplicates.links(df, 40, 5).collect()
    assert len(edges) < 50_000
    group = np.arange(len(sigs))
    for i in range(len(sigs)):
        near = np.flatnonzero(np.bitwise_count(sigs ^ sigs[i]).sum(axis=1) <= 40)
        group[np.isin(group, np.unique(group[near]))] = group[near].min()
    from reelspark.operators.components import connected_components

    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges)).collect()}
    assert [found.get(i, i) for i in range(len(sigs))] == group.tolist() and len(set(group.tolist())) == 301


def test_probe_parsing():
    told = {"streams": [{"width": 1280, "height": 720, "r_frame_rate": "30000/1001", "codec_name": "h264", "nb_read_packets": "90"}], "format": {"duration": "12.345"}}
    probe = lambda x, code=0: media.probe("a", lambda args, t: (code, x if isinstance(x, bytes) else json.dumps(x).encode()))
    got = probe(told)
    assert (got["ok"], got["duration_ms"], round(got["fps"], 2), got["nb_frames"]) == (True, 12345, 29.97, 90)
    assert probe({"streams": []})["error"] == "no_video_stream" and probe(b"x")["error"] == "ffprobe_bad_json" and probe(told, 1)["error"] == "ffprobe_failed"
    odd = probe({"streams": [{"r_frame_rate": "0/0"}], "format": {"duration": "N/A"}})
    assert odd["ok"] and (odd["duration_ms"], odd["fps"], odd["height"]) == (0, 0.0, 0)

    def late(args, timeout):
        raise subprocess.TimeoutExpired(args, timeout)

    assert media.probe("a", late)["error"] == "ffprobe_timeout"


def test_downloads(tmp_path):
    calls = []

    def tool(args, timeout, section=True, full=True):
        calls.append(args)
        if "--download-sections" in args and not section or "--download-sections" not in args and not full:
            return 1, b""
        target = args[args.index("-o") + 1] if "-o" in args else args[-1]
        open(target, "wb").write(b"x")
        return 0, b""

    clip = {"clip_id": "c", "video_uri": "", "source_url": "https://a.b/c", "start_ms": 1000, "end_ms": 3000}
    assert media.download_clip(clip, str(tmp_path / "a"), tool=tool) == (str(tmp_path / "a/c.mp4"), None) and len(calls) == 1
    assert media.download_clip(clip, str(tmp_path / "a"), tool=tool)[1] is None and len(calls) == 1
    assert media.download_clip(clip, str(tmp_path / "b"), tool=lambda a, t: tool(a, t, section=False))[1] is None
    assert not (tmp_path / "b/c.full.mp4").exists()
    assert media.download_clip(clip, str(tmp_path / "d"), tool=lambda a, t: (1, b""))[1] == "download_failed"
    assert media.download_clip(clip | {"source_url": "x"}, str(tmp_path / "d"))[1] == "no_download_url"
    assert media.normalize_fps("a", str(tmp_path / "n.mp4"), tool=tool) and "scale=-2:480" in calls[-1][calls[-1].index("-vf") + 1]
    with pytest.raises(RuntimeError):
        media.check_downloader(lambda a, t: (1, b""))


def test_frames():
    seen = []
    frames = media.grey_frames("a", 2000, tool=lambda args, t: (seen.append(args), (1, bytes(1024 * 2 + 5)))[1])
    assert len(frames) == 2 and "fps=2.500000,scale=32:32" in seen[0]


def test_manifest(spark, tmp_path):
    from reelspark.sources.records import read_manifest

    clips = validation.checked(records(spark, [GOOD | {"source_url": f"ü{i}", "geo_region": "DE" if i else ""} for i in range(3)]), WAREHOUSE).select("ord", F.col("record").withField("duration_ms", F.lit(250).cast("long")).alias("record"))
    path = str(tmp_path / "m.jsonl")
    head = manifest.write_manifest(clips, path, dataset_name="d", version="v1")
    assert head["n_samples"] == 3 and head["geo_distribution"] == {"unknown": 1, "DE": 2} and head["total_duration_s"] == 0.8
    text = open(path, encoding="utf-8").read().splitlines()
    assert json.loads(text[0]) == head and [json.loads(x)["source_url"] for x in text[1:]] == ["ü0", "ü1", "ü2"]
    assert list(json.loads(text[1]))[:2] == ["clip_id", "video_uri"] and json.loads(text[1])["phash"] is None
    header, rows = read_manifest(spark, path)
    assert header.count() == 1 and rows.count() == 3
    assert manifest.read_samples(spark, path, lambda df: df.select("scenario")).first().scenario == WAREHOUSE.scenario_type
    open(path, "w").write("\n" + "\n".join(text) + "\n\n")
    header, rows = read_manifest(spark, path)
    assert header.count() == 0 and rows.count() == 4
    assert manifest.write_manifest(clips.limit(0), path, dataset_name="d", version="v")["n_samples"] == 0


def test_report(spark):
    told = report.summary({"fetched": 10, "schema_valid": 5, "training_ready": 4}, {"a": 2, "b": 0, "c": 3}, {"fetch_s": 1.0}, {"n_samples": 4})
    assert told["funnel"] == {"fetched": 10, "schema_valid": 5, "file_present": 0, "probe_valid": 0, "unique": 0, "training_ready": 4, "usable_yield": 0.4}
    assert report.per(2, 4, float("inf")) == 0.5 and report.per(1, 0, float("inf")) == float("inf") and report.summary({}, {}, {}, {})["funnel"]["usable_yield"] == 0
    lines = report.rendered(told).splitlines()
    assert lines[0].split() == ["fetched", "10", "100.0%"] and lines[6].split() == ["usable", "yield", "40.0%"] and [x.split() for x in lines[7:]] == [["c", "3"], ["a", "2"]]
    one = spark.createDataFrame([(10, 5, 4)], "fetched long, schema_valid long, training_ready long")
    assert [tuple(r)[1:] for r in report.shares(one).orderBy("place").collect()][:2] == [("fetched", 10, 1.0), ("schema_valid", 5, 0.5)]
    searched = spark.createDataFrame([(9, 4)], "discovered long, labeled long")
    assert [tuple(r)[1:] for r in report.shares(searched).orderBy("place").collect()][:3] == [("discovered", 9, 2.25), ("labeled", 4, 1.0), ("schema_valid", 0, 0.0)]
    part = spark.createDataFrame([("a", 1), ("b", 0), ("c", 3)], "reason string, n long")
    assert sorted(map(tuple, report.ranked(report.merged(part, part.filter("reason = 'a'"))).collect())) == [(1, "c", 3), (2, "a", 2)]


def test_bands_grow_with_the_rows():
    """Work of a row grows far slower than the rows, and every choice covers the distance."""
    work = {}
    for rows in (10, 10**3, 10**5, 10**7, 10**9):
        bands, far, near = near_duplicates.banding(rows, 320, 40)
        assert bands * (far + near + 1) > 40
        width = 320 // bands
        copies = [len(near_duplicates._flips(width, r)) for r in (far, near)]
        work[rows] = bands * sum(copies) + rows * bands * copies[0] * copies[1] / 2**width
    assert work[10**5] < 20 * work[10**3] and work[10**9] < 10**9 / 100
    bands, far, near = near_duplicates.banding(10, 64, 64)
    assert bands * (far + near + 1) > 64


def test_the_downloader_is_the_callers(tmp_path):
    own = media.Downloader(program=("own", "get"), section=("{url}", "{start:.0f}", "{target}"), whole=("{url}", "{target}"))
    calls = []

    def tool(args, timeout):
        calls.append(args)
        if args[0] == "own" and len(args) == 5:
            return 1, b""
        open(args[-1], "wb").write(b"x")
        return 0, b""

    target = str(tmp_path / "c.mp4")
    assert media.fetch_section("https://a", target, 2.0, 5.0, tool, own)
    assert calls[0] == ["own", "get", "https://a", "2", target] and calls[1][:3] == ["own", "get", "https://a"] and calls[2][0] == "ffmpeg"
    assert [p.name for p in tmp_path.iterdir()] == ["c.mp4"]


def _kept_bytes(spark):
    where = spark.sparkContext.getCheckpointDir()
    return sum(f.stat().st_size for f in Path(where.removeprefix("file:")).rglob("part-*")) if where else 0


@pytest.mark.parametrize(("n", "most"), [(1, 17), (5, 40)])
def test_links_keep_little_on_disk(spark, n, most):
    """What links() writes is a few keys a row, not the pairs that meet by chance; blocks of a few rows change nothing."""
    import numpy as np

    rng = np.random.default_rng(5)
    sigs = rng.integers(0, 1 << 60, (1500, n), np.uint64)
    for i in range(750, 1500):
        for b in rng.choice(60 * n, most + rng.integers(-3, 3), replace=False):
            sigs[i, b // 60] = sigs[i, b // 60] if b % 60 == 0 and i % 2 else sigs[i - 750, b // 60] ^ np.uint64(1 << int(b % 60))
    sigs = np.unique(sigs, axis=0)
    df = near_duplicates.checkpoint(spark.createDataFrame([(i, [int(x) for x in s]) for i, s in enumerate(sigs)], "ord long, sig array<long>"))
    before = _kept_bytes(spark)
    edges = near_duplicates.links(df, most, n).collect()
    assert _kept_bytes(spark) - before < 1_000_000
    group = np.arange(len(sigs))
    for i in range(len(sigs)):
        near = np.flatnonzero(np.bitwise_count(sigs ^ sigs[i]).sum(axis=1) <= most)
        group[np.isin(group, np.unique(group[near]))] = group[near].min()
    from reelspark.operators.components import connected_components

    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [found.get(i, i) for i in range(len(sigs))] == group.tolist()


@pytest.mark.parametrize("plain", [1 << 24, 10])
@pytest.mark.parametrize(("n", "most"), [(1, 17), (1, 3), (3, 20), (5, 4), (2, 1)])
def test_hamming_pairs_in_blocks(spark, monkeypatch, n, most, plain):
    """All pairs, in blocks of a few rows, with copies, negative hashes and bits that never change."""
    import numpy as np

    monkeypatch.setattr(near_duplicates, "BLOCK", 40)
    monkeypatch.setattr(near_duplicates, "SMALL", 30)
    monkeypatch.setattr(near_duplicates, "PLAIN", plain)
    rng = np.random.default_rng(most)
    sigs = rng.integers(0, 1 << 64, (200, n), np.uint64)
    sigs[100:] = sigs[:100]
    for i in range(120, 200):
        for b in rng.choice(64 * n, rng.integers(0, most + 3), replace=False):
            sigs[i, b // 64] ^= np.uint64(1 << int(b % 64))
    sigs[:, 0] |= np.uint64(0xF0)
    df = spark.createDataFrame([(i, [int(x) for x in s.view(np.int64)]) for i, s in enumerate(sigs)], "ord long, sig array<long>")
    away = np.bitwise_count(sigs[:, None] ^ sigs[None]).sum(axis=2)
    assert sorted(map(tuple, near_duplicates.hamming_pairs(df, most, n).collect())) == [(a, b, int(away[a, b])) for a in range(200) for b in range(a + 1, 200) if away[a, b] <= most]
    assert near_duplicates.hamming_pairs(df.limit(0), most, n).count() == 0
