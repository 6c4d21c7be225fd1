"""Filters that reach a service, files in listings, calls in a pool, and counters in a plan."""

import json
import subprocess
import time
from datetime import datetime, timedelta, timezone
from email.utils import format_datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, StringContains

from reelspark.functions.taxonomy import WAREHOUSE
from reelspark.operators import files, media, pool, report, validation
from reelspark.sources import snapshot

from test_operators import GOOD, records


def test_filters_narrow_the_payload():
    own = WAREHOUSE.to_filter_params()
    narrow = lambda *filters: _all(own, filters)
    assert narrow(EqualTo(("camera_pov",), "wrist_mounted"))["camera_pov"] == ["wrist_mounted"]
    assert narrow(In(("camera_pov",), ("overhead", "third_person")))["camera_pov"] == ["third_person"]
    assert narrow(GreaterThanOrEqual(("duration_ms",), 5000), LessThan(("duration_ms",), 9000)) == own | {"min_duration_ms": 5000, "max_duration_ms": 8999}
    assert narrow(GreaterThan(("duration_ms",), 10))["min_duration_ms"] == 3000  # the tighter bound stays
    assert narrow(GreaterThanOrEqual(("height",), 720))["min_resolution_height"] == 720
    assert narrow(EqualTo(("scenario_type",), own["scenario_type"])) == own
    for other in (EqualTo(("scenario_type",), "x"), LessThan(("height",), 3), EqualTo(("raw",), "x"), StringContains(("env_context",), "x"), EqualTo(("duration_ms",), 3)):
        assert snapshot.with_filter(own, other) is None


def _all(payload, filters):
    for f in filters:
        payload = snapshot.with_filter(payload, f)
    return payload


ROWS = [{"scenario_type": "a" if i % 2 else "b", "env_context": f"e{i % 3}", "camera_pov": None, "start_ms": 0, "end_ms": 1000 * i, "height": i, "n": i} for i in range(50)]


class PagedClient:
    """Says in its records what it was asked for."""

    def trigger(self, dataset_id, payload, extra=None):
        return json.dumps(payload)

    def wait_ready(self, snapshot_id, **wait):
        return 0

    def pages(self, snapshot_id, page_size):
        return -(-len(ROWS) // page_size)

    def download(self, snapshot_id, *, page=None, page_size=None):
        rows = ROWS if page is None else ROWS[page * page_size : (page + 1) * page_size]
        return [x | {"asked": snapshot_id} for x in rows if snapshot.asked_for(x, json.loads(snapshot_id)[0])]


def test_pushed_filters_and_pages(spark):
    read = lambda **options: snapshot.collect(spark, "d", [{"limit": 9}], client=PagedClient(), **options)
    wanted = (F.col("scenario_type") == "a") & F.col("env_context").isin("e1", "e2") & (F.col("duration_ms") >= 7000) & (F.col("duration_ms") < 40_000) & (F.length("raw") > 3)
    every = read().select("ord", "raw").collect()
    assert [json.loads(r.raw)["n"] for r in sorted(every)] == [*range(50)] and {json.loads(r.raw)["asked"] for r in every} == {'[{"limit": 9}]'}
    told = {}
    for name, options in (("pushed", {}), ("paged", {"page_size": 7}), ("not", {"pushdown": "false", "page_size": 7})):
        df = read(**options).filter(wanted)
        told[name] = sorted((json.loads(r.raw)["n"], r.duration_ms, json.loads(r.raw)["asked"]) for r in df.collect())
        # whatever the service does, the engine looks again
        assert "Filter" in df._jdf.queryExecution().executedPlan().toString()
    want = [x["n"] for x in ROWS if x["scenario_type"] == "a" and x["env_context"] in ("e1", "e2") and 7000 <= x["end_ms"] < 40_000]
    assert all([n for n, _, _ in found] == want for found in told.values())
    asked = {name: json.loads(found[0][2])[0] for name, found in told.items()}
    assert asked["pushed"] == asked["paged"] == {"limit": 9, "scenario_type": "a", "env_context": ["e1", "e2"], "min_duration_ms": 7000, "max_duration_ms": 39_999}
    assert asked["not"] == {"limit": 9}
    pages = read(page_size=7)
    assert pages.rdd.getNumPartitions() == 8 and sorted(r.ord for r in pages.collect()) == [*range(50)]


def test_retry_after_is_a_number_or_a_date():
    later = format_datetime(datetime.now(timezone.utc) + timedelta(seconds=50), usegmt=True)
    assert snapshot.retry_after("7", 2.0) == 7 and 45 < snapshot.retry_after(later, 2.0) <= 50
    assert snapshot.retry_after(None, 2.0) == snapshot.retry_after("soon", 2.0) == 2.0 and snapshot.retry_after("Wed, 21 Oct 2015 07:28:00 GMT", 2.0) == 0


def test_files_in_a_listing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/one.mp4").write_bytes(b"xyz")
    (tmp_path / "two three.mp4").write_bytes(b"x")
    (tmp_path / "empty.mp4").write_bytes(b"")
    found = files.listing(spark, str(tmp_path), f"file:{tmp_path}/a", str(tmp_path / "none"))
    assert sorted(map(tuple, found.collect())) == [(f"{tmp_path}/a/one.mp4", 3), (f"{tmp_path}/two three.mp4", 1)]
    uris = [f"{tmp_path}/a/one.mp4", f"file://{tmp_path}//a/./one.mp4", "a/one.mp4", "two three.mp4", "empty.mp4", "none.mp4", None, "", "a/one.mp4", "s3://b/a/one.mp4"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(uris)], "ord int, video_uri string")
    got = files.with_presence(df, found, folder=str(tmp_path)).orderBy("ord").collect()
    assert [r.present for r in got] == [True, True, True, True, False, False, False, True, True, False] and [r.file_size for r in got][:5] == [3, 3, 3, 1, None]
    assert files.listing(spark, str(tmp_path / "none")).count() == 0
    there = media.probed(files.with_presence(df, found, folder=str(tmp_path)), lambda args, t: (1, b"")).orderBy("ord").collect()
    assert [r.error for r in there] == ["ffprobe_failed"] * 10 and [r.present for r in there] == [r.present for r in got]


def test_calls_keep_their_order():
    running, most = [0], [0]

    def call(i):
        running[0] += 1
        most[0] = max(most[0], running[0])
        time.sleep(0.002 * (i % 5))
        running[0] -= 1
        if i % 10 == 3:
            raise ValueError(i)
        return i

    assert [*pool.in_order(range(60), call, lambda i, e: -i, workers=6)] == [-i if i % 10 == 3 else i for i in range(60)]
    assert 1 < most[0] <= 6 and [*pool.in_order([], call, None, workers=2)] == []


@pytest.mark.parametrize("workers", (1, 4))
def test_a_call_that_hangs_is_one_error(workers):
    call = lambda i: time.sleep(3600) if i == 10 else i
    began = time.monotonic()
    found = [*pool.in_order(range(100), call, lambda i, e: type(e).__name__, workers=workers, seconds=0.5)]
    assert [x for x in found if x != "CallTimeout"] == [i for i in range(100) if i != 10] and found[10] == "CallTimeout" and time.monotonic() - began < 20


def hangs(args, timeout):
    """A tool that never ends for one file."""
    if args[-1].endswith("/13.mp4"):
        time.sleep(3600)
    return 0, json.dumps({"streams": [{"width": 640, "height": 480, "r_frame_rate": "30/1"}], "format": {"duration": "3"}}).encode()


def late(args, timeout):
    raise subprocess.TimeoutExpired(args, timeout)


def test_a_tool_that_hangs_on_one_row(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"{i}.mp4").write_text("x")
    df = spark.createDataFrame([(i, f"{tmp_path}/{i}.mp4", ("other", i)) for i in range(100)], "ord long, video_uri string, more struct<a:string,b:long>").coalesce(2)
    got = media.probed(df, hangs, seconds=1.0).orderBy("ord").collect()
    assert [r.ok for r in got] == [i != 13 for i in range(100)] and got[13].error == "ffprobe_timeout" and got[5].more.b == 5
    clip = {"clip_id": "c", "video_uri": "", "source_url": "https://a.b/c", "start_ms": 0, "end_ms": 3000}
    assert media.download_clip(clip, str(tmp_path / "d"), tool=late) == ("", "download_failed")
    clips = spark.createDataFrame([(0, "c", "", "https://a.b/c", 0, 3000)], "ord long, clip_id string, video_uri string, source_url string, start_ms long, end_ms long")
    assert media.downloaded(clips, str(tmp_path / "d"), tool=late).first().download_error == "download_failed"
    assert media.signed(clips.withColumn("duration_ms", F.lit(3000)), 5, late).first().sig == [0] * 5


def test_counters_in_a_plan(spark):
    rows = [GOOD] * 3 + [GOOD | {"fps": 1, "end_ms": 5300}] * 2 + [GOOD | {"fps": ""}]
    seen = report.Observed()
    judged = seen.watch(validation.checked(records(spark, rows), WAREHOUSE), {"fetched": F.lit(True), "ok": F.col("ok")}, reasons="reasons", kinds=validation.RECORD_REASONS)
    judged.filter("ok").write.format("noop").mode("overwrite").save()
    assert seen.counts() == {"fetched": 6, "ok": 3} and seen.reasons() == {"fps_too_low": 2, "too_short": 2, "missing_field": 1}
    none = report.Observed()
    none.watch(judged.limit(0), {"n": F.col("ok")}, reasons="reasons", kinds=("x",)).write.format("noop").mode("overwrite").save()
    assert none.counts() == {"n": 0} and none.reasons() == {}
