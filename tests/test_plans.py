import json
import time

import pytest

from reelspark.functions.taxonomy import WAREHOUSE
from reelspark.operators import manifest
from reelspark.plans import curation, discovery
from reelspark.sources import records, snapshot
from reelspark.streaming import clips as stream

from test_operators import GOOD


class Response:
    def __init__(self, status, body=b"", headers=()):
        self.status_code, self.headers = status, dict(headers)
        self.content = body if isinstance(body, bytes) else json.dumps(body).encode()
        self.text = self.content.decode()

    def json(self):
        return json.loads(self.text)


def client(answers, waits=None, **options):
    answers = iter(answers)

    def http(method, url, **kw):
        got = next(answers)
        if isinstance(got, Exception):
            raise got
        return got

    return snapshot.Client("key", "http://x", http=http, sleep=(waits if waits is not None else []).append, **options)


def test_requests_are_tried_again():
    waits = []
    got = client([OSError(), Response(429, headers={"Retry-After": "500"}), Response(503), Response(200, {"a": 1})], waits).request("GET", "/p")
    assert got == {"a": 1} and waits[0] == 2.0 and 120 <= waits[1] <= 121.5 and waits[2] == 8.0
    assert client([Response(200)]).request("GET", "/p") is None and client([Response(200, b"x")]).request("GET", "/p") == "x"
    with pytest.raises(RuntimeError, match="404"):
        client([Response(404, b"no")]).request("GET", "/p")
    with pytest.raises(RuntimeError, match="6 times"):
        client([Response(500)] * 6).request("GET", "/p")


def test_snapshots():
    assert client([Response(200, {"status": "running"}), Response(200, {"status": "ready"})]).wait_ready("s") >= 0
    with pytest.raises(snapshot.SnapshotFailed):
        client([Response(200, {"status": "error"})]).wait_ready("s")
    ticks = iter([0, 10, 5000])
    with pytest.raises(snapshot.SnapshotTimeout):
        client([Response(200, {"status": "running"})] * 3, clock=lambda: next(ticks)).wait_ready("s")
    assert client([Response(200, [{"a": 1}])]).download("s") == [{"a": 1}] and client([Response(200, b'{"a": 1}\n\n{"a": 2}')]).download("s")[-1:] != []
    assert client([Response(200)]).download("s") == [] and client([Response(200, {"snapshot_id": "q"})]).trigger("d", []) == "q"


class FakeClient:
    def trigger(self, dataset_id, payload, extra=None):
        return f"snap-{dataset_id}-{len(payload)}-{(extra or {}).get('discover_by')}"

    def wait_ready(self, snapshot_id, **kw):
        return 0

    def download(self, snapshot_id):
        return [{"url": "ü", "n": 5.0}, {"url": "b"}]


class FakeSource(snapshot.SnapshotSource):
    client = FakeClient

    @classmethod
    def name(cls):
        return "fake_snapshot"


def test_data_source(spark):
    rows = [json.loads(r.raw) for r in snapshot.discover(spark, "d", ["q1", "q2"], source=FakeSource).orderBy("ord").collect()]
    assert [r["url"] for r in rows] == ["ü", "b"] and rows[0]["_snapshot_id"] == "snap-d-2-keyword" and rows[0]["n"] == 5.0


def test_dataset_choice(spark, monkeypatch):
    offline = records.offline_datasets(spark)
    assert snapshot.match_dataset_id(offline, "youtube") == "gd_yt_videos" and snapshot.match_dataset_id(offline, "tiktok") == "gd_tt_posts"
    odd = spark.createDataFrame([(0, "", "tiktok posts"), (1, "x", "TikTok Post list"), (2, "y", "my TikTok - Posts")], "ord int, id string, name string")
    assert snapshot.match_dataset_id(odd, "tiktok") == "y" and snapshot.match_dataset_id(odd.filter("ord < 2"), "tiktok") == "x"
    with pytest.raises(snapshot.DatasetNotAvailable):
        snapshot.match_dataset_id(odd, "vimeo")
    monkeypatch.setenv("SNAPSHOT_DATASET_ID_VI", "env")
    assert snapshot.match_dataset_id(odd, "vimeo") == "env"


def test_client_choice(monkeypatch, tmp_path):
    monkeypatch.delenv("SNAPSHOT_API_KEY", raising=False)
    assert snapshot.get_client(str(tmp_path)) is None
    with pytest.raises(RuntimeError):
        snapshot.get_client()
    monkeypatch.setenv("SNAPSHOT_API_KEY", "k")
    assert isinstance(snapshot.get_client(), snapshot.Client)


def test_record_files(spark, tmp_path):
    (tmp_path / records.RESPONSE).write_text(json.dumps([{"a": 5.0, "_vendor": "x"}, {}, {"b": [1]}, {"c": "}"}]))
    got = [json.loads(r.raw) for r in records.collect_offline(spark, str(tmp_path)).orderBy("ord").collect()]
    assert [r["_vendor"] for r in got] == ["mock"] * 4 and got[0]["a"] == 5.0 and got[2]["b"] == [1] and got[3]["c"] == "}"
    found = records.discover_offline(spark, str(tmp_path), ["q"], "ds", 2).orderBy("ord").collect()
    assert len(found) == 2 and json.loads(found[0].raw)["_dataset_id"] == "ds"
    (tmp_path / "l.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    assert [json.loads(r.raw)["a"] for r in records.read_lines(spark, str(tmp_path / "l.jsonl")).orderBy("ord").collect()] == [1, 2]


def tool(args, timeout):
    """Files say themselves what they hold: height, length, rate and a byte for their frames."""
    if args[0] == "ffprobe":
        if not args[-1]:
            return 1, b""
        height, ms, rate, _ = open(args[-1]).read().split()
        if height == "bad":
            return 1, b""
        return 0, json.dumps({"streams": [{"width": int(height) * 16 // 9, "height": int(height), "r_frame_rate": f"{rate}/1", "codec_name": "h264", "nb_read_packets": "99"}], "format": {"duration": str(int(ms) / 1000)}}).encode()
    import random

    rng = random.Random(open(args[args.index("-i") + 1]).read().split()[3])
    return 0, bytes(rng.randrange(256) for _ in range(5 * 1024))


def test_curation(spark, tmp_path):
    ms = GOOD["end_ms"] - GOOD["start_ms"]
    files = [f"480 {ms} 30 a", f"720 {ms} 30 a", f"720 {ms} 30 b", f"360 {ms} 30 c", f"720 {ms * 2} 30 d", "bad 0 0 0", None, f"720 {ms} 30 e"]
    rows = []
    for i, text in enumerate(files):
        path = tmp_path / f"{i}.mp4"
        if text:
            path.write_text(text)
        rows.append(GOOD | {"video_uri": str(path), "source_url": f"https://e/{i}"} | ({"fps": 5} if i == 7 else {}))
    (tmp_path / records.RESPONSE).write_text(json.dumps(rows))
    report = curation.run(spark, str(tmp_path), str(tmp_path / "out"), tool=tool, total_cost=1.0, version="v1")
    assert [report["funnel"][k] for k in ("fetched", "schema_valid", "file_present", "probe_valid", "unique")] == [8, 7, 6, 3, 2]
    assert report["reject_reasons"] == {"fps_too_low": 1, "resolution_too_low": 1, "duration_mismatch": 1, "probe_failed": 1, "file_missing": 1, "near_duplicate": 1}
    lines = [json.loads(x) for x in (tmp_path / "out/manifest.jsonl").read_text().splitlines()]
    assert [x["source_url"] for x in lines[1:]] == ["https://e/1", "https://e/2"] and len(lines[1]["phash"]) == 16 and lines[1]["height"] == 720
    told = json.loads((tmp_path / "out/report.json").read_text())
    assert told == report
    assert told["funnel"]["usable_yield"] == 0.25 and told["cost_per_usable_clip"] == 0.5


def test_discovery_then_curation(spark, tmp_path):
    tube = {"url": "https://y/1", "video_length": 120, "title": "Warehouse robot arm grasp", "fps": 25}
    (tmp_path / records.DISCOVERY).write_text(json.dumps([tube, tube | {"url": "https://y/2", "video_length": 20}, tube | {"url": ""}, tube | {"title": "cats", "url": "https://y/3"}]))
    report = discovery.run(spark, str(tmp_path), str(tmp_path / "found"), max_clips=2)
    assert report["funnel"] == {"discovered": 8, "labeled": 4, "url_deduped": 4, "final": 2} and report["reject_reasons"]["url_duplicate"] == 2
    rows = json.loads((tmp_path / "found" / records.RESPONSE).read_text())
    assert [r["source_url"] for r in rows] == ["https://y/1", "https://y/2"] and rows[0]["start_ms"] == 0 and rows[0]["_label_source"] == "inferred_from_text"
    done = curation.run(spark, str(tmp_path / "found"), str(tmp_path / "out"), relaxed=True, tool=tool)
    # without a download the path is empty, which stands for the working folder: there, but no video
    assert [done["funnel"][k] for k in ("fetched", "schema_valid", "file_present", "probe_valid")] == [2, 2, 2, 0]


def test_stream_lets_an_id_through_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n".join(json.dumps(GOOD | {"source_url": f"https://e/{i % 2}"}) for i in range(4)) + "\n" + json.dumps(GOOD | {"fps": 1}))
    found = stream.valid_once(stream.record_stream(spark, str(tmp_path / "in")), WAREHOUSE)
    run = found.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert spark.table("once").count() == 2


class OwnClient(FakeClient):
    """A client that says what it was asked for, in its records."""

    def __init__(self, rows):
        self.rows = rows

    def download(self, snapshot_id):
        return [r | {"asked": snapshot_id} for r in self.rows]

    def list_datasets(self):
        return [{"id": "d1", "name": "YouTube - Videos posts", "type": "video"}]


def test_a_given_client_is_used(spark, tmp_path, monkeypatch):
    monkeypatch.delenv("SNAPSHOT_API_KEY", raising=False)
    ms = GOOD["end_ms"] - GOOD["start_ms"]
    (tmp_path / "0.mp4").write_text(f"720 {ms} 30 a")
    own = OwnClient([GOOD | {"video_uri": str(tmp_path / "0.mp4")}, GOOD | {"fps": 1}])
    rows = [json.loads(r.raw) for r in snapshot.collect(spark, "d", [{}], client=own).orderBy("ord").collect()]
    assert [r["asked"] for r in rows] == ["snap-d-1-None"] * 2
    report = curation.run(spark, str(tmp_path), str(tmp_path / "out"), dataset_id="d", client=own, tool=tool)
    assert [report["funnel"][k] for k in ("fetched", "schema_valid", "unique")] == [2, 1, 1]
    tube = {"url": "https://y/1", "video_length": 120, "title": "Warehouse robot arm grasp", "fps": 25}
    shown = []
    found = discovery.run(spark, str(tmp_path), str(tmp_path / "found"), client=OwnClient([tube, tube | {"url": ""}]), platforms=("youtube",), show=shown.append)
    assert found["is_real_api"] and found["funnel"]["discovered"] == 2 and found["funnel"]["final"] == 1
    assert shown[0].splitlines()[0].split() == ["dataset_id", "name", "type"] and "YouTube - Videos posts" in shown[0]


def test_an_empty_catalogue(spark):
    assert snapshot.catalogue(records.offline_datasets(spark).limit(0)) == "(no datasets)"
    assert len(snapshot.catalogue(records.offline_datasets(spark)).splitlines()) > 2


def test_curation_by_a_listing_into_shards(spark, tmp_path):
    ms = GOOD["end_ms"] - GOOD["start_ms"]
    (tmp_path / "files").mkdir()
    (tmp_path / "files/a.mp4").write_text(f"720 {ms} 30 a")
    rows = [GOOD | {"video_uri": name, "source_url": f"https://e/{name}"} for name in (f"{tmp_path}/files/a.mp4", "none.mp4")]
    (tmp_path / records.RESPONSE).write_text(json.dumps(rows))
    report = curation.run(spark, str(tmp_path), str(tmp_path / "out"), tool=tool, version="v1", video_folder=str(tmp_path / "files"), sharded=True)
    assert [report["funnel"][k] for k in ("schema_valid", "file_present", "training_ready")] == [2, 1, 1] and report["reject_reasons"] == {"file_missing": 1, "near_duplicate": 0}
    data = manifest.ClipDataset(str(tmp_path / "out/manifest"))
    assert len(data) == 1 and data[0]["video_uri"] == f"{tmp_path}/files/a.mp4" and report["manifest_header"]["n_samples"] == 1


def test_records_of_one_row_group_are_validated_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from reelspark.plans import registry

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    busy = registry._checked(spark, str(tmp_path), False).groupBy(F.spark_partition_id()).count().collect()
    assert len(busy) >= spark.sparkContext.defaultParallelism
