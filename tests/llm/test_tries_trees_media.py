"""Prefix tries, hard negatives and media columns against brute force and odd inputs."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import audio, hard_negatives, prefix_trie, queries

CLASHES = ("conv", "pos", "key", "node", "depth", "n", "part", "id", "chunk", "print", "vector", "asks", "low", "rank", "payload", "media", "tensors", "n_bytes")


def with_clashes(df):
    return df.withColumns({c: F.lit(c) for c in CLASHES}).repartition(3)


# prefix trie


def trie_of(rows, rebuild=True):
    said = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said[c].append((t is not None, t or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), text))
    said = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in said.items()}
    built = said
    if rebuild:
        built = {}
        for c in said:
            h = zlib.crc32(str(c).encode()) % 9
            built[c] = said.get(c - int(np.fmod(c, 5)), [])[:h] + said[c][h:]
    members, children, done = collections.defaultdict(list), collections.defaultdict(list), {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves = sum(done[x][5] for x in children[k]) or 1
        saved = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0) + sum(done[x][6] for x in children[k])
        ends = ",".join(str(c) for c in members[k] if len(built[c]) == len(k))
        done[k] = (members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(children[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(done.values(), key=repr)


def nodes_of(df, rebuild=True):
    turns = prefix_trie.numbered_turns(with_clashes(df))
    with prefix_trie.prefix_trie(*(prefix_trie.rebuilt if rebuild else prefix_trie.plain)(turns)) as nodes:
        return sorted(map(tuple, nodes.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("rebuild", (True, False))
def test_trie_is_brute_force(spark, rebuild):
    rng = random.Random(3)
    rows = []
    for c in rng.sample(range(-7, 60), 45):
        for t in range(rng.choice((1, 2, 5, 12))):
            rows.append((c, t, rng.choice(("user", "assistant")), rng.choice(("a", "b", "é漢" * 9))))
    copied = [(c, t, "user", f"turn {t}") for c in (70, 71, 72, 73, 80) for t in range(30)]  # whole copies, deep
    odd = [(90, None, None, None), (90, 0, "user", None), (90, 0, "user", None), (90, 0, "", "x"), (None, 0, "user", "nobody's"), (91, 1, "user", "1:u"), (92, 1, "", "x" * 150_000), (93, 5, "use", "r"), (94, 5, "user", "")]
    rows += copied + odd
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes_of(df, rebuild) == trie_of(rows, rebuild)


def test_trie_of_little(spark):
    assert nodes_of(spark.createDataFrame([], SCHEMA)) == []
    assert nodes_of(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []
    # crc32("2") % 9 is 4 and conversation 0 isn't there: conversation 2 has no turns, but is at the root
    assert zlib.crc32(b"2") % 9 == 4
    rows = [(2, 0, "user", "x")]
    assert nodes_of(spark.createDataFrame(rows, SCHEMA)) == trie_of(rows) == [(2, 0, None, 1, 0, 1, 0, hashlib.sha256(b"2").hexdigest())]


def test_a_conversation_over_many_partitions(spark):
    rows = [(5, t, "user", str(t % 7)) for t in range(4000)] + [(6, 0, "user", "0")]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        turns = prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(5))
        found = sorted(map(tuple, turns.filter("conv = 5").select("pos", "before", "bytes").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert found == [(t, t, 1) for t in range(4000)]


def test_ends_are_joined_over_segments(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT_IDS", 3)
    rows = [(c, 0, "user", "hello") for c in range(40)] + [(c, 0, "user", "hello") for c in range(40, 44) for _ in range(2)]
    assert nodes_of(spark.createDataFrame(rows, SCHEMA), False) == trie_of(rows, False)


# hard negatives


def mined(rows, every):
    """By brute force, of distinct rows that take part."""
    fine = {r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[2])}
    width = max((len(r[2]) for r in fine), default=0)
    held = [(i, label, [int(np.floor(256 * float(x))) for x in v] + [0] * (width - len(v))) for i, label, v in fine]
    out = []
    for i, label, v in held:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in held)
        near = [(j, -s) for s, j, other in scored if other == label and j != i][:5]
        for j, p in near:
            fits = [(k, -s) for s, k, other in scored if other != label and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(i, j, rank, k, p, n) for rank, (k, n) in enumerate(fits, 1)]
    return sorted(out)


def asked(spark, rows, every, kind="float"):
    df = with_clashes(spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>"))
    found = hard_negatives.mine(df, anchors=F.col("vec_id") % every == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("leaf", (3, 256))
def test_negatives_are_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(hard_negatives, "LEAF", leaf)
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 100)  # so that there are several chunks
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, int(rng.integers(4)), tuple(float(np.float32(x)) for x in centres[i % 6] + 0.1 * rng.normal(size=8))) for i in range(400)]
    rows += [(1000 + i, i % 2, tuple(float(x) for x in np.ones(8) / 2)) for i in range(60)]  # ties
    rows += rows[:10] + [(3, 3, rows[5][2]), (50, 1, rows[7][2])]  # repeated rows, ids that repeat
    rows += [(None, 1, rows[0][2]), (500, None, rows[0][2]), (500, 1, None), (550, 1, (1.0, None)), (600, 1, (float("nan"),)), (650, 2, (float("inf"), 0.0)), (700, 2, ()), (750, 2, (0.5, 0.5))]
    want = mined(rows, 10)
    assert asked(spark, rows, 10) == want and len(want) > 100


def test_negatives_of_little(spark):
    assert asked(spark, [], 2) == []
    assert asked(spark, [(0, 1, (1.0,))], 2) == []
    assert asked(spark, [(0, 1, (1.0,)), (1, 1, (1.0,)), (2, 0, (0.75,))], 2, "double") == [(0, 1, 1, 2, 65536, 49152)]
    assert asked(spark, [(0, 1, (-1.0,)), (1, 1, (1.0,)), (2, 0, (0.75,))], 5) == []  # a negative score opens no window


def test_trees_pass_over_what_the_bounds_allow(monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(64, 16)) * 400
    vectors = np.floor(np.repeat(centres, 256, axis=0) + rng.normal(size=(64 * 256, 16)))
    ids = rng.permutation(len(vectors)).astype(np.int64)
    tree = hard_negatives.BallTree(ids, np.zeros(len(ids), np.int64), vectors)
    seen = []
    compare = hard_negatives.BallTree._compare
    monkeypatch.setattr(hard_negatives.BallTree, "_compare", lambda self, rows, asking: (seen.append(len(rows) * len(asking)), compare(self, rows, asking)))
    n = 20
    wide = np.full((n, 1), 1 << 62)
    scores, found = tree.search(vectors[:n], ids[:n], np.zeros(n, np.int64), -wide, wide, 5, True)
    assert sum(seen) < n * len(ids) / 8
    for i in range(n):
        s = vectors @ vectors[i]
        best = [j for j in np.lexsort((ids, -s)) if j != i][:5]
        assert found[i, 0].tolist() == ids[best].tolist() and scores[i, 0].tolist() == s[best].tolist()


# audio


def test_wav_keeps_every_byte():
    payload = bytes(range(256)) * 3
    media = audio.to_wav(payload, 24_000)
    assert audio.from_wav(media) == (payload, 24_000) and len(media) == len(payload) + 44
    import io
    import wave

    with wave.open(io.BytesIO(media)) as f:
        assert (f.getnchannels(), f.getsampwidth(), f.getnframes()) == (1, 1, len(payload))


@pytest.mark.parametrize("source, target", ((24_000, 16_000), (8_000, 16_000), (11_025, 8_000), (16_000, 16_000)))
def test_resampling_is_the_whole_filter(source, target):
    own = audio.Resampler(source, target, 12)
    samples = np.random.default_rng(1).integers(0, 256, 900).astype(np.uint8)
    n = own.length(len(samples))
    x = (samples.astype(float) - 128) / 128
    want = np.zeros(n)
    for i in range(n):  # every tap, as the definition has it
        at, phase = divmod(i * own.down, own.up)
        for t in range(own.taps):
            place = at - (own.taps - 1 - own.taps // 2) + t
            if 0 <= place < len(x):
                want[i] += x[place] * own.phases[phase, t]
    assert np.allclose(own.run(samples, 0, n), want, atol=1e-5)
    cut = np.concatenate([own.run(samples, a, min(n, a + 97)) for a in range(0, n, 97)])
    assert np.allclose(cut, want, atol=1e-5)
    # a slow tone stays a tone
    tone = 128 + 100 * np.sin(2 * np.pi * 200 * np.arange(source // 4) / source)
    out = own.run(np.round(tone).astype(np.uint8), 0, own.length(len(tone)))
    middle = slice(200, len(out) - 200)
    assert np.abs(out - 100 / 128 * np.sin(2 * np.pi * 200 * np.arange(len(out)) / target))[middle].max() < 0.03


def test_blocks_and_mel(monkeypatch):
    rng = np.random.default_rng(2)
    payload = rng.integers(0, 256, 24_000 * 3).astype(np.uint8).tobytes()
    whole = audio.Analyser(audio.Settings()).stored(payload, 24_000)
    table = audio.tensors(whole[0])
    assert str(table.schema.field("tensor").type).startswith("extension<arrow.fixed_shape_tensor")
    mel = np.concatenate([b.column(0).to_numpy_ndarray() for b in table.to_batches()]).reshape(-1, 40)
    assert whole[1] == 300 and len(mel) == 300 and table.column("start_ms").to_pylist() == [0, 1000, 2000] and table.column("stop_ms").to_pylist() == [1000, 2000, 3000]
    monkeypatch.setattr(audio, "BLOCK_FRAMES", 37)
    parts = audio.Analyser(audio.Settings()).stored(payload, 24_000)
    again = np.concatenate([b.column(0).to_numpy_ndarray() for b in audio.tensors(parts[0]).to_batches()]).reshape(-1, 40)
    assert np.allclose(mel, again[:300], atol=1e-3) and parts[1:4] == whole[1:4]
    # frame by frame, from the definition
    s, own = audio.Settings(), audio.Resampler(24_000, 16_000, 12)
    signal = own.run(np.frombuffer(payload, np.uint8), 0, 48_000)
    for f in (0, 7, 250):
        cut = signal[f * 160 : f * 160 + 400]
        power = np.abs(np.fft.rfft((cut - cut.mean()) * np.hanning(401)[:-1], 512)) ** 2
        assert np.allclose(mel[f], np.log(power @ audio.mel_bank(s.rate, s.fft, s.bands) + 1e-10), atol=1e-3)


def test_mel_bank_covers_the_spectrum():
    bank = audio.mel_bank(16_000, 512, 40)
    assert bank.shape == (257, 40) and bank.min() == 0 and bank.max() <= 1
    peaks = bank.argmax(axis=0)
    assert (np.diff(peaks) >= 0).all()


def test_hysteresis_is_the_machine():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 200):
        energy = rng.normal(size=n)
        state, want, began = False, [], 0
        for i, e in enumerate(energy):
            if not state and e >= 0.8:
                state, began = True, i
            elif state and e < -0.5:
                state = False
                want.append([began, i])
        if state:
            want.append([began, n])
        assert audio.hysteresis(energy, 0.8, -0.5).tolist() == want


def test_loud_stretches():
    rate = 24_000
    quiet, loud = rate, rate // 2
    rng = np.random.default_rng(4)
    signal = np.concatenate([rng.normal(size=quiet), 60 * np.sin(2 * np.pi * 440 * np.arange(loud) / rate), rng.normal(size=quiet)])
    _, frames, spans, ms, _ = audio.Analyser(audio.Settings()).stored((128 + signal).round().astype(np.uint8).tobytes(), rate)
    assert ms == 2500 and frames == 250
    longest = max(spans, key=lambda x: x["stop_ms"] - x["start_ms"])
    assert abs(longest["start_ms"] - 1000) <= 30 and abs(longest["stop_ms"] - 1500) <= 30


def test_features_of_texts(spark):
    rows = [(1, None), (2, ""), (3, "x" * 64), (4, "é漢😀"), (4, "é漢😀"), (None, "no id"), (5, "0123456789" * 40_000), (6, "a" * 65)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    found = audio.features(audio.encode(audio.text_payload(df)))
    got = found.collect()
    want = []
    for i, text in rows:
        data = (text or "").encode()
        payload = data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")
        media = audio.to_wav(payload, 24_000)
        want.append((i, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest()))
    names = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        frames = sum(audio.tensors(r.tensors).column("frames").to_pylist())
        assert frames == r.n_frames and all(0 <= x.start_ms < x.stop_ms <= r.duration_ms for x in r.segments)
    told = [r.feature for r in audio.digests(found).filter("doc_id = 4").collect()]
    assert len(told) == 2 and told[0] == told[1]
    assert audio.digests(audio.features(audio.encode(audio.text_payload(df.limit(0))))).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id long, payload binary")
    assert audio.features(audio.encode(null)).first().media_bytes is None


def test_op12_reads_whole_documents(spark):
    data = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found = queries.op12_audio_features(spark, data).collect()
    assert {r.doc_id: r.payload_sha256 for r in found} == {i: hashlib.sha256(x.ljust(max(64, -(-len(x) // 64) * 64), b"\0")).hexdigest() for i, x in texts.items()}
