"""Clips over several batches against all of them at once."""

import random

import numpy as np
from pyspark.sql import functions as F

from reelspark.operators import near_duplicates
from reelspark.operators.seen import SeenClips


def test_batches_give_the_winners_of_one(spark, tmp_path):
    rng = random.Random(4)
    sigs = [[rng.getrandbits(63) for _ in range(5)] for _ in range(30)] + [[0] * 5] * 4
    for base in rng.choices(sigs[:30], k=40):
        near = list(base)
        for b in rng.sample(range(315), rng.choice([0, 10, 39, 40, 41])):
            near[b // 63] ^= 1 << (b % 63)
        sigs.append(near)
    order = rng.sample(range(len(sigs)), len(sigs))
    rows = [(i, f"clip_{i}", sigs[o], rng.choice([1.0, 2.0, None])) for i, o in enumerate(order)]
    df = spark.createDataFrame(rows, "ord long, clip_id string, sig array<long>, quality double")
    whole = near_duplicates.winners(near_duplicates.clusters(df.select("ord", "sig"), 8.0, 5).join(df.select("ord", "quality"), "ord"))
    path = str(tmp_path / "seen")
    index = SeenClips(spark, path, expected_rows=1000, buckets=4)
    assert index.winners().count() == 0
    for i in range(3):
        part = df.filter(F.col("ord") % 3 == i)
        again = df.filter(F.col("ord") % 3 < i).withColumn("ord", F.col("ord") + 1000)  # ids of earlier batches
        assert index.add(part.unionByName(again).unionByName(part.limit(3).withColumn("ord", F.col("ord") + 2000)), f"b{i}")
        assert not index.add(part, f"b{i}")
        index.close()  # another run opens the folder
        index = SeenClips(spark, path, expected_rows=1000, buckets=4)
    assert sorted(map(tuple, index.winners().collect())) == sorted(map(tuple, whole.select("ord", "cluster", "keep").collect()))
    # what an attempt without a commit has left behind doesn't count
    before = index.winners().count()
    spark.sql(f"INSERT INTO {index.names['clips']} VALUES (9999, 'x', 9999, 1.0, 'lost')")
    assert index.winners().count() == before
    plan = df.limit(3).join(index.table("ids").hint("merge"), "clip_id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan  # the index comes to the join as it lies
    index.close()


def test_a_batch_shuffles_few_keys_a_row(spark, tmp_path):
    """A new signature meets the index under one key more than the bits that may differ, not under all values near its bands."""
    rng = random.Random(6)
    rows = [(i, f"clip_{i}", [rng.getrandbits(63) for _ in range(5)], 1.0) for i in range(600)]
    df = spark.createDataFrame(rows, "ord long, clip_id string, sig array<long>, quality double").coalesce(1)
    written = lambda: sum(s.shuffleWriteRecords() for s in (lambda all_: [all_.apply(i) for i in range(all_.size())])(spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)))
    index = SeenClips(spark, str(tmp_path / "seen"), expected_rows=1e5, buckets=4)
    assert index.add(df.filter("ord < 300"), "b0")
    before = written()
    assert index.add(df.filter("ord >= 300"), "b1")
    assert written() - before < 300 * 150
    index.close()


def _near_copies(rng, n, crowd):
    """Signatures of 60 bits a hash, of which some are near others, around the threshold, and crowd ones are near one."""
    sigs = [[rng.getrandbits(60) for _ in range(5)] for _ in range(n)]
    for base, most in [(rng.choice(sigs), (38, 40, 41, 44)) for _ in range(n // 2)] + [(sigs[0], (8, 16))] * crowd:
        near = list(base)
        for b in rng.sample(range(300), rng.choice(most)):
            near[b // 60] ^= 1 << (b % 60)
        sigs.append(near)
    return sigs


def test_rows_looked_up_are_those_of_comparing_all(monkeypatch):
    rng = random.Random(8)
    found = near_duplicates.pieces([(1 << 60) - 1] * 5, 40)
    for k, (most, expanded) in enumerate([(40, 50), (40, 1 << 20), (41, 50)]):
        word, share, mask = found[3 + 16 * k]
        sig = np.array(_near_copies(rng, 400, 60), np.uint64)
        sig[:, word] &= np.uint64(~mask & (1 << 64) - 1)
        group = np.sort(np.array([rng.randrange(300) for _ in sig]))
        monkeypatch.setattr(near_duplicates, "EXPANDED", expanded)
        for start in (0, 250):
            for apart in (False, True):
                part = {"group": group, "sig": sig, "from": start, "word": word, "share": share}
                results = []
                for least, plainer in ((1 << 60, 16), (1, 0.1), (1, 16)):  # all compared; all looked up; tiles either way
                    monkeypatch.setattr(near_duplicates, "LOOKED_UP", least)
                    monkeypatch.setattr(near_duplicates, "PLAINER", plainer)
                    results.append(sorted((int(x), int(y), int(z)) for a, b, bits in near_duplicates._near(part, most, 5, apart) for x, y, z in zip(a, b, bits)))
                assert results[0] == results[1] == results[2] and len(results[0]) > 100


def test_a_batch_meets_the_index_without_a_row_for_each_pair(spark, tmp_path):
    """Rows under a key are compared in tasks, no join makes their pairs, and the index is read as it lies."""
    rng = random.Random(9)
    df = spark.createDataFrame([(i, f"clip_{i}", s, 1.0) for i, s in enumerate(_near_copies(rng, 60, 20))], "ord long, clip_id string, sig array<long>, quality double")
    index = SeenClips(spark, str(tmp_path / "seen"), expected_rows=1000, buckets=4)
    assert index.add(df.filter("ord % 2 = 0"), "b0")
    own = near_duplicates.in_pieces(df.filter("ord % 2 = 1"), index.pieces, "ord", "sig")
    plan = index._met(own)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Join" not in plan
    index.close()


def test_batches_of_crowded_keys(spark, tmp_path, monkeypatch):
    rng = random.Random(10)
    sigs = _near_copies(rng, 60, 60)
    root = list(range(len(sigs)))
    for i in range(len(sigs)):
        for j in range(i):
            if sum((x ^ y).bit_count() for x, y in zip(sigs[i], sigs[j])) <= 40 and root[i] != root[j]:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    monkeypatch.setattr(near_duplicates, "CROWD", 6)
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    df = spark.createDataFrame([(i, f"clip_{i}", s, 1.0) for i, s in enumerate(sigs)], "ord long, clip_id string, sig array<long>, quality double")
    index = SeenClips(spark, str(tmp_path / "seen"), expected_rows=1000, buckets=4)
    for i in range(2):
        assert index.add(df.filter(F.col("ord") % 2 == i), f"b{i}")
    assert sorted((r.ord, r.cluster) for r in index.winners().collect()) == list(enumerate(root))
    index.close()


def test_a_batch_of_many_partitions_writes_few_files(spark, tmp_path):
    rng = random.Random(11)
    df = spark.createDataFrame([(i, f"clip_{i}", s, 1.0) for i, s in enumerate(_near_copies(rng, 60, 20))], "ord long, clip_id string, sig array<long>, quality double")
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        index = SeenClips(spark, str(tmp_path / "seen"), expected_rows=1000, buckets=3)
        assert index.add(df, "b0")
        for table in ("ids", "nodes", "links", "clips", "bands"):
            assert len(list((tmp_path / "seen" / table).glob("part-*"))) <= (9 if table == "bands" else 3)
        index.close()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
