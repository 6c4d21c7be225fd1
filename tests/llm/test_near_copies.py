"""Near copies by similarity, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import near_copies, simhash


def groups_of(rows):
    """Smallest id of each row's group, from all pairs; rows of one id are linked."""
    sets = [frozenset(simhash.shingle_hashes((t or "").encode(), 5).tolist()) for _, t in rows]
    group = [*range(len(rows))]
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and (rows[i][0] is not None and rows[i][0] == rows[j][0] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in set(group)}
    return [least[g] for g in group]


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(words)), n):
        out[at] = f"new{rng.randrange(10**9)}"
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for n in (8, 30, 120, 500):
        for _ in range(12):
            base = [word() for _ in range(n)]
            rows.append(" ".join(base))
            rows += [" ".join(edited(rng, base, max(1, round(n * share)))).upper() for share in rng.sample((0.005, 0.01, 0.02, 0.04, 0.2), 2)]
    base = [word() for _ in range(200)]
    rows += [" ".join(edited(rng, base, 4)) for _ in range(60)] + [" ".join(base)] * 4  # copies of one text, as similar to it, but not to each other
    boiler = " ".join(word() for _ in range(60))
    rows += [f"{boiler} {' '.join(word() for _ in range(60))}" for _ in range(40)]  # half in common
    rng.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)]
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (905, "é漢 x y z q"), (3, rows[50][1]), (3, "other text of the same id here"), (None, rows[7][1]), (None, "nobody has this text of no id"), (None, "nobody has this text of no id")]


@pytest.mark.parametrize("split", (8, 1 << 14))
def test_near_copies_are_those_of_all_pairs(spark, monkeypatch, split):
    monkeypatch.setattr(near_copies, "SPLIT", split)
    total = linked = 0
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("_id", "_node", "_print", "a", "b", "n")}).repartition(3)
        told = near_copies.near_copies(df).withColumnRenamed("_id", "doc_id")
        found = {}
        for r in told.collect():
            found.setdefault((r.doc_id, r._hash), set()).add(r.component_id)
        assert told.count() == len(rows) and all(len(x) == 1 for x in found.values())
        hashes = [r.h for r in spark.createDataFrame([(t,) for _, t in rows], "t string").select(F.xxhash64(F.coalesce("t", F.lit(""))).alias("h")).collect()]
        want = groups_of(rows)
        for (i, _), h, w in zip(rows, hashes, want):
            got = next(iter(found[i, h]))
            total += w != i
            linked += w != i and got == w
            assert got == w or got is None or got >= w  # nothing that isn't similar is linked
    assert total > 150 and linked >= 0.95 * total


def test_the_centre_of_copies_of_one_text():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1, dtype=np.uint64)[0]
    prints = np.array([base] + [base ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, 8, replace=False).astype(np.uint64)) for _ in range(200)], np.uint64)
    found = near_copies.candidates(prints)
    assert {(0, i) for i in range(1, 201)} <= set(found) and len(found) <= 400 and near_copies.candidates(prints[:1]) == []


def test_little(spark):
    assert near_copies.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = near_copies.near_copies(spark.createDataFrame([(2, "word " * 60_000), (1, "word " * 60_001), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r._id or 0, r.component_id) for r in rows) == [(0, None), (1, 1), (2, 1)]

def test_pairs_that_buckets_and_trees_leave_out(spark, monkeypatch):
    """All links at the threshold, whatever minimum hashes and fingerprints bring together, against all pairs."""
    from reelspark.llm.simhash import shingle_hashes

    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for i in range(60):
        base = rng.choices(words, k=rng.randint(8, 120)) + "a line that many of them have in the end".split() * (i % 3 == 0)
        texts.append(" ".join(base))
        for edits in range(1, 5):
            near = list(base)
            for at in rng.sample(range(len(near)), min(edits, len(near))):
                near[at] = rng.choice(words)
            texts.append(" ".join(near))
    sets = [set(shingle_hashes(t.encode(), 5).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(near_copies, "_met", lambda nodes: nodes.select(nodes["_node"].alias("a"), nodes["_node"].alias("b")).limit(0))
    found = {r._id: r.component_id for r in near_copies.near_copies(df).collect()}
    assert [found[i] for i in range(len(texts))] == group and len(set(group)) < len(texts) - 50


def test_a_crowd_under_one_shingle_gives_no_rows_for_its_pairs(spark, monkeypatch):
    """Texts that share a first shingle but little else are told apart where they meet: nothing that is written grows with their square."""
    rng = random.Random(3)
    texts = [" ".join([*"a passage of six words here".split(), *(f"w{rng.randrange(10**6)}" for _ in range(20))]) for _ in range(300)]
    edited_one = texts[0].split()
    edited_one[-1] = "else"
    df = spark.createDataFrame(list(enumerate([*texts, " ".join(edited_one)])), "doc_id long, text string")
    sizes, write = [], near_copies.checkpoint

    def counted(frame):
        out = write(frame)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "checkpoint", counted)
    monkeypatch.setattr(near_copies, "prefix", lambda shingles, *_: shingles)  # so that all of them meet
    monkeypatch.setattr(near_copies, "_met", lambda nodes: nodes.select(nodes["_node"].alias("a"), nodes["_node"].alias("b")).limit(0))
    found = {r._id: r.component_id for r in near_copies.near_copies(df).collect()}
    assert found == {i: i for i in range(300)} | {300: 0}
    assert max(sizes) <= 10 * len(texts)


def test_sets_of_repeated_words_are_one(spark, monkeypatch):
    """Two texts of one set whose fingerprints differ are linked, and each links to what is near the set."""
    tail = "b c d e f g h i j k l m n o p q r s t u v w".split()
    rows = [(1, " ".join(["x"] * 6 + tail)), (2, " ".join(["x"] * 400 + tail)), (3, " ".join(["x"] * 6 + tail + ["y"])), (4, "something else that is near none of them at all")]
    monkeypatch.setattr(near_copies, "_met", lambda nodes: nodes.select(nodes["_node"].alias("a"), nodes["_node"].alias("b")).limit(0))
    found = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r._id: r.component_id for r in found} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_parities_of_any_length_tell_no_more_than_what_differs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 5, 120, 130, 200, 1000, 1100)]
    sets += [np.unique(np.concatenate([s[len(s) // 10 :], rng.integers(0, 2**63, 3, dtype=np.uint64)])) for s in sets]
    told = near_copies.Parities([near_copies.parity(s) for s in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    real = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in zip(a, b)])
    apart = told.apart(a, b)
    assert (apart <= real).all() and (apart[real == 0] == 0).all() and (apart[(real > 0) & (real < 20)] > 0).all()
