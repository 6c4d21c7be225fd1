"""JSON arrays and lines in ranges of bytes, against whole files."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.sources import json_arrays, records

ODD = '{"a": "x,]}[{\\"\\\\", "b": [1, [2, {"c": ","}]], "é,漢": null}'


def states(text):
    """By the definition, byte by byte."""
    out, state, depth = [], json_arrays.OUTSIDE, 0
    for c in text:
        if state == json_arrays.ESCAPED:
            state = json_arrays.INSIDE
        elif state == json_arrays.INSIDE:
            state = json_arrays.ESCAPED if c == "\\" else json_arrays.OUTSIDE if c == '"' else state
        elif c == '"':
            state = json_arrays.INSIDE
        else:
            depth += (c in "[{") - (c in "]}")
        out.append((state, depth))
    return out


def test_summaries_compose():
    rng = random.Random(1)
    text = "[" + ", ".join([ODD, '"\\\\\\\\"', '"\\\\\\""', "[]", "1"] * 5) + "]"
    data = np.frombuffer(text.encode(), np.uint8)
    want = states(text.encode().decode("latin-1"))
    for _ in range(60):
        cuts = sorted({0, len(data), *rng.sample(range(len(data)), rng.randrange(1, 9))})
        parts = [json_arrays.summary(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        left = parts[0]
        for p in parts[1:]:
            left = json_arrays.composed(left, p)
        right = parts[-1]
        for p in reversed(parts[:-1]):
            right = json_arrays.composed(p, right)
        assert left == right == json_arrays.summary(data)
        state, depth = json_arrays.OUTSIDE, 0
        for (a, b), p in zip(zip(cuts, cuts[1:]), parts):
            depths, _, end = json_arrays.walked(data[a:b], state, depth)
            assert end == p[state][0] == want[b - 1][0] and depths[-1] == depth + p[state][1] == want[b - 1][1]
            state, depth = end, int(depths[-1])


def by_ranges(spark, path, size, read=records.read_records):
    """Rows as read in ranges of size bytes, and the number of ranges."""
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 0, "spark.sql.files.minPartitionNum": 1}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, str(v))
    try:
        rows = sorted((r.ord, r.raw) for r in read(spark, path).collect())
        return rows, spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_conversations_in_1_and_16_ranges(spark, tmp_path):
    rows = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect()]
    path = tmp_path / "c.json"
    path.write_text(json.dumps(rows, ensure_ascii=False, indent=1))
    size = path.stat().st_size
    one, n_one = by_ranges(spark, str(path), 2 * size)
    many, n_many = by_ranges(spark, str(path), -(-size // 16))
    assert (n_one, n_many) == (1, 16) and one == many
    assert [i for i, _ in one] == [*range(len(rows))] and [json.loads(x) for _, x in one] == rows


@pytest.mark.parametrize("size", (1, 2, 3, 7, 64, 10_000))
def test_odd_elements(spark, tmp_path, size):
    elements = [ODD, '"a,b"', "5.0", "null", "[1, 2]", "{}", '{"x": "' + "long, " * 20 + '"}', '"\\\\"', "[[[]]]"]
    path = tmp_path / "o.json"
    path.write_text(" \n[ " + " ,\n".join(elements) + " ] \n")
    rows, _ = by_ranges(spark, str(path), size)
    want = spark.createDataFrame([("[" + ",".join(elements) + "]",)], "v string").select(F.posexplode(F.from_json("v", "array<string>")).alias("ord", "raw"))
    assert rows == sorted(((r.ord, r.raw) for r in want.collect()))


def test_empty_arrays_and_several_files(spark, tmp_path):
    for name, text in (("a", "[]"), ("b", "[1,2]"), ("c", " [ ] "), ("d", '[{"x":1}]')):
        (tmp_path / f"{name}.json").write_text(text)
    assert by_ranges(spark, str(tmp_path), 4)[0] == [(1, "1"), (2, "2"), (4, '{"x":1}')]
    (tmp_path / "e.json").write_text('{"x": [1, 2]}')
    with pytest.raises(Exception, match="holds no JSON array"):
        by_ranges(spark, str(tmp_path), 4)


@pytest.mark.parametrize("size", (5, 1000))
def test_lines_are_numbered_over_ranges(spark, tmp_path, size):
    lines = ["", "a", "", "bb,b\r", "", "c" * 20, *map(str, range(50))]
    (tmp_path / "l.jsonl").write_text("\n".join(lines), newline="")
    rows, _ = by_ranges(spark, str(tmp_path / "l.jsonl"), size, records.numbered_lines)
    assert rows == [*enumerate(lines)]
    (tmp_path / "n.jsonl").write_text("")
    assert by_ranges(spark, str(tmp_path / "n.jsonl"), size, records.numbered_lines)[0] == []
