"""JSON arrays read in byte ranges, however large the file.

A file is cut at its commas by the engine's text reader, range by range, on whatever file
system it lies. Whether a comma parts two elements hangs on all of the file before it:
on being inside a string and on the depth of brackets. So each range is first made an
element of a monoid: for each way in which it may begin (outside strings or inside one,
behind a backslash or not), how it ends, how much deeper it gets, and how many commas it
has at which depth. Composing them in order (one for each range, on the driver) gives
the state and the number of elements before each range. A second pass cuts elements out
of every range from its true state; what is left at a range's ends is put together by
the number of its element.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ways in which a range may begin: inside a string or not (1), behind a backslash or not (2; outside strings only in ranges that don't begin as supposed).
OUTSIDE, INSIDE, ESCAPED = 0, 1, 3
STATES = range(4)
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("["), ord("{")]] = 1
_DEPTH[[ord("]"), ord("}")]] = -1


def walked(data: np.ndarray, state: int, before: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """(depth after each byte, whether it is outside strings, state behind the last one) of bytes that begin in state at depth before."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool), state
    at = np.arange(n)
    slash = data == ord("\\")
    plain = np.maximum.accumulate(np.where(slash, -1, at))  # the last byte that is no backslash
    run = np.where(slash, at - plain, 0)  # backslashes in a row, up to here; those from the start on count the one before it
    run[slash & (plain < 0)] += state >> 1
    odd = np.concatenate([[state > 1], run[:-1] % 2 == 1])
    quote = (data == ord('"')) & ~odd
    inside = (np.cumsum(quote) + (state & 1)) % 2 == 1
    outside = ~inside & ~quote
    depth = before + np.cumsum(np.where(outside, _DEPTH[data], 0), dtype=np.int64)
    return depth, outside, int(inside[-1]) + 2 * int(run[-1] % 2)


def summary(data: np.ndarray) -> list[tuple[int, int, dict[int, int]]]:
    """For each state: the state behind data, the change of depth, and the commas outside strings by their depth against the start."""
    out = []
    for state in STATES:
        depth, outside, end = walked(data, state)
        values, counts = np.unique(depth[outside & (data == ord(","))], return_counts=True)
        out.append((end, int(depth[-1]) if len(depth) else 0, dict(zip(values.tolist(), counts.tolist()))))
    return out


def composed(one: list, two: list) -> list:
    """The summary of two stretches, one after the other; associative."""
    out = []
    for end, depth, commas in one:
        last, more, others = two[end]
        total = Counter(commas)
        for d, n in others.items():
            total[d + depth] += n
        out.append((last, depth + more, dict(total)))
    return out


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, piece): what stands between commas, and in which range of bytes it starts; in order within a range."""
    read = spark.read.option("lineSep", ",").text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, block, bytes) of stretches of pieces, each with the comma behind it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column(1).to_numpy()
        name = batch.column(0).to_pylist()
        cuts = [0, *[i for i in range(1, len(name)) if block[i] != block[i - 1] or name[i] != name[i - 1]], len(name)]
        for a, b in zip(cuts, cuts[1:]):
            yield name[a], int(block[a]), b",".join(batch.column(2).slice(a, b - a).to_pylist()) + b","


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """(ord, raw) of the elements of the JSON arrays in the files of path, numbered from 0 in the order of the files' names.

    raw is the element's text, laid out as the engine's JSON reader does; text that it
    can't read stays as it is. An empty array has no elements, but takes a number. A
    file that holds something else than an array is an error. Files are read twice, in
    ranges of spark.sql.files.maxPartitionBytes. A range's summary has an entry for each
    depth at which it has commas; an element of any length is put together in one row.
    """
    pieces = _pieces(spark, path)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}
        for file, block, text in _ranges(batches):
            own = summary(np.frombuffer(text, np.uint8))
            held[file, block] = composed(held[file, block], own) if (file, block) in held else own
        if held:
            rows = [(f, b, state, end, depth, list(commas), list(commas.values())) for (f, b), found in held.items() for state, (end, depth, commas) in enumerate(found)]
            types = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["file", "block", "state", "end", "depth", "at", "n"])

    told: dict[tuple[str, int], dict[int, tuple]] = {}
    for r in pieces.mapInArrow(summed, "file string, block long, state int, end int, depth long, at array<long>, n array<long>").collect():  # four rows for each range
        told.setdefault((r.file, r.block), {})[r.state] = (r.end, r.depth, dict(zip(r.at, r.n)))
    starts: dict[tuple[str, int], tuple[int, int, int]] = {}
    last, state, depth, count = None, OUTSIDE, 0, 0
    for key in sorted(told):
        if key[0] != last:
            count += last is not None  # the last element of a file has no comma behind it
            last, state, depth = key[0], OUTSIDE, 0
        starts[key] = state, depth, count
        end, more, commas = told[key][state]
        count += commas.get(1 - depth, 0)
        state, depth = end, depth + more
    begun = spark.sparkContext.broadcast(starts)  # three numbers for each range

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, part = None, (OUTSIDE, 0, 0), 0
        for file, block, text in _ranges(batches):
            if (file, block) != key:
                key, at, part = (file, block), begun.value[file, block], 0
            rows, at = _cut(file, text, *at)
            out = [(n, block if open_ else -1, part + i, own) for i, (n, open_, own) in enumerate(rows)]
            part += len(rows)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["ord", "block", "part", "text"])

    found = pieces.mapInArrow(cut, "ord long, block long, part long, text binary")
    whole = found.filter("block = -1").select("ord", F.decode("text", "UTF-8").alias("raw"))
    # what is left at the ends of a range, for each batch two rows at most; the parts of an element are as long as itself
    parts = found.filter("block <> -1").groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("parts"))
    joined = F.aggregate("parts", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["text"]))
    every = whole.unionByName(parts.select("ord", F.decode(joined, "UTF-8").alias("raw"))).withColumn("raw", F.regexp_replace("raw", r"^[ \t\r\n]+|[ \t\r\n]+$", ""))
    read = F.get(F.from_json(F.concat(F.lit("["), F.col("raw"), F.lit("]")), "array<string>"), F.lit(0))
    return every.filter("raw <> ''").select("ord", F.coalesce(read, F.when(F.col("raw") != "null", F.col("raw"))).alias("raw"))


def _cut(file: str, text: bytes, state: int, depth: int, count: int) -> tuple[list[tuple[int, bool, bytes]], tuple[int, int, int]]:
    """(number, whether it goes on over an end of text, its bytes here) of the elements of a stretch, and the state, depth and number behind it."""
    data = np.frombuffer(text, np.uint8)
    depths, outside, end = walked(data, state, depth)
    brace = outside & (((data == ord("{")) & (depths == 1)) | ((data == ord("}")) & (depths == 0)))
    if brace.any():
        raise ValueError(f"{file} holds no JSON array")
    comma = outside & (data == ord(",")) & (depths == 1)
    edges = np.flatnonzero(comma | (outside & (((data == ord("[")) & (depths == 1)) | ((data == ord("]")) & (depths == 0)))))
    begins, ends = [0, *(edges + 1).tolist()], [*edges.tolist(), len(text)]
    live = [depth > 0, *(depths[edges] == 1).tolist()]
    number = [count, *(count + np.cumsum(comma[edges])).tolist()]
    rows = [(number[i], i in (0, len(begins) - 1), text[a:b]) for i, (a, b) in enumerate(zip(begins, ends)) if live[i] and a < b]
    return rows, (end, int(depths[-1]), number[-1])
