"""Manifests in shards: tasks write lines and an index of their byte offsets, the commit writes the header.

A manifest is a folder: in a folder of the job that wrote them, shards of JSON lines,
beside each an index (the offset of every line, 8 bytes each); and manifest.json, which
is written last and names the shards that count. Tasks send counts with their commit
messages, so the header needs no pass of its own. A failed job's folder is removed, so
that a task which is still running can't add to it; what a lost attempt has left isn't
named, and goes with the commit.

Columns of the table that is written: raw (the line), and those that options name:
count_by, comma-separated, whose values are counted, and sum, which is added up. The
counts of a column come to the driver as the header holds them, one for each distinct
value.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections import Counter, OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

HEADER = "manifest.json"
#: Lines that a reader hands on at a time.
BATCH = 1 << 12


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it: local, or by its scheme one of those that Arrow knows."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def header_of(path: str) -> dict:
    """manifest.json: rows, counts, sum, shards (name, rows, size) in their order, and what the writer was given."""
    store, root = opened(path)
    with store.open_input_file(f"{root}/{HEADER}") as f:
        return json.loads(f.read())


@dataclass
class _Written(WriterCommitMessage):
    part: int = 0
    name: str = ""
    rows: int = 0
    size: int = 0
    total: int = 0
    counts: dict[str, Counter] = field(default_factory=dict)


class ShardSink(DataSource):
    """Format clip_manifest. Options: path, count_by, sum, header (a JSON object that the header takes over)."""

    @classmethod
    def name(cls) -> str:
        return "clip_manifest"

    def schema(self) -> str:
        return "ord long, raw string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _ShardWriter(dict(self.options), schema.names, overwrite)

    def reader(self, schema) -> DataSourceReader:
        return _ShardReader(self.options["path"])


class _ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite = options["path"], columns, overwrite
        self.count_by = [c for c in options.get("count_by", "").split(",") if c]
        self.sum, self.header, self.job = options.get("sum"), json.loads(options.get("header", "{}")), uuid.uuid4().hex
        store, root = opened(self.path)
        if not overwrite and store.get_file_info(f"{root}/{HEADER}").type == fs.FileType.File:
            raise ValueError(f"{self.path} holds a manifest already")
        store.create_dir(f"{root}/{self.job}")

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        context = TaskContext.get()
        store, root = opened(self.path)
        name = f"{self.job}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        done = _Written(context.partitionId(), name, counts={c: Counter() for c in self.count_by})
        with store.open_output_stream(f"{root}/{name}.jsonl") as lines, store.open_output_stream(f"{root}/{name}.idx") as index:
            for batch in batches:
                raw = batch.column(self.columns.index("raw")).cast(pa.binary())
                if raw.null_count:
                    raise ValueError("a line of a manifest is null")
                sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                ends = done.size + np.cumsum(sizes)
                index.write((ends - sizes).astype("<i8").tobytes())
                texts = raw.to_pylist()
                if texts:
                    lines.write(b"\n".join(texts) + b"\n")
                    done.size = int(ends[-1])
                done.rows += len(texts)
                for c in self.count_by:
                    for told in pc.value_counts(batch.column(self.columns.index(c))).to_pylist():
                        done.counts[c][told["values"]] += told["counts"]
                if self.sum:
                    done.total += pc.sum(batch.column(self.columns.index(self.sum))).as_py() or 0
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = opened(self.path)
        done = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        counts = {c: Counter() for c in self.count_by}
        for m in done:
            for c in self.count_by:
                counts[c].update(m.counts[c])
        head = self.header | {
            "rows": sum(m.rows for m in done), "sum": sum(m.total for m in done), "counts": {c: {str(k): n for k, n in sorted(v.items(), key=lambda x: str(x[0]))} for c, v in counts.items()},
            "shards": [{"name": m.name, "rows": m.rows, "size": m.size} for m in done if m.rows],
        }
        with store.open_output_stream(f"{root}/{HEADER}.{self.job}") as f:
            f.write(json.dumps(head, ensure_ascii=False).encode())
        store.move(f"{root}/{HEADER}.{self.job}", f"{root}/{HEADER}")  # from here on this manifest counts
        named = {s["name"].split("/")[1] for s in head["shards"]}
        for info in store.get_file_info(fs.FileSelector(root)):
            if info.type == fs.FileType.Directory and info.base_name != self.job:
                store.delete_dir(info.path)
        for info in store.get_file_info(fs.FileSelector(f"{root}/{self.job}")):
            if info.base_name.rsplit(".", 1)[0] not in named:
                store.delete_file(info.path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = opened(self.path)
        store.delete_dir(f"{root}/{self.job}")


@dataclass
class _Shard(InputPartition):
    def __init__(self, name: str, first: int, rows: int):
        super().__init__(name)
        self.first, self.rows = first, rows


class _ShardReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        first, out = 0, []
        for s in header_of(self.path)["shards"]:
            out.append(_Shard(s["name"], first, s["rows"]))
            first += s["rows"]
        return out or [_Shard("", 0, 0)]

    def read(self, shard: _Shard) -> Iterator[pa.RecordBatch]:
        if not shard.rows:
            return
        store, root = opened(self.path)
        with store.open_input_stream(f"{root}/{shard.value}.jsonl") as f:
            number, rest = shard.first, b""
            while block := f.read(1 << 22):
                *whole, rest = (rest + block).split(b"\n")
                for i in range(0, len(whole), BATCH):
                    own = whole[i : i + BATCH]
                    yield pa.record_batch([pa.array(np.arange(number, number + len(own))), pa.array(own, pa.binary()).cast(pa.string())], ["ord", "raw"])
                    number += len(own)


def write_shards(lines: DataFrame, path: str, *, count_by: tuple[str, ...] = (), sum_of: str | None = None, header: dict | None = None, order: tuple[str, ...] = ("ord",), parts: int | None = None) -> dict:
    """Writes lines (raw, and the columns of order, count_by and sum_of) by order, in place of what path held; returns the header. parts: how many shards, else as many as the session makes."""
    lines.sparkSession.dataSource.register(ShardSink)
    columns = ["raw", *count_by, *([sum_of] if sum_of else [])]
    dealt = lines.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).select(*columns)
    told = {"path": path, "count_by": ",".join(count_by), "header": json.dumps(header or {})} | ({"sum": sum_of} if sum_of else {})
    dealt.write.format(ShardSink.name()).options(**told).mode("overwrite").save()
    return header_of(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(ord, raw) of a manifest in shards: lines numbered from 0 in the order in which they were written."""
    spark.dataSource.register(ShardSink)
    return spark.read.format(ShardSink.name()).load(path=path)


class ManifestIndex:
    """Samples of a manifest in shards by their number: one seek in the index and one in the lines.

    Memory holds a number for each shard and HANDLES open files at most, whatever the manifest.
    A caller may give transform, which maps each line's object.
    """

    HANDLES = 16

    def __init__(self, path: str, transform: Callable[[dict], object] | None = None):
        self.store, self.root = opened(path)
        self.shards = header_of(path)["shards"]
        self.firsts = [0]
        for s in self.shards:
            self.firsts.append(self.firsts[-1] + s["rows"])
        self.transform, self.files = transform, OrderedDict()

    def __len__(self) -> int:
        return self.firsts[-1]

    def _file(self, name: str):
        found = self.files.pop(name, None) or self.store.open_input_file(f"{self.root}/{name}")
        self.files[name] = found
        if len(self.files) > self.HANDLES:
            self.files.popitem(last=False)[1].close()
        return found

    def line(self, i: int) -> bytes:
        """Line i; negative numbers count from the end, others that aren't there raise IndexError."""
        i = i + len(self) if i < 0 else i
        if not 0 <= i < len(self):
            raise IndexError(i)
        at = bisect_right(self.firsts, i) - 1
        shard, own = self.shards[at], i - self.firsts[at]
        last = own + 1 == shard["rows"]
        where = np.frombuffer(self._file(f"{shard['name']}.idx").read_at(8 if last else 16, 8 * own), "<i8")
        start, stop = int(where[0]), shard["size"] if last else int(where[1])
        return self._file(f"{shard['name']}.jsonl").read_at(stop - start - 1, start)

    def __getitem__(self, i: int):
        found = json.loads(self.line(i))
        return self.transform(found) if self.transform else found

    def __iter__(self):
        return (self[i] for i in range(len(self)))

    def close(self) -> None:
        for f in self.files.values():
            f.close()
        self.files.clear()


def lines_at(numbers: DataFrame, path: str, *, number: str = "ord") -> DataFrame:
    """numbers with raw, the line of that number (null where there is none): tasks seek, nothing is scanned or shuffled."""
    columns = numbers.columns
    at = columns.index(number)
    schema = numbers.select("*", F.lit(None).cast("string").alias("raw")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ManifestIndex(path)
        for batch in batches:
            wanted = batch.column(at).to_pylist()
            held = {i: index.line(i) for i in sorted({i for i in wanted if i is not None and 0 <= i < len(index)})}  # in the order of the file
            yield pa.record_batch([*batch.columns, pa.array([held.get(i) for i in wanted], pa.binary()).cast(pa.string())], [*columns, "raw"])
        index.close()

    return numbers.mapInArrow(run, schema)


def joined_file(path: str, target: str, first: str | None = None) -> None:
    """The lines of a manifest in shards as one local file, after the line first; bytes are copied, no row is read."""
    store, root = opened(path)
    with open(target, "wb") as out:
        if first is not None:
            out.write(first.encode() + b"\n")
        for s in header_of(path)["shards"]:
            with store.open_input_stream(f"{root}/{s['name']}.jsonl") as f:
                while block := f.read(1 << 22):
                    out.write(block)
