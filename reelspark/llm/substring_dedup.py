"""Suffix-array dedup: bytes under strings that an earlier document has too.

1. Documents are packed into chunks of a few MB, written once. Texts are cut into
   blocks where their own bytes say, so copies have equal blocks. The blocks' digests go
   to hash ranges, which answer for each whether an earlier document has it. So of each
   group of copies one is left, and what follows grows with the distinct text. The bytes
   of blocks that several chunks have go along with step 2 and are compared; blocks of
   one digest that differ would end the run with an error.
2. In what is left, every string of the wanted length has an anchor: the gram with the
   smallest hash in it. Strings in a row mostly share their anchor; such a row is a
   region. Equal strings have equal anchors at equal places, wherever they stand. The
   anchors' hashes go to hash ranges, which answer whether other chunks have them.
3. The bytes of the regions with shared anchors go to the ranges of their anchors. There
   the suffixes at their string starts are sorted: a merge sort whose comparisons find
   the common extension of two suffixes by binary search over prefix polynomial hashes.
   Neighbours that agree over the wanted length are compared byte by byte, so a hash
   collision can't join different strings. Each run of equal strings knows its smallest
   document. (Regions of the very same bytes, compared byte by byte, are sorted once.)
4. The answers go back to the chunks, which mark the bytes and cut them out.

An anchor found in very many chunks isn't kept together: its strings go out one by one,
under their own hashes, once for each chunk. The chunks are a bucketed table, so that
from then on answers come to the texts and no text is shuffled. There is a hash range for every few chunks,
so a task holds the same whatever the corpus, and a chunk only sends to ranges that it
has something for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import released, text_of
from reelspark.llm.hashing import M1, Spans, mixed
from reelspark.llm.simhash import groups
from reelspark.operators.lineage import checkpoint, discard, folder

LENGTH = 50
CHUNK_BYTES = 8 << 20
#: Buckets of the chunk table at most (the engine takes no more than 100,000); beyond, buckets have more chunks, which pass one by one.
MOST_BUCKETS = 20_000
#: Text of a chunk that is hashed at a time, and text of regions that is compared at a time.
STEP_BYTES = SLICE_BYTES = 1 << 20
#: A text is cut where the hash of a gram has this many zero bits: into blocks of 1 << BLOCK_BITS bytes on average.
BLOCK_GRAM, BLOCK_BITS = 24, 8
#: Chunks to a hash range; a task holds what all chunks send to one range.
RANGE_CHUNKS = 4
#: An anchor found in more chunks is dealt out string by string.
COMMON_CHUNKS = 1024
_NO_ID = np.iinfo(np.int64).min
#: Answers to a block: no other chunk has it, others do, and an earlier document does.
ALONE, SHARED, LATER = range(3)


# Packed arrays


def _pack(values: np.ndarray) -> bytes:
    """An array of integers: its byte planes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(packed: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).reshape(-1)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64))


def _ranges(values: np.ndarray, n: int) -> list[int]:
    """Bounds of the n equal ranges of 64-bit values in sorted values."""
    return [*np.searchsorted(values, np.array([(i << 64) // n for i in range(n)], np.uint64)).tolist(), len(values)]


def _cells(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for lengths[0] values, then those of the next."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans at a and b agree, byte by byte."""
    out = np.ones(len(a), bool)
    for i in range(0, len(a), 1 << 16):
        part = slice(i, i + (1 << 16))
        own = np.repeat(np.arange(len(a[part])), lengths[part])
        differ = data[_cells(a[part], lengths[part])] != data[_cells(b[part], lengths[part])]
        out[part][own[differ]] = False
    return out


def _verify(new: np.ndarray, order: np.ndarray, data: np.ndarray, starts: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> None:
    """Sets new for all of a run of order whose regions only have a hash in common; new: where runs start."""
    run = np.cumsum(new) - 1
    lead = order[np.flatnonzero(new)][run]
    alike = (offsets[order] == offsets[lead]) & (sizes[order] == sizes[lead])
    held = np.flatnonzero(alike & ~new)
    alike[held] = _same_bytes(data, starts[order[held]], starts[lead[held]], sizes[order[held]])
    new[np.isin(run, run[~alike])] = True


# Suffix sort


def sort_suffixes(data: np.ndarray, spans: Spans, starts: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes, and for each in that order whether its first length bytes equal the one's before.

    group (sorted) keeps suffixes apart: only those of one group are compared. Bottom-up
    merge sort over all groups at once; a suffix finds its place in the neighbouring run
    by binary search. Suffixes have length bytes at least.
    """
    n = len(starts)
    first = np.flatnonzero(np.diff(group, prepend=group[:1] - 1)) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(first, n))
    base, total = np.repeat(first, size), np.repeat(size, size)
    order = np.arange(n)

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes, up to length."""
        low = np.where(spans.of(a, a + length) == spans.of(b, b + length), length, 0)
        high = np.full(len(a), length)
        open_ = np.flatnonzero(low < length)
        high[open_] -= 1
        while len(open_ := open_[low[open_] < high[open_]]):
            x, y, middle = a[open_], b[open_], (low[open_] + high[open_] + 1) // 2
            same = spans.of(x, x + middle) == spans.of(y, y + middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)
        return low

    def before(a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix a comes before b; ties: for equal ones."""
        same = common(a, b)
        at = np.minimum(same, length - 1)
        return np.where(same == length, ties, data[a + at] < data[b + at])

    run = 1
    while n and run < size.max():
        active = np.flatnonzero(total > run)
        q = active - base[active]
        own = q // run
        from_left = own % 2 == 0
        other = np.minimum((own ^ 1) * run, total[active])
        low, high = other.copy(), np.minimum(other + run, total[active])
        mine = starts[order[active]]
        while len(todo := np.flatnonzero(low < high)):
            middle = (low[todo] + high[todo]) // 2
            theirs = starts[order[base[active[todo]] + middle]]
            # an equal suffix of the left run comes first
            less = before(theirs, mine[todo], ~from_left[todo])
            low[todo] = np.where(less, middle + 1, low[todo])
            high[todo] = np.where(less, high[todo], middle)
        place = base[active] + (own // 2) * 2 * run + (q - own * run) + (low - other)
        moved = order.copy()
        moved[place] = order[active]
        order = moved
        run *= 2
    equal = np.zeros(n, bool)
    if n > 1:
        a, b = starts[order[:-1]], starts[order[1:]]
        near = np.flatnonzero((group[1:] == group[:-1]) & (spans.of(a, a + length) == spans.of(b, b + length)))
        equal[near + 1] = _same_bytes(data, a[near], b[near], np.full(len(near), length))
    return order, equal


# Chunks


class Texts:
    """Texts of a chunk, in order of their ids, and their blocks."""

    def __init__(self, blob: bytes, ids: np.ndarray, sizes: np.ndarray, length: int):
        self.length = length
        self.data = np.frombuffer(zstandard.decompress(blob) if sizes.sum() else b"", np.uint8)
        self.ids, self.sizes = ids, sizes
        self.firsts = np.cumsum(sizes) - sizes
        self.rank = np.cumsum(np.diff(ids, prepend=ids[:1]) != 0) if len(ids) else np.zeros(0, np.int64)  # equal ids are equal

    def _hashed(self, first: int, length: int) -> Spans:
        """Spans of the step that starts at first, with what its last strings of length bytes reach over."""
        return Spans(self.data[first : first + STEP_BYTES + length - 1] + np.uint64(1), "bytes")

    def blocks(self) -> dict[str, np.ndarray]:
        """Blocks: strings in a row from one cut to the next, told by a digest of their bytes, and the distinct ones.

        starts, stops, doc, entry: of each block, its strings, document and place among
        the distinct ones; keys, digests, first_doc, first: of each distinct one, the halves
        of its digest, in their order, its first document here, and its first block.
        """
        gram = min(BLOCK_GRAM, self.length)
        ends = self.firsts + self.sizes - self.length + 1  # behind the last string
        cuts = [self.firsts[self.sizes >= self.length]]
        for first in range(0, len(self.data) - gram + 1, STEP_BYTES):
            hashes = mixed(self._hashed(first, gram).every(gram))
            cuts.append(first + np.flatnonzero(hashes >> np.uint64(64 - BLOCK_BITS) == 0))
        starts = np.unique(np.concatenate(cuts))
        doc = np.searchsorted(self.firsts, starts, "right") - 1
        within = starts < ends[doc]
        starts, doc = starts[within], doc[within]
        stops = np.minimum(np.append(starts[1:], len(self.data)), ends[doc])
        view = memoryview(self.data)
        told = b"".join([blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), (stops + self.length - 1).tolist())])
        key, digest = np.frombuffer(told, np.uint64).reshape(-1, 2).T
        order = np.lexsort((digest, key))  # stable, so the first document comes first
        new = (np.diff(key[order], prepend=np.uint64(0)) != 0) | (np.diff(digest[order], prepend=np.uint64(0)) != 0)
        new[:1] = True
        entry = np.zeros(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        lead = order[new]
        return {"starts": starts, "stops": stops, "doc": doc, "entry": entry, "keys": key[lead], "digests": digest[lead], "first_doc": doc[lead], "first": lead}

    def covered(self, answers: np.ndarray) -> np.ndarray:
        """Which strings stand in a block that an earlier document has; answers: of each distinct block, LATER if one of another chunk has."""
        blocks = self.found = self.blocks()
        entry = blocks["entry"]
        gone = (answers[entry] == LATER) | (self.rank[blocks["doc"]] > self.rank[blocks["first_doc"][entry]])
        edges = np.zeros(len(self.data) + 1, np.int8)
        edges[blocks["starts"][gone]] += 1
        edges[blocks["stops"][gone]] -= 1
        return np.cumsum(edges[:-1], dtype=np.int8) > 0


class Chunk(Texts):
    """The regions of a chunk: strings in a row with one anchor, but for those that are covered.

    Hashes are worked out STEP_BYTES of text at a time, so that a chunk takes little
    more memory than its text and its regions. A region ends where a step does.
    """

    def __init__(self, blob: bytes, ids: np.ndarray, sizes: np.ndarray, length: int, blocks: np.ndarray | None = None):
        super().__init__(blob, ids, sizes, length)
        self.width = max(1, min(length // 2, 60))  # strings that an anchor can serve
        self.gone = np.zeros(len(self.data), bool) if blocks is None else self.covered(blocks)
        found = [self._regions(a) for a in range(0, max(1, len(self.data) - length + 1), STEP_BYTES)]
        self.starts, self.stops, self.offsets, self.doc, self.hashes, self.contents = map(np.concatenate, zip(*found))

    def _regions(self, first: int) -> tuple[np.ndarray, ...]:
        length, width = self.length, self.width
        spans = self._hashed(first, length)
        hashes = mixed(spans.every(length - width + 1))
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        at = np.arange(len(low), dtype=np.int32)
        done = 1
        while done < width and len(low):
            step = min(done, width - done)
            left = low[:-step] <= low[step:]  # the leftmost of equals
            low, at = np.where(left, low[:-step], low[step:]), np.where(left, at[:-step], at[step:])
            done += step
        strings = max(0, len(spans.sums) - length)
        at = at[:strings]
        places = np.arange(first, first + len(spans.sums) - 1)
        owner = (np.searchsorted(self.firsts, places, "right") - 1).astype(np.int32)
        # documents without bytes share their place with the next one, which searchsorted takes
        at[(owner[:strings] != owner[length - 1 :]) | self.gone[first : first + strings]] = -1  # over the end of a document, or covered
        turns = np.flatnonzero(np.diff(at, prepend=np.int32(-2)))
        stops = np.append(turns, strings)[1:]
        kept = at[turns] >= 0
        starts, stops = turns[kept], stops[kept]
        anchors = at[starts].astype(np.int64)
        offsets = (anchors - starts).astype(np.uint8)
        contents = mixed(spans.of(starts, stops + length - 1) + offsets)
        # the least of many hashes are small ones; mixed again, they fill all ranges alike
        return starts + first, stops + first, offsets, owner[starts], mixed(hashes[anchors] + M1), contents

    def anchor_codes(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchors' hashes without their low bits, each once, and the place of each region's among them."""
        return np.unique(self.hashes >> np.uint64(16) << np.uint64(16), return_inverse=True)

    def shared_here(self, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether two documents of this chunk have the anchor."""
        rank = self.rank[self.doc]
        low, high = np.full(len(codes), len(rank)), np.full(len(codes), -1)
        np.minimum.at(low, place, rank)
        np.maximum.at(high, place, rank)
        return low < high

    def entries(self, answers: np.ndarray) -> dict[str, np.ndarray]:
        """Regions to compare elsewhere, each content once, by key; with where they stand.

        answers, for each code: 0 alone, 1 shared, 2 common. first..: the entries; of..:
        each place's entry, start, strings and document.
        """
        codes, place = self.anchor_codes()
        answer = np.maximum(answers[place], self.shared_here(codes, place)[place])
        shared, common = np.flatnonzero(answer == 1), np.flatnonzero(answer == 2)
        start, strings = self.starts[shared], self.stops[shared] - self.starts[shared]
        apart = _cells(self.starts[common], self.stops[common] - self.starts[common])
        lone = np.repeat(self.doc[common], self.stops[common] - self.starts[common])
        alone = np.zeros(len(apart), np.uint64)
        for step in np.unique(apart // STEP_BYTES).tolist():
            own = np.flatnonzero(apart // STEP_BYTES == step)
            at = apart[own] - step * STEP_BYTES
            alone[own] = mixed(self._hashed(step * STEP_BYTES, self.length).of(at, at + self.length))
        key = np.concatenate([self.hashes[shared], alone])
        offset = np.concatenate([self.offsets[shared], np.full(len(apart), 255, np.uint8)])
        content = np.concatenate([self.contents[shared], alone])
        start, strings, doc = np.concatenate([start, apart]), np.concatenate([strings, np.ones(len(apart), np.int64)]), np.concatenate([self.doc[shared], lone])
        size = strings + self.length - 1
        content = mixed(content + key + strings.astype(np.uint64))
        order = np.lexsort((self.rank[doc], content, key))
        key, offset, start, strings, doc, size, content = (x[order] for x in (key, offset, start, strings, doc, size, content))
        new = (np.diff(key, prepend=np.uint64(0)) != 0) | (np.diff(content, prepend=np.uint64(0)) != 0)
        if len(new):
            new[0] = True
        _verify(new, np.arange(len(new)), self.data, start, offset, size)
        entry = np.cumsum(new) - 1
        return {"key": key[new], "offset": offset[new], "strings": strings[new].astype(np.uint8), "first_start": start[new], "first_size": size[new], "first_doc": doc[new], "entry": entry, "start": start, "count": strings, "doc": doc}


def _chunks(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """The table of chunks (chunk, ids, sizes, blob), written to the shared folder, and its name."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            number += 1
            order = sorted(range(len(ids)), key=ids.__getitem__)
            blob = zstandard.compress(b"".join([texts[i] for i in order]), 3)
            out = pa.record_batch([pa.array([number]), pa.array([[ids[i] for i in order]]), pa.array([[len(texts[i]) for i in order]]), pa.array([blob], pa.binary())], ["chunk", "ids", "sizes", "blob"])
            ids.clear()
            texts.clear()
            size = 0
            return out

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if texts and (size + len(text) > CHUNK_BYTES or len(texts) == 1 << 16):
                    yield flush()
                ids.append(_NO_ID if name is None else name)
                texts.append(text)
                size += len(text) + 16
        if texts:
            yield flush()

    spark = df.sparkSession
    source = df.select(df[id_col].cast("long").alias("_id"), text_of(text_col).alias("_text"))
    buckets = min(MOST_BUCKETS, max(4, 2 * source.rdd.getNumPartitions()))
    name = f"chunks_{uuid.uuid4().hex}"
    packed = source.mapInArrow(released(pack), "chunk long, ids array<long>, sizes array<long>, blob binary")
    # dealt out as buckets are, so that each is one file, however many tasks have packed
    packed.repartition(buckets, "chunk").write.format("parquet").option("compression", "none").option("path", f"{folder(spark)}/{name}").bucketBy(buckets, "chunk").saveAsTable(name)
    return spark.table(name), name


def _opened(batch: pa.RecordBatch, i: int, length: int, kind=Chunk, **more) -> Texts:
    ids, sizes = (np.asarray(batch.column(c)[i].values.to_numpy(zero_copy_only=False), np.int64) for c in (1, 2))
    return kind(batch.column(3)[i].as_buffer().to_pybytes(), ids, sizes, length, **more)


def _answered(column: pa.Array, i: int, kind) -> np.ndarray:
    """The answers of all ranges to a chunk, in the order of the ranges."""
    parts = sorted((x["range"], x["answer"]) for x in (column[i].as_py() or []))
    return np.concatenate([np.zeros(0, kind), *[_unpack(x, kind) for _, x in parts]])


def _to_ranges(chunk: int, keys: np.ndarray, n: int, packed) -> pa.RecordBatch:
    """A row for each of the n ranges that has keys; packed: from a slice of the sorted keys to the row's columns."""
    bounds = _ranges(keys, n)
    held = [(i, packed(slice(a, b))) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
    names = list(packed(slice(0, 0)))
    return pa.record_batch([pa.array([chunk] * len(held), pa.int64()), pa.array([i for i, _ in held], pa.int32()), *[pa.array([x[c] for _, x in held], pa.binary()) for c in names]], ["chunk", "range", *names])


def _answers(rows: pa.Table, answer: np.ndarray, counts: list[int]) -> pa.RecordBatch:
    """What goes back: to each of a range's rows, the answers to its keys."""
    ends = np.cumsum(counts)
    blobs = [_pack(answer[b - n : b]) for b, n in zip(ends, counts)]
    return pa.record_batch([pa.array(rows.column("chunk").to_numpy()), pa.array(rows.column("range").to_numpy()), pa.array(blobs, pa.binary())], ["chunk", "range", "answer"])


@contextmanager
def repeats_removed(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> Iterator[DataFrame]:
    """What remove_repeats() gives; the chunks are dropped afterwards, so it has to be written or read within."""
    chunks, name = _chunks(df, id_col, text_col)
    try:
        yield _without_repeats(chunks, df.schema[id_col].dataType.simpleString(), id_col, length)
    finally:
        spark = df.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, f"{folder(spark)}/{name}")


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id_col, n_bytes, spans, kept) of every row of df; ids are of an integer type.

    spans: maximal [start, stop) runs of bytes under strings of length bytes that also
    start in a document with a smaller id; kept: the other bytes, in order. Repeats
    within one document, and between rows of equal ids, are no repeats. A null id comes
    before all others. A null text has no bytes; texts shorter than length stay as they
    are. Other columns are not read; an empty df gives no rows.

    The result reads the table of chunks in the checkpoint folder, which stays;
    repeats_removed() drops it.
    """
    return _without_repeats(_chunks(df, id_col, text_col)[0], df.schema[id_col].dataType.simpleString(), id_col, length)


def _without_repeats(chunks: DataFrame, kind: str, id_col: str, length: int) -> DataFrame:
    n = max(8, chunks.count() // RANGE_CHUNKS)

    def exchanged(asked: DataFrame, send, columns: str, answer, name: str) -> DataFrame:
        """asked with the ranges' answers to what send makes of each chunk, in the column name."""

        def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in groups(_swapped(batches)):
                yield answer(rows)

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield send(batch, i)

        # ranges are dealt out one by one: a hash of their few numbers would deal them unevenly
        dealt = asked.mapInArrow(released(sent), f"chunk long, range int, {columns}").repartitionById(n, F.col("range")).sortWithinPartitions("range", "chunk")
        answers = dealt.mapInArrow(released(answered), "chunk long, range int, answer binary")
        # one row for each chunk, written once: its answers are as many as what it sent
        gathered = checkpoint(answers.groupBy("chunk").agg(F.collect_list(F.struct("range", "answer")).alias(name)))
        return asked.join(gathered.hint("shuffle_hash"), "chunk", "left").select(*asked.columns, name)

    def send_blocks(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        chunk = _opened(batch, i, length, Texts)
        found = chunk.blocks()
        owners = chunk.ids[found["first_doc"]]
        return _to_ranges(batch.column(0)[i].as_py(), found["keys"], n, lambda own: {"keys": _pack_sorted(found["keys"][own]), "digests": _pack(found["digests"][own]), "owners": _pack(owners[own])})

    def answer_blocks(rows: pa.Table) -> pa.RecordBatch:
        held = [_unpack_sorted(x) for x in rows.column("keys").to_pylist()]
        digests_, owners = (np.concatenate([_unpack(x, k) for x in rows.column(c).to_pylist()]) for c, k in (("digests", np.uint64), ("owners", np.int64)))
        keys = np.concatenate(held)
        order = np.lexsort((owners, digests_, keys))
        new = (np.diff(keys[order], prepend=np.uint64(0)) != 0) | (np.diff(digests_[order], prepend=np.uint64(0)) != 0)
        new[:1] = True
        least = owners[order][new][np.cumsum(new) - 1]
        several = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1
        told = np.zeros(len(keys), np.uint8)
        told[order] = np.where(owners[order] > least, LATER, np.where(several, SHARED, ALONE))
        return _answers(rows, told, [*map(len, held)])

    def opened(batch: pa.RecordBatch, i: int) -> Chunk:
        return _opened(batch, i, length, blocks=_answered(batch.column(4), i, np.uint8))

    def send_anchors(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        answers = _answered(batch.column(4), i, np.uint8)
        chunk = _opened(batch, i, length, blocks=answers)
        codes, _ = chunk.anchor_codes()
        blocks, shared = chunk.found, np.flatnonzero(answers != ALONE)
        keys, start = blocks["keys"][shared], blocks["starts"][blocks["first"][shared]]
        size = blocks["stops"][blocks["first"][shared]] + length - 1 - start
        of_codes, of_keys, out = _ranges(codes, n), _ranges(keys, n), []
        for k, (a, b, c, d) in enumerate(zip(of_codes, of_codes[1:], of_keys, of_keys[1:])):
            if a < b or c < d:
                text = chunk.data[_cells(start[c:d], size[c:d])].tobytes()
                out.append((batch.column(0)[i].as_py(), k, _pack_sorted(codes[a:b]), _pack_sorted(keys[c:d]), _pack(blocks["digests"][shared[c:d]]), _pack(size[c:d]), zstandard.compress(text, 1)))
        kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 5)
        return pa.record_batch([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)], ["chunk", "range", "codes", "keys", "digests", "sizes", "texts"])

    def answer_anchors(rows: pa.Table) -> pa.RecordBatch:
        held = [_unpack_sorted(x) for x in rows.column("codes").to_pylist()]
        _, place, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        check_blocks(rows)
        return _answers(rows, ((times > 1).astype(np.uint8) + (times > COMMON_CHUNKS))[place], [*map(len, held)])

    def check_blocks(rows: pa.Table) -> None:
        """Blocks of one digest have the same bytes."""
        keys = np.concatenate([_unpack_sorted(x) for x in rows.column("keys").to_pylist()])
        digests_, sizes = (np.concatenate([_unpack(x, k) for x in rows.column(c).to_pylist()]) for c, k in (("digests", np.uint64), ("sizes", np.int64)))
        data = np.frombuffer(b"".join([zstandard.decompress(x) for x in rows.column("texts").to_pylist()]) or b"\0", np.uint8)
        start = np.cumsum(sizes) - sizes
        order = np.lexsort((digests_, keys))
        same = np.flatnonzero((np.diff(keys[order]) == 0) & (np.diff(digests_[order]) == 0))
        a, b = order[same], order[same + 1]
        if (sizes[a] != sizes[b]).any() or not _same_bytes(data, start[a], start[b], sizes[a]).all():
            raise ValueError("two blocks of different bytes have one digest")

    def send_regions(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        chunk = opened(batch, i)
        found = chunk.entries(_answered(batch.column(5), i, np.uint8))

        def packed(own: slice) -> dict[str, bytes]:
            text = chunk.data[_cells(found["first_start"][own], found["first_size"][own])].tobytes()
            return {"keys": _pack_sorted(found["key"][own]), "offsets": _pack(found["offset"][own]), "strings": _pack(found["strings"][own]), "owners": _pack(chunk.ids[found["first_doc"][own]]), "texts": zstandard.compress(text, 3)}

        return _to_ranges(batch.column(0)[i].as_py(), found["key"], n, packed)

    def answer_regions(rows: pa.Table) -> pa.RecordBatch:
        keys = [_unpack_sorted(x) for x in rows.column("keys").to_pylist()]
        offsets, strings, owners = (np.concatenate([_unpack(x, k) for x in rows.column(c).to_pylist()]) for c, k in (("offsets", np.uint8), ("strings", np.uint8), ("owners", np.int64)))
        data = np.frombuffer(b"".join([zstandard.decompress(x) for x in rows.column("texts").to_pylist()]), np.uint8)
        return _answers(rows, _masks(np.concatenate(keys), offsets, strings.astype(np.int64), owners, data, length), [*map(len, keys)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = opened(batch, i)
                removed = _removed(chunk, chunk.entries(_answered(batch.column(5), i, np.uint8)), _answered(batch.column(6), i, np.uint64))
                spans, kept = [], []
                for a, size in zip(chunk.firsts.tolist(), chunk.sizes.tolist()):
                    own = removed[a : a + size]
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                    spans.append([{"start": x, "stop": y} for x, y in turns.reshape(-1, 2).tolist()])
                    kept.append(chunk.data[a : a + size][~own].tobytes())
                ids = pa.array(chunk.ids, mask=chunk.ids == _NO_ID)
                yield pa.record_batch([ids, pa.array(chunk.sizes), pa.array(spans, spans_type), pa.array(kept, pa.binary())], ["_id", "n_bytes", "spans", "kept"])

    asked = exchanged(chunks, send_blocks, "keys binary, digests binary, owners binary", answer_blocks, "blocks")
    asked = exchanged(asked, send_anchors, "codes binary, keys binary, digests binary, sizes binary, texts binary", answer_anchors, "anchors")
    asked = exchanged(asked, send_regions, "keys binary, offsets binary, strings binary, owners binary, texts binary", answer_regions, "regions")
    done = asked.mapInArrow(released(cut), "_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    return done.select(F.col("_id").cast(kind).alias(id_col), "n_bytes", "spans", "kept")


def _swapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(range, chunk, ...) of (chunk, range, ...): with chunk set apart, groups() finds the rows of a range."""
    for batch in batches:
        zero = pa.array(np.zeros(batch.num_rows, np.int64))
        yield pa.record_batch([batch.column(1), zero, *batch.columns[2:], batch.column(0)], ["range", "zero", *batch.schema.names[2:], "chunk"])


def _masks(keys, offsets, strings, owners, data, length) -> np.ndarray:
    """For each region, which of its strings an earlier document has (bit w: the one at w)."""
    full = (np.uint64(1) << strings.astype(np.uint64)) - np.uint64(1)
    masks = np.zeros(len(keys), np.uint64)
    size = strings + length - 1
    begin = np.cumsum(size) - size
    order = np.argsort(keys, kind="stable")
    edge = np.flatnonzero(np.diff(keys[order], prepend=keys[order][:1] - np.uint64(1)))
    load = np.cumsum(size[order])
    a = 0
    while a < len(order):
        fits = np.searchsorted(load, (load[a - 1] if a else 0) + SLICE_BYTES, "right")
        later = np.searchsorted(edge, max(fits, a + 1))
        b = len(order) if fits >= len(order) else int(edge[later - 1]) if later and edge[later - 1] > a else int(edge[later]) if later < len(edge) else len(order)
        own = order[a:b]
        masks[own] = _slice_masks(keys[own], offsets[own], strings[own], owners[own], data[_cells(begin[own], size[own])], full[own], length)
        a = b
    return masks


def _slice_masks(keys, offsets, strings, owners, data, full, length) -> np.ndarray:
    size = strings + length - 1
    begin = np.cumsum(size) - size
    spans = Spans(data + np.uint64(1), "bytes")
    content = mixed(spans.of(begin, begin + size) + offsets + strings.astype(np.uint64) * np.uint64(977))
    order = np.lexsort((owners, content, keys))
    new = (np.diff(keys[order], prepend=np.uint64(0)) != 0) | (np.diff(content[order], prepend=np.uint64(0)) != 0)
    new[0] = True
    _verify(new, order, data, begin, offsets, size)
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    masks = np.zeros(len(keys), np.uint64)
    later = owners[order] > owners[lead]
    masks[order[later]] = full[order[later]]
    # strings of different regions with one anchor: of each region, the earliest document's
    reps = order[new]
    several = np.flatnonzero(np.bincount(np.cumsum(np.diff(keys[reps], prepend=keys[reps][:1]) != 0)) > 1)
    reps = reps[np.isin(np.cumsum(np.diff(keys[reps], prepend=keys[reps][:1]) != 0), several)]
    if not len(reps):
        return masks
    owner = np.repeat(reps, strings[reps])
    w = _cells(np.zeros(len(reps), np.int64), strings[reps])
    at = begin[owner] + w
    # equal strings have equal anchors at equal places
    group = mixed(keys[owner] + (offsets[owner].astype(np.int64) - w).astype(np.uint64) * np.uint64(0x9E3779B1))
    able = np.argsort(group, kind="stable")
    rank, equal = sort_suffixes(data, spans, at[able], np.cumsum(np.diff(group[able], prepend=group[able][:1]) != 0), length)
    able = able[rank]
    if len(able):
        runs = np.flatnonzero(~equal)
        least = np.repeat(np.minimum.reduceat(owners[owner[able]], runs), np.diff(np.append(runs, len(able))))
        hit = able[owners[owner[able]] > least]
        found = np.zeros(len(keys), np.uint64)
        np.bitwise_or.at(found, owner[hit], np.uint64(1) << w[hit].astype(np.uint64))
        # rows of one document may share a region
        ties = owners[order] == owners[lead]
        masks[order[ties]] |= found[lead[ties]]
    return masks


def _removed(chunk: Chunk, found: dict[str, np.ndarray], masks: np.ndarray) -> np.ndarray:
    """Which bytes of the chunk go."""
    edges = np.zeros(len(chunk.data) + chunk.length, np.int32)
    turns = np.flatnonzero(np.diff(chunk.gone.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    edges[turns[::2]] += 1
    edges[turns[1::2] + chunk.length - 1] -= 1
    entry, start, count = found["entry"], found["start"], found["count"]
    own = masks[entry]
    full = (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
    whole = (chunk.rank[found["doc"]] > chunk.rank[found["first_doc"][entry]]) | (own == full)
    np.add.at(edges, start[whole], 1)
    np.add.at(edges, start[whole] + count[whole] + chunk.length - 1, -1)
    part = np.flatnonzero(~whole & (own != 0))
    for w in range(chunk.width):
        at = start[part[(own[part] >> np.uint64(w)) & np.uint64(1) == 1]] + w
        np.add.at(edges, at, 1)
        np.add.at(edges, at + chunk.length, -1)
    return np.cumsum(edges[: len(chunk.data)], dtype=np.int32) > 0


def digests(done: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """What remove_repeats() found: (id_col, n_bytes, n_removed, n_spans, kept_sha256)."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return done.select(id_col, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
