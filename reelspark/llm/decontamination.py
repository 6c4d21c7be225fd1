"""Benchmark decontamination by winnowing.

Of every run of WINDOW words, the smallest hash of its GRAM-word grams is the run's
fingerprint, kept with its place. Equal runs have equal fingerprints at equal places, so
a join of a document's fingerprints with those of the benchmark misses no shared run of
WINDOW words or more. Each hit is extended to both sides, word by word, as far as a run
that holds it can reach; where that makes WINDOW words, they are hit. An item of fewer
words is one shorter run with a fingerprint of its own length.

Fingerprints of a benchmark within BLOCK_BYTES are joined in the tasks, by an index that
is broadcast. Those of a larger one are a table, joined by a shuffle with the documents'
fingerprints that a bitmap of fixed size lets pass; documents are read twice then,
however large the benchmark is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import checkpoint, once, slices, text_of
from reelspark.llm.hashing import Spans, mixed

WINDOW, GRAM = 10, 6
BATCH_BYTES = 1 << 20
#: How far a run that holds a fingerprint reaches beyond its gram, on either side.
REACH = WINDOW - GRAM
#: An index takes about four times the benchmark's text; one within this is broadcast.
BLOCK_BYTES = 16 << 20
#: Bits of the bitmap of fingerprints, so 4 MB, however large the benchmark.
BITMAP_BITS = 25
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[0x41:0x5B] += 0x20
_IN_WORD = np.zeros(258, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:0x100] = True


class _Words:
    """Words of several texts: their bytes, bounds, hashes and texts."""

    def __init__(self, texts: list[bytes]):
        joined = _FOLDED[np.frombuffer(b"\n".join(texts), np.uint8)]
        self.data = joined.tobytes()
        inside = np.zeros(len(joined) + 2, np.int8)
        inside[1:-1] = _IN_WORD[joined]
        turns = np.diff(inside)
        self.starts, self.stops = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        self.hashes = mixed(Spans(joined, "bytes").of(self.starts, self.stops) + (self.stops - self.starts).astype(np.uint64))
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        self.firsts = np.searchsorted(self.starts, np.concatenate([[0], ends]))  # of each text, and the end
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.firsts))
        self.spans = Spans(self.hashes, "words")

    def run(self, i: int, n: int) -> bytes:
        return b" ".join(self.data[a:b] for a, b in zip(self.starts[i : i + n].tolist(), self.stops[i : i + n].tolist()))

    def listed(self, i: int, j: int) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.starts[i:j].tolist(), self.stops[i:j].tolist())]

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the runs of n words within one text, and their hashes."""
        if len(self.hashes) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        within = np.flatnonzero(self.text_of[: len(self.text_of) - n + 1] == self.text_of[n - 1 :])
        return within, self.spans.every(n)[within]

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the fingerprints of all runs of WINDOW words, each once, and their hashes."""
        if len(self.hashes) < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        grams = mixed(self.spans.every(GRAM))
        low, at, done, width = grams, np.arange(len(grams)), 1, WINDOW - GRAM + 1
        while done < width:
            step = min(done, width - done)
            left = low[:-step] <= low[step:]  # the leftmost of equals
            low, at = np.where(left, low[:-step], low[step:]), np.where(left, at[:-step], at[step:])
            done += step
        at = np.unique(at[self.text_of[: len(at)] == self.text_of[WINDOW - 1 :]])
        return at, grams[at]

    def around(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the words that runs with a gram at these places can have."""
        own = self.text_of[at]
        return np.maximum(at - REACH, self.firsts[own]), np.minimum(at + GRAM + REACH, self.firsts[own + 1])


def extended(a: list[bytes], at: int, b: list[bytes], bt: int, n: int) -> tuple[int, int]:
    """(start, stop) in a of the words that agree with b around the n words at a[at] and b[bt]; none if these differ."""
    if a[at : at + n] != b[bt : bt + n]:
        return at, at
    left = right = 0
    while left < min(at, bt) and a[at - left - 1] == b[bt - left - 1]:
        left += 1
    while at + n + right < len(a) and bt + n + right < len(b) and a[at + n + right] == b[bt + n + right]:
        right += 1
    return at - left, at + n + right


class Index:
    """Fingerprints of a benchmark: sorted, each with the words around it, and the items that have it so."""

    def __init__(self, items: list[tuple[str, str]]):
        words = self.words = _Words([text.encode() for _, text in items])
        sizes = np.diff(words.firsts)
        name = lambda i: items[words.text_of[i]][0]
        at, prints = words.fingerprints()
        start, stop = words.around(at)
        # boilerplate of many items is one entry
        told: dict[tuple[int, int, bytes], list] = {}
        for p, q, a, b in zip(at.tolist(), prints.tolist(), start.tolist(), stop.tolist()):
            told.setdefault((q, p - a, words.run(a, b - a)), [p, set()])[1].add(name(p))
        held = sorted(((key[0], p, names) for key, (p, names) in told.items()), key=lambda x: x[0])
        self.prints = np.array([x[0] for x in held], np.uint64)
        self.at = np.array([x[1] for x in held], np.int64)
        self.names = [x[2] for x in held]
        self.start, self.stop = words.around(self.at)
        self.short: dict[int, tuple[np.ndarray, dict[int, dict[bytes, set[str]]]]] = {}
        for n in sorted({int(x) for x in sizes if 0 < x < WINDOW}):
            first = words.firsts[:-1][sizes == n]
            hashes = words.spans.of(first, first + n)
            found: dict[int, dict[bytes, set[str]]] = {}
            for i, h in zip(first.tolist(), hashes.tolist()):
                found.setdefault(h, {}).setdefault(words.run(i, n), set()).add(name(i))
            self.short[n] = np.unique(hashes), found

    def hits(self, texts: list[bytes]) -> tuple[_Words, np.ndarray, list[set[str]]]:
        """The texts' words, which of them are hit, and each text's items."""
        words, own = _Words(texts), self.words
        edges = np.zeros(len(words.hashes) + 1, np.int64)
        items: list[set[str]] = [set() for _ in texts]
        at, prints = words.fingerprints()
        low, high = np.searchsorted(self.prints, prints), np.searchsorted(self.prints, prints, "right")
        met = np.flatnonzero(high > low)
        for some in np.array_split(met, max(1, int((high - low)[met].sum()) >> 18)):
            count = (high - low)[some]
            p = np.repeat(at[some], count)
            j = np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[some], count)
            q = self.at[j]
            start, stop = words.around(p)
            left, right = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
            for reach, step, room in ((left, -1, np.minimum(p - start, q - self.start[j])), (right, 1, np.minimum(stop - p, self.stop[j] - q) - GRAM)):
                going = np.ones(len(p), bool)
                for d in range(REACH):
                    shift = -1 - d if step < 0 else GRAM + d
                    going &= room > d
                    going[going] = words.hashes[p[going] + shift] == own.hashes[q[going] + shift]
                    reach += going
            for i in np.flatnonzero(left + GRAM + right >= WINDOW).tolist():
                a, b = int(start[i]), int(self.start[j[i]])
                there = words.listed(a, int(stop[i])), own.listed(b, int(self.stop[j[i]]))
                x, y = extended(there[0], int(p[i]) - a, there[1], int(q[i]) - b, GRAM)
                if y - x >= WINDOW:
                    edges[a + x] += 1
                    edges[a + y] -= 1
                    items[words.text_of[p[i]]] |= self.names[j[i]]
        for n, (known, found) in self.short.items():
            starts, hashes = words.runs(n)
            take = _among(hashes, known)
            for i, h in zip(starts[take].tolist(), hashes[take].tolist()):
                if (names := found[h].get(words.run(i, n))) is not None:
                    edges[i] += 1
                    edges[i + n] -= 1
                    items[words.text_of[i]] |= names
        return words, np.cumsum(edges[:-1]) > 0, items


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def hit_words(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id_col, n_words, spans, item_ids) of every row of docs: runs of hit words as [start, stop), and the items hit.

    A null text has no words; a null id, repeated ids and repeated rows stay, one
    output row for each input row. A null item id counts as the empty string, items
    without words hit nothing, items that share an id count as one. Only the named
    columns are read, whatever others are called. An empty table on either side gives
    documents without hits, or no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(docs[id_col].alias("_id"), text_of(text_col).alias("_text"))
    named = items.select(F.coalesce(items[item_id].cast("string"), F.lit("")).alias("_item"), text_of(item_text).alias("_words"))
    total = named.select(F.sum(F.octet_length("_words"))).first()[0] or 0
    found = _by_index(source, kind, [tuple(r) for r in named.collect()]) if total * 4 <= block_bytes else _by_table(source, kind, named)
    return found.select(F.col("_id").alias(id_col), "n_words", "spans", "item_ids")


def _by_index(source: DataFrame, kind: str, items: list[tuple[str, str]]) -> DataFrame:
    sent = source.sparkSession.sparkContext.broadcast(items)
    key = f"decontamination {hashlib.sha256(repr(items).encode()).hexdigest()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = once(key, lambda: Index(sent.value))
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for rows in slices(batches, 1, BATCH_BYTES):
            words, hit, found = index.hits([x.encode() for x in rows.column(1).to_pylist()])
            spans = []
            for a, b in zip(words.firsts[:-1], words.firsts[1:]):
                turns = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]])))
                spans.append([{"start": x, "stop": y} for x, y in turns.reshape(-1, 2).tolist()])
            yield pa.record_batch([rows.column(0), pa.array(np.diff(words.firsts[: rows.num_rows + 1])), pa.array(spans, spans_type), pa.array([sorted(x) for x in found], pa.list_(pa.string()))], ["_id", "n_words", "spans", "item_ids"])

    return source.mapInArrow(run, f"_id {kind}, n_words long, spans array<struct<start:long,stop:long>>, item_ids array<string>")


def _prints(words: _Words, lengths: list[int], bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, ...]]:
    """(place, hash, length of an item or WINDOW, first and last word around it) of fingerprints; bits: those to pass."""
    at, prints = words.fingerprints()
    for n in [WINDOW, *lengths]:
        if n < WINDOW:
            at, prints = words.runs(n)
            prints = mixed(prints + np.uint64(n))
        if bits is not None:
            slot = prints >> np.uint64(64 - BITMAP_BITS)
            there = (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, prints = at[there], prints[there]
        start, stop = words.around(at) if n == WINDOW else (at, at + n)
        yield at, prints, np.full(len(at), n), start, stop


def _by_table(source: DataFrame, kind: str, items: DataFrame) -> DataFrame:
    """The same with the benchmark's fingerprints as a table: (print, n, at, around, items)."""
    columns = "print long, n int, at int, around binary"

    def rows_of(words: _Words, found: Iterator[tuple[np.ndarray, ...]], own: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
        for at, prints, n, start, stop in found:
            if len(at):
                text = words.text_of[at]
                around = pa.array([words.run(a, b - a) for a, b in zip(start.tolist(), stop.tolist())], pa.binary())
                yield pa.record_batch([*[own.column(c).take(pa.array(text)) for c in names], pa.array(start - words.firsts[text]), pa.array(prints.view(np.int64)), pa.array(n, pa.int32()), pa.array(at - start, pa.int32()), around], [*names, "first", "print", "n", "at", "around"])

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1, BATCH_BYTES):
            words = _Words([x.encode() for x in rows.column(1).to_pylist()])
            size = np.diff(words.firsts)
            for at, prints, n, start, stop in _prints(words, [*range(1, WINDOW)], None):
                whole = (n == WINDOW) | (size[words.text_of[at]] == n)
                yield from rows_of(words, iter([(at[whole], prints[whole], n[whole], start[whole], stop[whole])]), rows, ["_item"])

    listed = items.mapInArrow(of_items, f"_item string, first long, {columns}")
    table = checkpoint(listed.groupBy("print", "n", "at", "around").agg(F.collect_set("_item").alias("items")))
    lengths = [r.n for r in table.filter(F.col("n") < WINDOW).select("n").distinct().collect()]
    slot = F.shiftrightunsigned("print", 64 - BITMAP_BITS)
    bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    # at most one row for each 64 bits of the bitmap
    for r in table.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(print, {64 - BITMAP_BITS}) & 63 as int))")).alias("bits")).toLocalIterator():
        bits[8 * r.word : 8 * r.word + 8] = np.frombuffer((r.bits & (1 << 64) - 1).to_bytes(8, "little"), np.uint8)
    sent = source.sparkSession.sparkContext.broadcast(bits)
    keyed = source.select("_id", F.sha2("_text", 256).alias("_sha"), "_text")

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 2, BATCH_BYTES):
            words = _Words([x.encode() for x in rows.column(2).to_pylist()])
            yield from rows_of(words, _prints(words, lengths, sent.value), rows, ["_id", "_sha"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 2, BATCH_BYTES):
            words = _Words([x.encode() for x in rows.column(2).to_pylist()])
            yield pa.record_batch([rows.column(0), rows.column(1), pa.array(np.diff(words.firsts[: rows.num_rows + 1]))], ["_id", "_sha", "n_words"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            first, n, at, around, other_at, other = (rows.column(c).to_pylist() for c in ("first", "n", "at", "around", "other_at", "other"))
            runs = [extended(a.split(b" "), i, b.split(b" "), j, min(k, GRAM) if k == WINDOW else k) for a, i, b, j, k in zip(around, at, other, other_at, n)]
            held = [i for i, (x, y) in enumerate(runs) if y - x >= n[i]]
            took = pa.array(held, pa.int64())
            yield pa.record_batch([rows.column("_id").take(took), rows.column("_sha").take(took), pa.array([first[i] + runs[i][0] for i in held], pa.int64()), pa.array([first[i] + runs[i][1] for i in held], pa.int64()), rows.column("items").take(took)], ["_id", "_sha", "start", "stop", "items"])

    met = keyed.mapInArrow(of_documents, f"_id {kind}, _sha string, first long, {columns}").join(table.withColumnsRenamed({"at": "other_at", "around": "other"}), ["print", "n"])
    hits = met.mapInArrow(compared, f"_id {kind}, _sha string, start long, stop long, items array<string>")
    span = "struct<start:bigint,stop:bigint>"
    gathered = hits.groupBy("_id", "_sha").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
    # overlapping spans merge: fold over the sorted spans, the last one open
    last = lambda done: F.try_element_at(done, F.lit(-1))
    merged = F.aggregate(
        "_spans", F.expr(f"cast(array() as array<{span}>)"),
        lambda done, x: F.when((F.size(done) > 0) & (last(done)["stop"] >= x["start"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["stop"], x["stop"]).alias("stop"))))).otherwise(F.concat(done, F.array(x))),
    )
    told = gathered.select(F.col("_id").alias("_hit"), F.col("_sha").alias("_of"), merged.alias("spans"), "item_ids")
    every = keyed.mapInArrow(counted, f"_id {kind}, _sha string, n_words long")
    joined = every.join(told, F.col("_id").eqNullSafe(F.col("_hit")) & (F.col("_sha") == F.col("_of")), "left")
    return joined.select("_id", "n_words", F.coalesce("spans", F.expr(f"cast(array() as array<{span}>)")).alias("spans"), F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"))


def digests(hits: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """What hit_words() found, as counts: (id_col, n_words, n_hit, n_items, items_sha256, contaminated)."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return hits.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
