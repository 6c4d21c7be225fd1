"""Near copies by similarity: SimHash fingerprints choose who is compared, shingles decide.

Fingerprints of two texts whose sets of shingles are as similar as 0.8 differ in about ten
bits of 64, which no tree of fingerprints can tell from chance in a large corpus. So
texts first meet in buckets: of BANDS runs of ROWS minimum hashes, two such texts share
one with a probability of 0.995. In a bucket, fingerprints choose what is compared: the
centre (the text next to the majority of the bucket's bits, which in a group of copies
of one text is nearest to that text), and for each text its nearest one. The vantage-point
trees add what differs in 3 bits at most. Candidates are as many as the texts, not as
the pairs; each is verified on the whole sets, and verified ones are linked.

What those leave out is found by prefixes: of two sets with so much in common, one
shingle at least is among the first of both, in an order for all sets that has common
shingles last. Under such shingles only nodes of groups that aren't linked yet meet.

Texts of one set are one node from the start. Buckets of more than SPLIT nodes are dealt
out by salt, and have one centre nevertheless, out of sums over all of their bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import checkpoint, released, slices, text_of
from reelspark.llm.hashing import mixed
from reelspark.llm.simhash import BATCH_BYTES, groups, links, print_of, shingle_hashes
from reelspark.operators.components import connected_components
from reelspark.operators.lineage import swept

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 10, 4
#: Nodes of a bucket that are compared by their fingerprints in one task.
SPLIT = 1 << 14
#: Nearest fingerprints that differ in more bits aren't candidates: at a similarity of 0.8, 1 of 10,000 pairs of long texts does.
MOST_BITS = 22
#: Of one text in so many, shingles are counted for the order of prefixes; from how many on they are common; how many common ones are told apart at most.
COUNTED, COMMON, MOST_COMMON = 16, 4, 1 << 17
#: Nodes to compare that are sent to all tasks at most.
FEW = 200_000
#: Candidates by prefixes are compared by so many bits at least before their sets are.
PARITY_BITS = 512
_FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def set_hash(distinct: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mixed(mixed(distinct) + np.uint64(len(distinct)))))


def sketch(hashes: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(fingerprint, hash of the set, band hashes) of a text's shingle hashes; no shingles have no bands."""
    distinct = np.unique(hashes)
    told = mixed(distinct)
    if not len(distinct):
        return 0, 0, np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(distinct), 1 << 12):
        np.minimum(least, (told[i : i + (1 << 12), None] * _FACTORS[None, :]).min(axis=0), out=least)
    bands = np.zeros(BANDS, np.uint64)
    for row in range(ROWS):
        bands = mixed(bands + least.reshape(BANDS, ROWS)[:, row])
    return print_of(hashes), set_hash(distinct), mixed(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def similar(one: np.ndarray, two: np.ndarray, similarity: float) -> bool:
    """Whether two sets (sorted) have so much of their union in common."""
    if min(len(one), len(two)) < similarity * max(len(one), len(two)) - 1e-9:
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both >= similarity * (len(one) + len(two) - both) - 1e-9


def candidates(prints: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places of a bucket: each with the centre, and with its nearest one."""
    n = len(prints)
    if n < 2:
        return []
    bits = np.unpackbits(prints.byteswap().view(np.uint8).reshape(n, 8), axis=1)
    majority = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > n).view(">u8").astype(np.uint64)[0]
    centre = int(np.argmin(np.bitwise_count(prints ^ majority)))
    found = {(i, centre) for i in range(n) if i != centre}
    step = max(1, (1 << 20) // n)
    for i in range(0, n, step):
        own = np.arange(i, min(n, i + step))
        away = np.bitwise_count(prints[own][:, None] ^ prints[None, :])
        away[np.arange(len(own)), own] = 255
        near = away.argmin(axis=1)
        found |= {(int(a), int(b)) for a, b, d in zip(own, near, away[np.arange(len(own)), near]) if d <= MOST_BITS}
    return sorted({(min(x), max(x)) for x in found})


def _sketches(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(_id, _hash, _node, _print, _bands) of every row; _node: hex digits of fingerprint and set, the same for all texts of one set."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 2, BATCH_BYTES):
            told = [sketch(shingle_hashes(x.encode(), shingle)) for x in rows.column(2).to_pylist()]
            prints = pa.array(np.array([x[0] for x in told], np.uint64).view(np.int64))
            yield pa.record_batch([rows.column(0), rows.column(1), pa.array([f"{p:016x}{s:016x}" for p, s, _ in told]), prints, pa.array([b for *_, b in told], pa.list_(pa.int64()))], ["_id", "_hash", "_node", "_print", "_bands"])

    return df.select(df[id_col].alias("_id"), F.xxhash64(text_of(text_col)).alias("_hash"), text_of(text_col).alias("_text")).mapInArrow(released(run), f"_id {kind}, _hash long, _node string, _print long, _bands array<long>")


def _key(node: str) -> Column:
    """The hash of a node's set."""
    return F.conv(F.substring(node, 17, 16), 16, -10).cast("long")


def _bit(column: Column, i: int) -> Column:
    return F.shiftrightunsigned(column, i).bitwiseAND(F.lit(1))


def _met(nodes: DataFrame) -> DataFrame:
    """Candidates (a, b) out of the buckets of nodes (_node, _print, _bands)."""
    rows = nodes.select("_node", "_print", F.explode("_bands").alias("_band"))
    large = F.broadcast(checkpoint(rows.groupBy("_band").agg(F.count("*").alias("_n")).filter(F.col("_n") > SPLIT)))  # BANDS of SPLIT nodes at most
    dealt = rows.join(large, "_band", "left").withColumn("_salt", F.pmod(F.xxhash64("_node"), F.coalesce(F.ceil(F.col("_n") / SPLIT), F.lit(1)).cast("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in groups(batches):
            if bucket.num_rows > 1:
                order = np.argsort(bucket.column(2).to_numpy(zero_copy_only=False), kind="stable")  # so that ties go alike whatever the order of rows
                found = candidates(bucket.column(3).to_numpy().view(np.uint64)[order])
                node = bucket.column(2).combine_chunks().take(pa.array(order))
                yield pa.record_batch([node.take(pa.array([a for a, _ in found], pa.int64())), node.take(pa.array([b for _, b in found], pa.int64()))], ["a", "b"])

    own = dealt.select("_band", "_salt", "_node", "_print").repartition("_band", "_salt").sortWithinPartitions("_band", "_salt").mapInArrow(run, "a string, b string")
    # of large buckets, one centre over all salts: each bit's sum, then the nearest node, both made in the map tasks first
    hot = rows.join(large, "_band")
    sums = hot.groupBy("_band").agg(*[F.sum(F.when(_bit(F.col("_print"), i) == 1, 1).otherwise(-1)).alias(f"_b{i}") for i in range(64)])
    middle = F.lit(0).cast("long")
    for i in range(64):
        middle = middle.bitwiseOR(F.when(F.col(f"_b{i}") > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    away = F.bit_count(F.col("_print").bitwiseXOR(F.col("_middle")))
    centres = checkpoint(hot.join(F.broadcast(checkpoint(sums.select("_band", middle.alias("_middle")))), "_band").groupBy("_band").agg(F.min(F.struct(away.alias("away"), F.col("_node").alias("node"))).alias("_centre")))
    spokes = hot.join(F.broadcast(centres), "_band").select(F.least("_node", "_centre.node").alias("a"), F.greatest("_node", "_centre.node").alias("b")).filter("a <> b")
    return own.unionByName(spokes).distinct()


def prefix(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set (sorted): any set that has so much in common with it has one of them among its own first.

    The order is the same for all sets; common ones (sorted, with their counts) are last.
    """
    least = int(np.ceil(similarity * len(shingles) - 1e-6))
    weight = np.zeros(len(shingles), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        weight = np.where(common[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((mixed(shingles), weight))[: len(shingles) - least + 1]]


def parity(shingles: np.ndarray) -> bytes:
    """A bit or more for every two shingles, a power of two in all: the parity of how many shingles fall to it. Those of two sets differ in no more bits than the sets in shingles.

    Halves laid over each other give the parities of half as many bits.
    """
    bits = max(PARITY_BITS, 1 << ((len(shingles) - 1) // 2).bit_length())
    at = (mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


class Parities:
    """parity() of rows, by their length."""

    def __init__(self, told: list[bytes]):
        self.lengths = np.fromiter(map(len, told), np.int64, len(told))
        self.place = np.zeros(len(told), np.int64)
        self.held = {}
        for n in np.unique(self.lengths).tolist():
            own = np.flatnonzero(self.lengths == n)
            self.place[own] = np.arange(len(own))
            self.held[n] = np.frombuffer(b"".join([told[i] for i in own]), np.uint64).reshape(len(own), -1)

    def _cut(self, rows: np.ndarray, length: int) -> np.ndarray:
        out = np.zeros((len(rows), length // 8), np.uint64)
        for n in np.unique(self.lengths[rows]).tolist():
            own = self.lengths[rows] == n
            bits = self.held[n][self.place[rows[own]]]
            while bits.shape[1] > out.shape[1]:
                bits = bits[:, : bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2 :]
            out[own] = bits
        return out

    def apart(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """In how many bits the rows of each pair differ, at the shorter of their lengths."""
        lengths = np.minimum(self.lengths[one], self.lengths[two])
        out = np.zeros(len(one), np.int64)
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            step = max(1, (1 << 23) // n)
            for i in range(0, len(own), step):
                some = own[i : i + step]
                out[some] = np.bitwise_count(self._cut(one[some], n) ^ self._cut(two[some], n)).sum(axis=1, dtype=np.int64)
        return out


def meetings(shingles: np.ndarray, groups_: np.ndarray, sizes: np.ndarray, parities: list[bytes], similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows, sorted by shingle and group, that have a shingle but no group in common, and sizes and parities near enough."""
    told = Parities(parities)

    def fine(met: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        a, b = (np.concatenate(x) for x in zip(*met))
        near = told.apart(a, b) <= (1 - similarity) / (1 + similarity) * (sizes[a].astype(np.int64) + sizes[b]) + 1e-6
        return a[near], b[near]

    cuts = np.flatnonzero(np.diff(shingles, prepend=~shingles[:1], append=~shingles[-1:]))
    several = np.flatnonzero((np.diff(cuts) > 1) & (groups_[cuts[:-1]] != groups_[cuts[1:] - 1]))
    held, n = [], 0
    for k in several:
        start, stop = cuts[k], cuts[k + 1]
        step = max(1, (1 << 18) // int(stop - start))
        for i in range(start, stop, step):
            own, rest = slice(i, min(i + step, stop)), slice(i, stop)
            one, two = sizes[own, None], sizes[None, rest]
            a, b = np.nonzero((groups_[own, None] != groups_[None, rest]) & (np.minimum(one, two) >= similarity * np.maximum(one, two) - 1e-6))
            held.append((a[a < b] + i, b[a < b] + i))
            n += len(held[-1][0])
            if n >= 1 << 16:
                yield fine(held)
                held, n = [], 0
    if held:
        yield fine(held)


def _packed(parts: int, similarity: float):
    """An Arrow function: rows (key, group, size, prefix) to (part, shingles, keys, classes, groups), what falls to one of the parts packed; no groups where those are the keys.

    Sets that may be similar are of one class of sizes or of neighbouring ones.
    """
    ratio = -np.log(min(max(similarity, 0.01), 0.99))

    def packs(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        firsts, keys, groups_, classes = (np.concatenate(x) for x in zip(*held))
        part, rest = (firsts % np.uint64(parts)).astype(np.int32), (firsts // np.uint64(parts)).astype(np.uint32)
        for lone in (True, False):
            own = np.flatnonzero((keys == groups_) == lone)
            own = own[np.argsort(part[own], kind="stable")]
            cuts = np.flatnonzero(np.diff(part[own], prepend=-1, append=-1)) if len(own) else np.zeros(1, np.int64)
            spans = [own[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            columns = [[x[i].tobytes() for i in spans] for x in (rest, keys, classes)] + [[b"" if lone else groups_[i].tobytes() for i in spans]]
            yield pa.record_batch([pa.array([part[i[0]] for i in spans], pa.int32()), *[pa.array(x, pa.binary()) for x in columns]], ["_part", "_rests", "_keys", "_classes", "_groups"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            told = batch.column(3).to_pylist()
            counts = np.fromiter(map(len, told), np.int64, len(told)) // 8
            classes = np.minimum(np.log(batch.column(2).to_numpy()) / ratio, 255).astype(np.uint8)
            held.append((np.frombuffer(b"".join(told), np.uint64), *(np.repeat(x, counts) for x in (batch.column(0).to_numpy(), batch.column(1).to_numpy(), classes))))
            n += len(held[-1][0])
            if n >= 1 << 20:
                yield from packs(held)
                held, n = [], 0
        if n:
            yield from packs(held)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, key) of packed rows, sorted by part, where another group has the shingle in a set of about the size."""

    def told(part: int, held: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
        rest = np.frombuffer(b"".join(x[0] for x in held), np.uint32)
        keys = np.frombuffer(b"".join(x[1] for x in held), np.int64)
        groups_ = np.frombuffer(b"".join(x[3] or x[1] for x in held), np.int64)
        told = (rest.astype(np.int64) << 8) | np.frombuffer(b"".join(x[2] for x in held), np.uint8)
        order = np.lexsort((groups_, told))
        rest, keys, groups_, told = rest[order], keys[order], groups_[order], told[order]
        cuts = np.flatnonzero(np.diff(told, prepend=-1, append=-1))
        # of each run of a shingle and a class, and of the next ones if they are neighbours: the least and the greatest group
        least, most, run = groups_[cuts[:-1]], groups_[cuts[1:] - 1], told[cuts[:-1]]
        joins = (np.diff(run) == 1) & (run[1:] >> 8 == run[:-1] >> 8)
        low, high = least.copy(), most.copy()
        low[1:], high[1:] = np.where(joins, np.minimum(low[1:], least[:-1]), low[1:]), np.where(joins, np.maximum(high[1:], most[:-1]), high[1:])
        low[:-1], high[:-1] = np.where(joins, np.minimum(low[:-1], least[1:]), low[:-1]), np.where(joins, np.maximum(high[:-1], most[1:]), high[:-1])
        several = np.flatnonzero(np.repeat(low != high, np.diff(cuts)))
        for i in range(0, len(several), 1 << 16):
            own = several[i : i + (1 << 16)]
            yield pa.record_batch([pa.array(rest[own].astype(np.int64) + (part << 32)), pa.array(keys[own])], ["_shingle", "_key"])

    part, held = None, []
    for batch in batches:
        for at, *packs in zip(*(c.to_pylist() for c in batch.columns)):
            if at != part and held:
                yield from told(part, held)
                held = []
            part = at
            held.append(tuple(packs))
    if held:
        yield from told(part, held)


def _left_out(texts: DataFrame, grouped: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Candidates (a, b), nodes of different groups of grouped (_node, _group), out of the prefixes of texts (_text).

    Prefixes go out packed, to find the shingles that several groups have; only the rows
    under those take their parities along, and only pairs near enough by them come out.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, 0, BATCH_BYTES):
            for x in some.column(0).to_pylist():
                yield pa.record_batch([pa.array(np.unique(shingle_hashes(x.encode(), shingle)).view(np.int64))], ["_shingle"])

    part = texts.filter(F.pmod(F.xxhash64("_text"), F.lit(COUNTED)) == 0).distinct()
    often = part.mapInArrow(released(counted), "_shingle long").groupBy("_shingle").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "_shingle").limit(MOST_COMMON).collect()
    common, counts = np.array([r[0] for r in often], np.int64).view(np.uint64), np.array([r[1] for r in often], np.int64)
    order = np.argsort(common)
    common, counts = common[order], counts[order]

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, 0, BATCH_BYTES):
            sets = [np.unique(shingle_hashes(x.encode(), shingle)) for x in some.column(0).to_pylist()]
            sets = [x for x in sets if len(x)]
            told = [prefix(x, common, counts, similarity).tobytes() for x in sets]
            keys = pa.array(np.array([set_hash(x) for x in sets], np.uint64).view(np.int64))
            yield pa.record_batch([keys, pa.array([len(x) for x in sets], pa.int32()), pa.array([parity(x) for x in sets], pa.binary()), pa.array(told, pa.binary())], ["_key", "_size", "_parity", "_prefix"])

    # a group has the key of its least node; nodes of one key are of one group
    named = grouped.groupBy(_key("_node").alias("_key")).agg(F.min("_node").alias("_node"), F.min(_key("_group")).alias("_group"))
    own = texts.mapInArrow(released(firsts), "_key long, _size int, _parity binary, _prefix binary").groupBy("_key").agg(*[F.first(c).alias(c) for c in ("_size", "_parity", "_prefix")])
    rows = own.join(named.select("_key", "_group"), "_key")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.select("_key", "_group", "_size", "_prefix").mapInArrow(released(_packed(parts, similarity)), "_part int, _rests binary, _keys binary, _classes binary, _groups binary")
    shared = packed.repartition("_part").sortWithinPartitions("_part").mapInArrow(released(_shared), "_shingle long, _key long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = [rows.column(i).to_numpy() for i in range(4)]
            if len(columns[0]):
                for a, b in meetings(*columns[:3], rows.column(4).to_pylist(), similarity):
                    yield pa.record_batch([pa.array(columns[3][a]), pa.array(columns[3][b])], ["a", "b"])

        held = []
        for batch in batches:
            if batch.num_rows:
                cut = int(np.searchsorted(batch.column(0).to_numpy(), batch.column(0)[-1].as_py()))  # the last shingle may go on in the next batch
                if cut or held and held[0].column(0)[-1].as_py() != batch.column(0)[0].as_py():
                    yield from told(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                    held = []
                held.append(batch.slice(cut))
        if held:
            yield from told(pa.Table.from_batches(held))

    met = shared.join(rows.drop("_prefix"), "_key").select("_shingle", "_group", "_size", "_key", "_parity").repartition("_shingle").sortWithinPartitions("_shingle", "_group").mapInArrow(released(run), "a long, b long")
    keys = checkpoint(met.select(F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b")).distinct())
    of = lambda c: named.select(F.col("_key").alias(f"_{c}"), F.col("_node").alias(c))
    return keys.join(of("a"), "_a").join(of("b"), "_b").select("a", "b")


def _fine(df: DataFrame, rows: DataFrame, pairs: DataFrame, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """Those of the candidates (a, b) whose whole sets have so much in common; rows: of _sketches(df)."""
    asked = checkpoint(pairs.select(F.col("a").alias("_node")).unionByName(pairs.select(F.col("b").alias("_node"))).distinct())
    # the sets of those that are compared, each once: of a node, the text of its least row
    told = checkpoint(rows.join(asked, "_node").groupBy("_node").agg(F.min("_hash").alias("_hash")))
    told = F.broadcast(told) if told.count() <= FEW else told  # all texts are shuffled only for many
    texts = df.select(F.xxhash64(text_of(text_col)).alias("_hash"), text_of(text_col).alias("_text"))
    wanted = texts.join(told, "_hash").select("_node", "_text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, 1, BATCH_BYTES):
            yield pa.record_batch([some.column(0), pa.array([np.unique(shingle_hashes(x.encode(), shingle)).tobytes() for x in some.column(1).to_pylist()], pa.binary())], ["_node", "_set"])

    held = checkpoint(wanted.mapInArrow(released(sets), "_node string, _set binary").groupBy("_node").agg(F.first("_set").alias("_set")))  # copies have one set
    both = pairs.join(held.select(F.col("_node").alias("a"), F.col("_set").alias("_one")), "a").join(held.select(F.col("_node").alias("b"), F.col("_set").alias("_two")), "b")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            fine = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity) for x, y in zip(some.column(2).to_pylist(), some.column(3).to_pylist())]
            yield pa.record_batch(some.columns[:2], ["a", "b"]).filter(pa.array(fine, pa.bool_()))

    return both.select("a", "b", "_one", "_two").mapInArrow(released(verified), "a string, b string")


def near_copies(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(_id, _hash, component_id, _component) of every row of df; _hash: of its text.

    Texts link if of all the shingles that either has, both have so large a part; rows
    of one id link as well. component_id: the smallest id reachable, null where no row
    has one; _component tells components without an id apart. Texts that are null or
    have no words are one set; texts of fewer words than a shingle are one shingle.
    Repeated rows stay; an empty df gives no rows; other columns are not read.
    """
    rows = checkpoint(_sketches(df, id_col, text_col, shingle))
    nodes = checkpoint(rows.groupBy("_node").agg(F.first("_print").alias("_print"), F.first("_bands").alias("_bands")))
    # trees link numbers; a number here is a fingerprint, and stands for the least of its nodes
    same = nodes.groupBy("_print").agg(F.min("_node").alias("_least"))
    apart = nodes.join(same, "_print").filter("_node <> _least").select(F.col("_least").alias("a"), F.col("_node").alias("b"))
    near = links(checkpoint(same.select(F.col("_print").alias("_node"), "_print")))
    named = lambda c: same.select(F.col("_print").alias(c), F.col("_least").alias(f"_{c}"))
    close = near.join(named("a"), "a").join(named("b"), "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    pairs = checkpoint(_met(nodes).unionByName(apart).unionByName(close).distinct())
    several = rows.filter("_id is not null").groupBy("_id").agg(F.min("_node").alias("_least"), F.max("_node").alias("_most")).filter("_least <> _most").select("_id", "_least")
    shared = rows.join(several, "_id").filter("_node <> _least").select(F.col("_least").alias("a"), F.col("_node").alias("b")).distinct()
    # nodes of one set, whose words repeat in other numbers
    sets = nodes.groupBy(_key("_node").alias("_key")).agg(F.min("_node").alias("_least"), F.max("_node").alias("_most")).filter("_least <> _most").select("_key", "_least")
    twins = nodes.join(sets, _key("_node") == F.col("_key")).filter("_node <> _least").select(F.col("_least").alias("a"), F.col("_node").alias("b"))
    swept(df.sparkSession)
    linked = checkpoint(_fine(df, rows, pairs, text_col, shingle, similarity).unionByName(shared).unionByName(twins))
    known = nodes.select("_node").join(connected_components(linked).withColumnRenamed("node", "_node"), "_node", "left")
    grouped = checkpoint(known.select("_node", F.coalesce("component", "_node").alias("_group")))
    swept(df.sparkSession)
    more = checkpoint(_left_out(df.select(text_of(text_col).alias("_text")), grouped, shingle, similarity))
    swept(df.sparkSession)
    found = checkpoint(connected_components(linked.unionByName(_fine(df, rows, more, text_col, shingle, similarity)))).withColumnRenamed("node", "_node")
    labelled = rows.select("_id", "_hash", "_node").join(found, "_node", "left").select("_id", "_hash", F.coalesce("component", "_node").alias("_component"))
    least = labelled.groupBy("_component").agg(F.min("_id").alias("component_id"))
    return labelled.join(least, "_component").select("_id", "_hash", "component_id", "_component")
