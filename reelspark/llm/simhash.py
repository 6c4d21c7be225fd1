"""SimHash near-duplicates, found exactly with vantage-point trees.

Two fingerprints of 64 bits that differ in at most 3 bits differ in at most 1 bit in
one of their halves. For each half, a vantage-point tree deals the fingerprints into
shards: a node holds a vantage point and a radius, and sends what is within the
radius inside, the rest outside. By the triangle inequality, a fingerprint can only
have partners on the other side of a node if its distance is within 1 of the radius;
only such ones also visit that side, as queries of boundary-overlapping shards. In a
shard all 64 bits are compared, so the links are exact. A shard gives out a spanning
forest of its links, not its pairs, and components are found on the forests.

The trees are fitted on a bounded sample of the fingerprints (TREE_SAMPLE, taken by
hash order); that decides the shards' sizes, not which links are found. A shard that
is large nevertheless gets a tree of its own, fitted on a sample of it, and its
fingerprints go through that to smaller shards in a second shuffle: each once, and
again for each boundary that it is next to, about a seventh of them at each level. So
of ten times the random fingerprints, some 15 times the rows are shuffled, and not 100.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import checkpoint, slices, text_of
from reelspark.operators.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BATCH_BYTES = 1 << 20
#: Fingerprints that fit the trees at most, 8 bytes each on the driver and in the tasks.
TREE_SAMPLE = 1 << 17
#: Fingerprints that a shard is to have, where the sample allows.
SHARD = 1024
#: Fingerprints that a task compares all with all; a larger shard is divided once more there.
LOCAL_SHARD = 1 << 12
#: Larger shards get a tree of their own, and go through it by so many rows a task.
SPLIT_SHARD = 1 << 14
_HALVES = 2
_REACH = MAX_BITS // _HALVES


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of all shingles of so many words (of fewer words: of all of them), A-Z lower-cased; repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    span = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - span].tolist(), stops[span:].tolist())], np.uint64)


def fingerprint(text: bytes) -> int:
    """SimHash over the shingles of a text: the bits that over half of their hashes have; no words give 0."""
    return print_of(shingle_hashes(text))


def print_of(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[i : i + (1 << 14)].byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _print long) of every row of df, of whole texts; a null text has no words."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1, BATCH_BYTES):
            prints = np.array([fingerprint(x.encode()) for x in rows.column(1).to_pylist()], np.uint64)
            yield pa.record_batch([rows.column(0), pa.array(prints.view(np.int64))], ["_id", "_print"])

    return df.select(df[id_col].alias("_id"), text_of(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, _print long")


def _half(prints: np.ndarray, half: int) -> np.ndarray:
    return ((prints >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Tree:
    """A complete vantage-point tree of some depth over 32-bit values; node i has the children 2i+1 and 2i+2."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.points = np.zeros((1 << depth) - 1, np.uint32)
        self.radii = np.zeros((1 << depth) - 1, np.int16)
        members = {0: sample}
        for node in range(len(self.points)):
            own = members.pop(node)
            if len(own):
                # of some candidates, the one whose distances spread most
                tried = own[:: max(1, len(own) // 8)][:8]
                far = np.bitwise_count(own[None, :] ^ tried[:, None])
                best = int(np.argmax(far.std(axis=1)))
                self.points[node] = tried[best]
                self.radii[node] = np.sort(far[best])[(len(own) - 1) // 2]
                inside = far[best] <= self.radii[node]
            else:
                inside = np.zeros(0, bool)
            members[2 * node + 1], members[2 * node + 2] = own[inside], own[~inside]

    @classmethod
    def of(cls, points: np.ndarray, radii: np.ndarray) -> Tree:
        """The tree of given nodes."""
        tree = cls.__new__(cls)
        tree.depth, tree.points, tree.radii = len(points).bit_length(), points, radii
        return tree

    def visits(self, values: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in values, leaf, at home) of every visit: one at home for those that have a home, and those as a query.

        Of two values with a node between them, the outer one visits the inner side,
        so a pair within reach meets once at least without the inner one going out.
        """
        place = np.arange(len(values))
        node = np.zeros(len(values), np.int64)
        for _ in range(self.depth):
            far = np.bitwise_count(values[place] ^ self.points[node]).astype(np.int16) - self.radii[node]
            inward = far <= np.where(home, 0, _REACH)
            outward = np.where(home, far > 0, far > -_REACH)
            crossing = home & (far > 0) & (far <= _REACH)
            place, node, home = (
                np.concatenate([place[inward], place[outward], place[crossing]]),
                np.concatenate([2 * node[inward] + 1, 2 * node[outward] + 2, 2 * node[crossing] + 1]),
                np.concatenate([home[inward], home[outward], np.zeros(int(crossing.sum()), bool)]),
            )
        return place, node - len(self.points), home


def forest(prints: np.ndarray, asks: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Root of each position, by the links between those that ask and those held; the root is the smallest position."""
    roots = np.arange(len(prints))
    kept = np.flatnonzero(held)
    asking = np.flatnonzero(asks)
    step = max(1, (1 << 20) // max(1, len(kept)))
    for i in range(0, len(asking), step):
        own = asking[i : i + step]
        a, b = np.nonzero(np.bitwise_count(prints[own][:, None] ^ prints[kept][None, :]) <= MAX_BITS)
        a, b = own[a], kept[b]
        while True:
            a_root, b_root = roots[a], roots[b]
            differ = a_root != b_root
            if not differ.any():
                break
            a, b, a_root, b_root = a[differ], b[differ], a_root[differ], b_root[differ]
            np.minimum.at(roots, np.maximum(a_root, b_root), np.minimum(a_root, b_root))
            while (roots[roots] != roots).any():
                roots = roots[roots]
    return roots


def shard_edges(prints: np.ndarray, asks: np.ndarray, held: np.ndarray, half: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges between positions of a shard that connect whatever its links connect.

    A large shard gets a tree of its own, so that its work doesn't grow with the square of its size.
    """
    n = int(held.sum())
    if n <= LOCAL_SHARD:
        roots = forest(prints, asks, held)
        linked = np.flatnonzero(roots != np.arange(len(roots)))
        yield linked, roots[linked]
        return
    tree = Tree(_half(prints[held], half), (n // SHARD).bit_length())
    place, leaf, home = tree.visits(_half(prints, half), held)
    order = np.lexsort((place, leaf))  # positions stay in order within a leaf
    place, leaf, home = place[order], leaf[order], home[order]
    cuts = np.flatnonzero(np.diff(leaf, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = place[a:b]
        roots = forest(prints[own], asks[own], home[a:b])
        linked = np.flatnonzero(roots != np.arange(len(roots)))
        yield own[linked], own[roots[linked]]


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of prints (_node, _print; each once) that connect whatever links connect."""
    spark = prints.sparkSession
    n = prints.count()
    depth = max(0, min((n // SHARD).bit_length(), (TREE_SAMPLE // 8).bit_length() - 1))
    sample = prints.select("_print").orderBy(F.xxhash64("_print"), "_print").limit(min(TREE_SAMPLE, 8 << depth)).toPandas()["_print"].to_numpy(np.int64).view(np.uint64)
    trees = spark.sparkContext.broadcast([Tree(_half(sample, half), depth) for half in range(_HALVES)])

    def visits(rows: pa.RecordBatch) -> Iterator[tuple]:
        values = rows.column(1).to_numpy().view(np.uint64)
        for half, tree in enumerate(trees.value):
            place, leaf, home = tree.visits(_half(values, half), np.ones(len(values), bool))
            yield place, leaf + (half << depth), home

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_HALVES << depth, np.int64)
        for rows in batches:
            for _, leaf, _ in visits(rows):
                total += np.bincount(leaf, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], ["leaf", "n"])

    # at most 2 * TREE_SAMPLE / 8 shards, so their sizes are bounded; only the large ones come to the driver
    large = prints.mapInArrow(sizes, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).filter(F.col("n") > SPLIT_SHARD).toPandas()
    is_large = np.zeros(_HALVES << depth, bool)
    is_large[large["leaf"].to_numpy(np.int64)] = True
    chosen = spark.sparkContext.broadcast(is_large)

    def deal(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                for place, leaf, home in visits(rows):
                    own = np.flatnonzero(chosen.value[leaf] == wanted)
                    at = pa.array(place[own])
                    yield pa.record_batch([pa.array(leaf[own]), pa.array(np.zeros(len(own), np.int64)), rows.column(0).take(at), rows.column(1).take(at), pa.array(home[own])], ["leaf", "part", "node", "print", "held"])

        return prints.mapInArrow(run, "leaf long, part long, node long, print long, held boolean")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in groups(batches):
            node = shard.column(2).to_numpy()
            order = np.argsort(node, kind="stable")
            held = shard.column(4).to_numpy(zero_copy_only=False)[order]
            node = node[order]
            for a, b in shard_edges(shard.column(3).to_numpy().view(np.uint64)[order], np.ones(len(node), bool), held, shard.column(0)[0].as_py() >> depth):
                if len(a):
                    yield pa.record_batch([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    dealt = deal(False)
    if len(large):
        dealt = dealt.unionByName(divided(deal(True), spark.createDataFrame(large).select("leaf", "n"), depth))
    return dealt.repartition("leaf", "part").sortWithinPartitions("leaf", "part").mapInArrow(joined, "a long, b long")


def divided(rows: DataFrame, sizes: DataFrame, depth: int) -> DataFrame:
    """rows (leaf, part, node, print, held) of large shards with part, the shard of the leaf's own tree; sizes: (leaf, n), a row for each.

    A tree is fitted on about 8 fingerprints for each of its shards and goes, a few KB, to
    every salt of its leaf's rows, which are as many as it takes for SPLIT_SHARD rows each.
    """
    known = F.broadcast(sizes)  # as many as the first trees have leaves at most
    most = TREE_SAMPLE // 8
    shards = F.least(F.ceil(F.col("n") / SHARD), F.lit(most)).cast("long")
    kept = F.pmod(F.xxhash64("print"), F.greatest(F.floor(F.col("n") / (8 * shards)), F.lit(1)).cast("long")) == 0
    salts = F.ceil(F.col("n") / SPLIT_SHARD).cast("long")
    rows = checkpoint(rows).join(known, "leaf")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sample in groups(batches):
            leaf, count = sample.column(0)[0].as_py(), sample.column(1)[0].as_py()
            values = np.sort(sample.column(2).to_numpy()).view(np.uint64)
            tree = Tree(_half(values, leaf >> depth), max(1, min((count // SHARD).bit_length(), (len(values) // 8).bit_length())))
            yield pa.record_batch([pa.array([leaf]), pa.array([count]), pa.array([tree.points.tobytes()], pa.binary()), pa.array([tree.radii.tobytes()], pa.binary())], ["leaf", "n", "points", "radii"])

    sample = rows.filter(F.col("held") & kept).select("leaf", "n", "print").repartition("leaf").sortWithinPartitions("leaf", "n")
    trees = sample.mapInArrow(fit, "leaf long, n long, points binary, radii binary")
    to_all = trees.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("print"), F.lit(False).alias("held"), "points", "radii")
    none = F.lit(None).cast("binary")
    salted = rows.select("leaf", F.pmod(F.xxhash64("node"), salts).alias("salt"), F.lit(1).alias("kind"), "node", "print", "held", none.alias("points"), none.alias("radii"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf, salt, kind = (batch.column(i).to_numpy() for i in range(3))
            cuts = [0, *(np.flatnonzero((np.diff(leaf) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if (leaf[a], salt[a]) != key:
                    key, tree = (leaf[a], salt[a]), None
                if not kind[a]:
                    tree = Tree.of(np.frombuffer(batch.column(6)[a].as_py(), np.uint32), np.frombuffer(batch.column(7)[a].as_py(), np.int16))
                    continue
                own = batch.slice(a, b - a)
                held = own.column(5).to_numpy(zero_copy_only=False)
                place, part, home = tree.visits(_half(own.column(4).to_numpy().view(np.uint64), int(leaf[a]) >> depth), held)
                at = pa.array(place)
                yield pa.record_batch([own.column(0).take(at), pa.array(part), own.column(3).take(at), own.column(4).take(at), pa.array(home)], ["leaf", "part", "node", "print", "held"])

    both = to_all.unionByName(salted).repartition("leaf", "salt").sortWithinPartitions("leaf", "salt", "kind")
    return both.mapInArrow(run, "leaf long, part long, node long, print long, held boolean")


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (first, second column), of batches sorted by them."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        first, second = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(first) != 0) | (np.diff(second) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            own = first[a], second[a]
            if held and own != key:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id) of every row of df; ids are of an integer type.

    component_id: the smallest id reachable over fingerprints with MAX_BITS or fewer
    differing bits, exact copies included; rows of one id are one document, whose
    fingerprints are linked. Texts that are null or have no words have
    the fingerprint zero and link like others. Repeated ids and rows stay. A null id is
    no node: its row has the component of the documents with ids that share its very
    fingerprint, or null. Other columns are not read; an empty df gives no rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    prints = checkpoint(fingerprints(df, id_col=id_col, text_col=text_col).withColumn("_id", F.col("_id").cast("long")))
    nodes = checkpoint(prints.filter(F.col("_id").isNotNull()).groupBy("_print").agg(F.min("_id").alias("_node")).select("_node", "_print"))
    # an id may stand for several fingerprints if ids repeat: they are one document, and so linked, each with the least
    several = prints.filter(F.col("_id").isNotNull()).groupBy("_id").agg(F.min("_print").alias("_least"), F.max("_print").alias("_most")).filter("_least <> _most").select("_id", "_least")
    pairs = prints.join(several, "_id").filter("_print <> _least").select("_print", "_least").distinct()
    least = nodes.select(F.col("_print").alias("_least"), F.col("_node").alias("b"))
    shared = pairs.join(nodes, "_print").join(least, "_least").select(F.col("_node").alias("a"), "b").filter("a <> b")
    found = checkpoint(connected_components(links(nodes).unionByName(shared)))
    labels = nodes.join(found.withColumnRenamed("node", "_node"), "_node", "left").select("_print", F.coalesce("component", "_node").alias("_component"))
    shown = F.lpad(F.lower(F.hex("_print")), 16, "0")
    return prints.join(labels, "_print", "left").select(F.col("_id").cast(kind).alias(id_col), shown.alias("fingerprint"), F.col("_component").cast(kind).alias("component_id"))
