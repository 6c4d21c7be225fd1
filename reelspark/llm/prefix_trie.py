"""Conversation prefix trie, built level by level.

A node of depth d is a distinct sequence of the first d turns (role, text) that some
conversation starts with; conversations that start with it are its members, and the
smallest of them names it. Per depth, the live conversations are grouped by (parent
node, next turn), and the smallest id of a group is the node of all its members. Then
joins from the deepest level up sum leaves and savings over subtrees.

A group whose members are the very same sequence can't branch any more: it is closed, and
its remaining nodes, one for each further turn, come out of the turns of its smallest
member at once. So there are as many levels as differing conversations share turns,
however long a conversation or its copies are.

A turn is told by the SHA-256 of role and text, a whole sequence by two 64-bit hashes
over all its (depth, turn); texts are read once and never shuffled. Turns are numbered
in range partitions, so a conversation of any size is spread over tasks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import checkpoint, text_of
from reelspark.operators.lineage import discard, folder

#: Ids of members that a row of joined ids holds at most.
SEGMENT_IDS = 1 << 14
#: Turns that a conversation takes over from the first one of its family at most, and the size of a family.
TAKEN, FAMILY = 8, 5
_EMPTY = hashlib.sha256(b"").hexdigest()


def numbered_turns(df: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, before, key, bytes): turns from 0 on, with the UTF-8 bytes of the turns before them.

    Turns go by turn (null first); ties by role, then by the digest of the text, so
    repeated rows stay, one after the other. Null roles and texts are empty; rows
    without a conversation are left out.
    """
    told = df.select(df[id_col].cast("long").alias("conv"), df[turn_col].alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text")).filter("conv is not null")
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = told.select("conv", "turn", "role", F.unhex(F.sha2(said, 256)).alias("key"), F.octet_length("text").cast("long").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, size = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, length = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            starts = np.flatnonzero(np.diff(conv, prepend=conv[0]))
            starts = np.concatenate([[0], starts])
            runs = np.diff(np.append(starts, len(conv)))
            sums = np.cumsum(length) - length
            pos = np.arange(len(conv)) - np.repeat(starts, runs)
            before = sums - np.repeat(sums[starts], runs)
            if conv[0] == last:
                pos[: runs[0]] += count
                before[: runs[0]] += size
            last, count, size = conv[-1], int(pos[-1]) + 1, int(before[-1] + length[-1])
            yield pa.record_batch([pa.array(np.full(len(conv), part, np.int32)), batch.column(0), pa.array(pos), pa.array(before), batch.column(3), batch.column(4)], ["part", "conv", "pos", "before", "key", "bytes"])

    order = ("conv", "turn", "role", "key")
    parts = checkpoint(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "part int, conv long, pos long, before long, key binary, bytes long"))
    # what conversations that go on in a later partition have had before it: a row for each partition at most
    end = F.struct("conv", "pos")
    ends = parts.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"), F.max_by(F.struct((F.col("pos") + 1).alias("n"), (F.col("before") + F.col("bytes")).alias("size")), end).alias("had"))
    carried, last, n, size = [], None, 0, 0
    for r in sorted(ends.collect(), key=lambda r: r.part):
        if r.first != last:
            n = size = 0
        else:
            carried.append((r.part, r.first, n, size))
        n, size = (n + r.had.n, size + r.had.size) if r.first == r.last else (r.had.n, r.had.size)
        last = r.last
    if not carried:
        return parts.drop("part")
    more = df.sparkSession.createDataFrame(carried, "part int, conv long, more long, bytes_more long")
    held = parts.join(F.broadcast(more), ["part", "conv"], "left")
    return held.select("conv", (F.col("pos") + F.coalesce("more", F.lit(0))).alias("pos"), (F.col("before") + F.coalesce("bytes_more", F.lit(0))).alias("before"), "key", "bytes")


def _conversations(turns: DataFrame) -> DataFrame:
    """(conv, n, total, first): turns, bytes, and the bytes of the first 0 to TAKEN turns."""
    first = F.array(*[F.sum(F.when(F.col("pos") < k, F.col("bytes")).otherwise(0)) for k in range(TAKEN + 1)])
    return turns.groupBy("conv").agg(F.count("*").alias("n"), F.sum("bytes").alias("total"), first.alias("first"))


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, key, bytes, after) and (conv) of numbered turns as they are; after: bytes from a turn to the end."""
    convs = turns.groupBy("conv").agg(F.sum("bytes").alias("total"))
    rows = turns.join(convs, "conv").select("conv", (F.col("pos") + 1).alias("depth"), "key", "bytes", (F.col("total") - F.col("before")).alias("after"))
    return rows, convs.select("conv")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As plain(), with conversations that take turns over from the first one of their family.

    Conversation c gets the first h turns of c - c % FAMILY (all if fewer, none if
    absent), then its own after its first h; h = crc32(decimal c) % (TAKEN + 1). A
    remainder has the sign of its id.
    """
    convs = _conversations(turns)
    head = F.col("conv") - F.col("conv") % FAMILY
    givers = convs.select(F.col("conv").alias("head"), F.col("n").alias("given"), F.col("first").alias("given_bytes"))
    h = (F.crc32(F.col("conv").cast("string")) % (TAKEN + 1)).cast("int")
    told = convs.withColumns({"head": head, "h": h}).join(givers, "head", "left")
    taken = F.coalesce(F.get("given_bytes", F.col("h")), F.lit(0))
    known = checkpoint(told.select("conv", "h", F.least(F.coalesce("given", F.lit(0)), F.col("h").cast("long")).alias("taken"), "total", (taken + F.col("total") - F.get("first", F.col("h"))).alias("whole")))
    own = turns.select("conv", F.lit(False).alias("gift"), "pos", "before", "key", "bytes")
    family = F.filter(F.transform(F.sequence(F.lit(1 - FAMILY), F.lit(FAMILY - 1)), lambda x: F.col("conv") + x), lambda c: c - c % FAMILY == F.col("conv"))
    gifts = turns.filter((F.col("pos") < TAKEN) & (F.col("conv") % FAMILY == 0)).select(F.explode(family).alias("conv"), F.lit(True).alias("gift"), "pos", "before", "key", "bytes")
    depth = F.when(F.col("gift"), F.col("pos")).otherwise(F.col("taken") + F.col("pos") - F.col("h")) + 1
    after = F.when(F.col("gift"), F.col("whole")).otherwise(F.col("total")) - F.col("before")
    rows = own.unionByName(gifts).join(known, "conv").filter(F.col("gift") == (F.col("pos") < F.col("h")))
    return rows.select("conv", depth.alias("depth"), "key", "bytes", after.alias("after")), known.select("conv")


def _joined_ids(ends: DataFrame) -> DataFrame:
    """(node, depth, sha256) of the ids of ends (node, depth, conv), ascending, joined by commas.

    Ids are joined to segments in range partitions; a digest has to be made in one task,
    which streams over the segments.
    """

    def runs(a: np.ndarray, b: np.ndarray) -> list[int]:
        return [0, *(np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1).tolist(), len(a)]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, depth, conv = (c.to_numpy() for c in batch.columns)
            cuts = runs(node, depth)
            rows = [(int(node[i]), int(depth[i]), int(conv[i]), ",".join(map(str, conv[i : min(i + SEGMENT_IDS, b)].tolist()))) for a, b in zip(cuts, cuts[1:]) for i in range(a, b, SEGMENT_IDS)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["node", "depth", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            rows: list[tuple] = []
            for node, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (node, depth) == key:
                    digest.update(b",")
                else:
                    if key:
                        rows.append((*key, digest.hexdigest()))
                    key, digest = (node, depth), hashlib.sha256()
                digest.update(ids.encode())
            if rows:
                yield out(rows)
        if key:
            yield out([(*key, digest.hexdigest())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c) for c in zip(*rows)], ["node", "depth", "sha256"])

    order = ("node", "depth", "conv")
    segments = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "node long, depth long, first long, ids string")
    return segments.repartition("node", "depth").sortWithinPartitions("node", "depth", "first").mapInArrow(hashed, "node long, depth long, sha256 string")


def _levels(turns: DataFrame, convs: DataFrame) -> list[DataFrame]:
    """For each depth, (conv, parent, node, n, closed, bytes, after, length) of the conversations that were live there."""
    live = convs.withColumnRenamed("root", "parent")
    levels: list[DataFrame] = []
    while True:
        depth = len(levels) + 1
        here = turns.filter(F.col("depth") == depth).drop("depth").join(live, "conv")
        same = (F.min("one") == F.max("one")) & (F.min("two") == F.max("two"))
        groups = here.groupBy("parent", "key").agg(F.min("conv").alias("node"), F.count("*").alias("n"), same.alias("closed"))
        # with a key that the sums aren't dealt by, either side has an exchange of its own, whose large partitions the engine can split
        apart = F.xxhash64("parent", "key")
        found = checkpoint(here.withColumn("apart", apart).join(groups.withColumn("apart", apart), ["parent", "key", "apart"]).select("conv", "parent", "node", "n", "closed", "bytes", "after", "length", "one", "two"))
        levels.append(found)
        live = found.filter(~F.col("closed") & (F.col("length") > depth)).select("conv", F.col("node").alias("parent"), "length", "one", "two")
        if live.isEmpty():
            return levels


@contextmanager
def prefix_trie(turns: DataFrame, convs: DataFrame) -> Iterator[DataFrame]:
    """The nodes of the trie of turns (conv, depth from 1, key, bytes, after); convs (conv) also names those without turns.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256), as the module's text has it: n_children, child nodes; n_leaves,
    childless nodes of the subtree, top included; saved_tokens, summed over the subtree,
    (n_convs - 1) times the bytes of a node's last text; ends_sha256, of the ids of
    members with no further turn. No conversations give no nodes, conversations without
    turns the root alone. Turns are kept in a table while the context is open.
    """
    spark = turns.sparkSession
    path = f"{folder(spark)}/trie-{uuid.uuid4().hex}"
    try:
        turns.sortWithinPartitions("depth").write.parquet(path)  # a level reads the pages of its depth
        turns = spark.read.schema(turns.schema).parquet(path)
        whole = turns.groupBy("conv").agg(F.count("*").alias("length"), F.bit_xor(F.xxhash64("depth", "key")).alias("one"), F.bit_xor(F.xxhash64(F.lit(42), "key", "depth")).alias("two"))
        top = convs.agg(F.min("conv").alias("root"), F.count("*").alias("n"))
        root, n = top.first()
        known = checkpoint(convs.join(whole, "conv", "left").select("conv", F.lit(root).cast("long").alias("root"), F.coalesce("length", F.lit(0)).alias("length"), "one", "two"))
        levels = _levels(turns, known.filter("length > 0"))
        ends = [known.filter("length = 0").select("conv", F.col("root").alias("node"), F.lit(0).cast("long").alias("depth"))]
        shared, alone = [], []
        children = None
        for depth in range(len(levels), 0, -1):
            found = levels[depth - 1]
            tops = found.filter("conv = node").select("node", "parent", "n", "closed", "bytes", "after", "length")
            closed = tops.filter("closed").select("node", "parent", F.lit(depth).cast("long").alias("from"), "n", "length", "after")
            alone.append(closed)
            ends.append(found.filter(F.col("closed") & (F.col("n") > 1)).select("conv", "node", F.col("length").alias("depth")))
            ends.append(found.filter(~F.col("closed") & (F.col("length") == depth)).select("conv", "node", F.lit(depth).cast("long").alias("depth")))
            rolled = _rolled(tops.filter("not closed").select("node", "parent", "n", "bytes"), children)
            shared.append(checkpoint(rolled.withColumn("depth", F.lit(depth).cast("long"))))
            children = shared[-1].select("parent", "n_leaves", "saved").unionByName(closed.select("parent", F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.col("after")).alias("saved")))
        top = spark.createDataFrame([(root, None, n, 0)] if n else [], "node long, parent long, n long, bytes long")
        shared.append(_rolled(top, children).withColumn("depth", F.lit(0).cast("long")))
        union = lambda frames: reduce(DataFrame.unionByName, frames)
        chains = turns.join(union(alone).drop("after").withColumnRenamed("node", "conv"), "conv").filter(F.col("depth") >= F.col("from"))
        last = F.col("depth") == F.col("length")
        chained = chains.select(
            F.col("conv").alias("node"), F.when(F.col("depth") == F.col("from"), F.col("parent")).otherwise(F.col("conv")).alias("parent"), "n", (~last).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.col("after")).alias("saved"), "depth", last.alias("last"),
        )
        own = chained.filter("n = 1").withColumn("sha256", F.when(F.col("last"), F.sha2(F.col("node").cast("string"), 256)))
        digests = _joined_ids(union(ends))
        rest = union([*shared, chained.filter("n > 1").drop("last")]).join(digests, ["node", "depth"], "left")
        yield own.drop("last").unionByName(rest).select(
            F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
            F.coalesce("sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    finally:
        discard(spark, path)


def _rolled(nodes: DataFrame, children: DataFrame | None) -> DataFrame:
    """(node, parent, n, n_children, n_leaves, saved) of the nodes of one level, out of what their children have."""
    own = (F.col("n") - 1) * F.col("bytes")
    if children is None:
        return nodes.select("node", "parent", "n", F.lit(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), own.alias("saved"))
    sums = children.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
    return nodes.join(sums, "node", "left").select("node", "parent", "n", F.coalesce("c", F.lit(0)).alias("n_children"), F.coalesce("l", F.lit(1)).alias("n_leaves"), (own + F.coalesce("s", F.lit(0))).alias("saved"))
