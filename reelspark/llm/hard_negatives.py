"""Hard negatives, mined exactly with ball trees.

Rows are dealt out into chunks of bounded size; a chunk is one ball tree. A node's centre
and radius bound the inner product of an anchor with all of its rows from above and
from below (Cauchy-Schwarz), so a node is passed over if its upper bound is under the
score window or strictly under the current k-th score (or equal to it, while all its
ids are larger), if its lower bound is over the window, or if its only label is the
wrong one. Anchors visit the chunks in blocks: first for their best positives, which
are merged over chunks, then for negatives in the window that each positive's score
opens. Scores are integers, and bounds are rounded outwards, so results are exact.

Anchors by rows is the work that the question asks for; trees spare what the bounds
allow, which is much for clustered vectors and little for random ones. An anchor is
sent to every chunk, so the shuffle grows with anchors times chunks, and a chunk is
made as large as CHUNK_BYTES allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.llm.common import checkpoint, released

SCALE = 256
#: Bytes of a chunk's vectors in a task, and the rows under which it isn't worth to divide them further.
CHUNK_BYTES = 1 << 26
LEAST_ROWS = 1 << 12
LEAF = 256
#: Anchors that visit a tree at a time.
BLOCK = 1024
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class BallTree:
    """Balanced ball tree over integer vectors; rows of a node are kept by id, so that a first maximum has the smallest."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.nodes: list[tuple] = []  # (centre, radius, least id, only label or None, children or None, rows)
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.norm = float(np.sqrt((self.vectors**2).sum(axis=1)).max(initial=0))
        if len(ids):
            self._add(np.arange(len(ids)))

    def _add(self, rows: np.ndarray) -> int:
        own = self.vectors[rows]
        centre = own.mean(axis=0)
        away = ((own - centre) ** 2).sum(axis=1)
        labels = self.labels[rows]
        place = len(self.nodes)
        self.nodes.append(())
        children = None
        if len(rows) > LEAF and away.max() > 0:
            one = own[np.argmax(away)]
            other = own[np.argmax(((own - one) ** 2).sum(axis=1))]
            along = own @ (one - other)
            near = np.zeros(len(rows), bool)
            near[np.argsort(along, kind="stable")[: len(rows) // 2]] = True
            children = self._add(rows[near]), self._add(rows[~near])
        elif len(rows) > LEAF:  # copies of one vector: halves by id, so that the larger ids can be passed over
            half = len(rows) // 2
            children = self._add(rows[:half]), self._add(rows[half:])
        self.nodes[place] = centre, float(np.sqrt(away.max())), int(self.ids[rows[0]]), int(labels[0]) if (labels == labels[0]).all() else None, children, None if children else rows
        return place

    def search(self, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), each anchors x windows x k, best first: the k best rows of the anchor's label (else of other ones) with low <= score <= high.

        Equal scores go by id; places without a row have the lowest integer as score. Rows of the anchor's own id don't count if same.
        """
        n, windows = low.shape
        self.best, self.best_id = np.full((n, windows, k), _LOW), np.full((n, windows, k), _HIGH)
        self.q, self.q_norm, self.q_id, self.q_label, self.low, self.high, self.same = anchors, np.sqrt((anchors**2).sum(axis=1)), ids, labels, low, high, same
        most = self.norm * float(self.q_norm.max(initial=0))
        if most >= 2.0**55:
            raise ValueError("inner products of these vectors are too large for exact windows")
        self.exact = most < 2.0**52
        if self.nodes:
            self._visit(0, np.arange(n))
        return self.best, self.best_id

    def _visit(self, node: int, asking: np.ndarray) -> None:
        centre, radius, least, only, children, rows = self.nodes[node]
        if only is not None:
            asking = asking[(self.q_label[asking] == only) == self.same]
        middle, reach = self.q[asking] @ centre, self.q_norm[asking] * radius
        reach += 1e-6 + 1e-9 * (reach + self.q_norm[asking] * self.norm)
        upper, lower = np.floor(middle + reach)[:, None], np.ceil(middle - reach)[:, None]
        kth, kth_id = self.best[asking, :, -1], self.best_id[asking, :, -1]
        open_ = (upper >= self.low[asking]) & (lower <= self.high[asking]) & ((upper > kth) | ((upper == kth) & (least < kth_id)))
        asking = asking[open_.any(axis=1)]
        if not len(asking):
            return
        if children:
            a, b = children
            if (self.q[asking] @ (self.nodes[b][0] - self.nodes[a][0])).sum() > 0:
                a, b = b, a
            self._visit(a, asking)
            self._visit(b, asking)
        else:
            self._compare(rows, asking)

    def _compare(self, rows: np.ndarray, asking: np.ndarray) -> None:
        if self.exact:
            scores = (self.q[asking] @ self.vectors[rows].T).astype(np.int64)
        else:
            scores = self.q[asking].astype(np.int64) @ self.vectors[rows].astype(np.int64).T
        ids = self.ids[rows]
        fits = (self.labels[rows][None, :] == self.q_label[asking][:, None]) == self.same
        if self.same:
            fits &= ids[None, :] != self.q_id[asking][:, None]
        k = self.best.shape[2]
        for w in range(self.best.shape[1]):
            floor = np.maximum(self.low[asking, w], self.best[asking, w, -1])
            hit = fits & (scores >= floor[:, None]) & (scores <= self.high[asking, w][:, None])
            some = np.flatnonzero(hit.any(axis=1))
            if not len(some):
                continue
            left, line = np.where(hit[some], scores[some], _LOW), np.arange(len(some))
            found, found_id = [self.best[asking[some], w]], [self.best_id[asking[some], w]]
            for _ in range(min(k, len(rows))):
                top = left.argmax(axis=1)
                value = left[line, top]
                found.append(value[:, None])
                found_id.append(np.where(value == _LOW, _HIGH, ids[top])[:, None])
                left[line, top] = _LOW
            value, name = np.concatenate(found, axis=1), np.concatenate(found_id, axis=1)
            order = np.lexsort((name, -np.maximum(value, _LOW + 1)), axis=-1)[:, :k]
            self.best[asking[some], w] = np.take_along_axis(value, order, axis=1)
            self.best_id[asking[some], w] = np.take_along_axis(name, order, axis=1)


def _vectors(column: pa.Array) -> np.ndarray:
    """Whole-numbered vectors of a list column; shorter ones are padded by zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    flat = np.floor(SCALE * pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _padded(parts: list[np.ndarray], width: int | None = None) -> np.ndarray:
    width = max(x.shape[1] for x in parts) if width is None else width
    return np.concatenate([np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in parts])


def _search(rows: DataFrame, asking: DataFrame, chunks: int, k: int, same: bool) -> DataFrame:
    """(id, print, w, found_id, score): for each window of each anchor, the best k of every chunk.

    rows (chunk, id, label, vector); asking (id, print, label, vector, low, high), low
    and high arrays with an element for each window.
    """
    nowhere = F.lit(None).cast("array<long>")
    held = rows.select("chunk", F.lit(0).alias("asks"), "id", F.lit(0).cast("long").alias("print"), "label", "vector", nowhere.alias("low"), nowhere.alias("high"))
    visits = asking.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("asks"), "id", "print", "label", "vector", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, tree = None, None
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk_of, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(chunk_of) != 0) | (np.diff(asks) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if chunk_of[a] != chunk:
                    chunk, tree, parts = chunk_of[a], None, []
                own = batch.slice(a, b - a)
                if not asks[a]:
                    parts.append(own)
                    continue
                if tree is None and parts:
                    tree = BallTree(*(np.concatenate([p.column(i).to_numpy() for p in parts]) for i in (2, 4)), _padded([_vectors(p.column(5)) for p in parts]))
                    parts = []
                if tree is not None:
                    yield from asked(tree, own)

    def asked(tree: BallTree, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, BLOCK):
            own = rows.slice(at, BLOCK)
            q, width = _vectors(own.column(5)), tree.vectors.shape[1]
            q = q[:, :width] if q.shape[1] > width else _padded([q], width)
            ids, prints, labels = (own.column(i).to_numpy() for i in (2, 3, 4))
            count = pc.list_value_length(own.column(6)).to_numpy(zero_copy_only=False)
            low, high = np.ones((len(ids), int(count.max()))), np.zeros((len(ids), int(count.max())))  # windows that an anchor lacks are empty
            row = np.repeat(np.arange(len(ids)), count)
            place = row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            low, high = low.astype(np.int64), high.astype(np.int64)
            low[place], high[place] = (pc.list_flatten(own.column(i)).to_numpy() for i in (6, 7))
            scores, found = tree.search(q, ids, labels, low, high, k, same)
            i, w, j = np.nonzero(scores != _LOW)
            if len(i):
                yield pa.record_batch([pa.array(ids[i]), pa.array(prints[i]), pa.array(w.astype(np.int32)), pa.array(found[i, w, j]), pa.array(scores[i, w, j])], ["id", "print", "w", "found_id", "score"])

    both = held.unionByName(visits).repartitionById(chunks, F.col("chunk")).sortWithinPartitions("chunk", "asks")
    return both.mapInArrow(released(run), "id long, print long, w int, found_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best over all chunks; a window's rows are at most k for each chunk."""
    order = Window.partitionBy("id", "print", "w").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    df: DataFrame, *, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows that anchors picks.

    Components x become floor(256 * x); a score is the inner product of two rows. An
    anchor's positives are the best rows of its label and another id; its negatives for
    one of them are the best rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score; ties go by the smaller id.

    Rows without id, label or vector, or with a component that is null or not finite,
    take no part. Rows that repeat exactly count once; rows that share an id but differ
    are rows of their own, and anchors of their own. Shorter vectors are padded by
    zeros. An anchor without positives, a positive without negatives and an empty table
    give no rows; other columns are not read. Ids and labels are integers. Scores of
    2^55 or more in size raise an error.
    """
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    there = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & fine
    told = df.filter(there).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = checkpoint(told.distinct().withColumn("print", F.xxhash64("id", "label", "vector")))
    n, width, asking = rows.agg(F.count("*"), F.max(F.size("vector")), F.count_if("asks")).first()
    sizes = max(1, -(-(n or 0) * 8 * max(1, width or 1) // CHUNK_BYTES)), min(df.sparkSession.sparkContext.defaultParallelism, (n or 0) // LEAST_ROWS)
    chunks = max(sizes)
    dealt = rows.select(F.pmod("print", F.lit(chunks)).cast("int").alias("chunk"), "id", "label", "vector")
    asking = rows.filter("asks").select("id", "print", "label", "vector")
    everything = F.array(F.lit(-(1 << 62))), F.array(F.lit(1 << 62))
    near = _best(_search(dealt, asking.withColumns({"low": everything[0], "high": everything[1]}), chunks, positives, True), positives)
    listed = near.groupBy("id", "print").agg(F.array_sort(F.collect_list(F.struct("rank", "found_id", "score"))).alias("near"))  # positives at most
    known = checkpoint(listed)
    at_least = F.expr(f"transform(near, p -> -((-p.score * {low:d} - pmod(-p.score * {low:d}, 100)) div 100))")
    at_most = F.expr(f"transform(near, p -> (p.score * {high:d} - pmod(p.score * {high:d}, 100)) div 100)")
    opened = asking.join(known, ["id", "print"]).select("id", "print", "label", "vector", at_least.alias("low"), at_most.alias("high"))
    found = _best(_search(dealt, opened, chunks, negatives, False), negatives)
    positive = F.get("near", F.col("w"))
    return found.join(known, ["id", "print"]).select(
        F.col("id").alias("anchor_id"), positive["found_id"].alias("positive_id"), "rank", F.col("found_id").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score")
    )

