"""Clips over many runs: an index of what has been seen, that each new batch joins.

The index is a folder of bucketed tables which only grow: ids, signatures with their
bands, links and rows. A batch drops clips whose stable id has been seen, meets the index
by the bands of its new signatures, and appends what is new; the index itself is never
written anew, nor shuffled but for rows of crowded keys. Winners come out of all rows, so
that a later clip of better quality takes the place of an earlier one, as if all batches
had been one.

A batch counts once its commit is there; what a failed attempt has appended belongs to no
commit and is passed over. The folder may be on any file system, and is opened again by
its path in another session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.perceptual import FRAMES, distance
from reelspark.operators.components import connected_components
from reelspark.operators.lineage import checkpoint
from reelspark.operators.near_duplicates import PLAIN, around, banding, in_bands, in_pieces, links, links_to, pieces, winners

#: Tables: their columns, and those that they are bucketed by.
TABLES = {
    "ids": ("clip_id string, attempt string", "clip_id"),
    "nodes": ("key bigint, sig array<bigint>, node bigint, attempt string", "key"),
    "bands": ("band int, value bigint, node bigint, sig array<bigint>, attempt string", "band, value"),
    "links": ("a bigint, b bigint, attempt string", "a"),
    "clips": ("ord bigint, clip_id string, node bigint, quality double, attempt string", "node"),
}


class SeenClips:
    """The index in a folder. expected_rows, threshold and n (hashes of a signature) hold for its whole life, as buckets does."""

    def __init__(self, spark: SparkSession, path: str, *, expected_rows: float = 1e6, threshold: float = 8.0, n: int = FRAMES, buckets: int = 16):
        self.spark, self.path, self.n, self.most_bits, self.buckets = spark, path.rstrip("/"), n, int(threshold * n), buckets
        self.pieces = pieces([(1 << 64) - 1] * n, self.most_bits) if expected_rows <= PLAIN else []
        if not self.pieces:
            self.bands, far, near = banding(expected_rows, 64 * n, self.most_bits)
            self.reach = far + near  # the index holds values as they are, a batch looks up all that are near its own
        self.names = {t: f"seen_{t}_{uuid.uuid4().hex}" for t in TABLES}
        for table, (columns, by) in TABLES.items():
            spark.sql(f"CREATE TABLE {self.names[table]} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.path}/{table}'")

    def close(self) -> None:
        """Forgets the tables' names; the folder stays."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _file(self, name: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/{name}")
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def commits(self) -> dict[str, str]:
        """The attempt that counts of each batch."""
        where, store = self._file("")
        if not store.exists(where):
            return {}
        return dict(x.getPath().getName().rsplit("=", 1) for x in store.listStatus(where) if "=" in x.getPath().getName())

    def table(self, name: str) -> DataFrame:
        """Rows of committed attempts, one for each batch."""
        return self.spark.table(self.names[name]).filter(F.col("attempt").isin(*self.commits().values())).drop("attempt")

    def add(self, clips: DataFrame, batch: str) -> bool:
        """Adds clips (ord, clip_id, sig, quality) as the batch of that name (letters, digits, - and _); False if it's there already.

        ord is unique over all batches. Of clips with one id the first batch's count, in a
        batch the one of the smallest ord. Null qualities are the lowest.
        """
        if batch in self.commits():
            return False
        attempt = uuid.uuid4().hex
        first = clips.groupBy("clip_id").agg(F.min(F.struct("ord", "sig", "quality")).alias("c")).select("clip_id", "c.*")
        fresh = checkpoint(first.join(self.table("ids"), "clip_id", "left_anti").withColumn("key", F.xxhash64("sig")))
        sigs = fresh.groupBy("key", "sig").agg(F.min("ord").alias("own"))
        held = self.table("nodes").withColumnRenamed("sig", "_sig")
        met = sigs.join(held, (sigs["key"] == held["key"]) & (sigs["sig"] == held["_sig"]), "left").select(sigs["key"], "sig", "own", "node")
        met = checkpoint(met)
        new = met.filter("node is null").select("key", "sig", F.col("own").alias("ord"))
        own = in_pieces(new, self.pieces, "ord", "sig") if self.pieces else in_bands(new, self.n, self.bands, "sig")
        found = links(checkpoint(new.select("ord", "sig")), self.most_bits, self.n)
        if self.commits():
            near = self._met(own)
            # of a crowd that is linked already, one link is enough
            groups = connected_components(self.table("links"))
            for end in ("a", "b"):
                near = near.join(groups.select(F.col("node").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
            found = found.unionByName(near.filter("a <> b").select("a", "b").distinct())
        rows = fresh.join(met.select("key", F.col("sig").alias("_sig"), F.coalesce("node", "own").alias("node")).withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & (F.col("sig") == F.col("_sig")))
        for table, df in (
            ("ids", fresh.select("clip_id")), ("nodes", new.select("key", "sig", F.col("ord").alias("node"))), ("bands", own.select("band", "value", F.col("ord").alias("node"), "sig")),
            ("links", found.select("a", "b")), ("clips", rows.select("ord", "clip_id", "node", F.col("quality").cast("double").alias("quality"))),
        ):
            # else each task writes a file for each bucket; bands are many rows a signature, and are not shuffled for that
            df = df.coalesce(self.buckets) if table == "bands" else df.repartition(self.buckets, *TABLES[table][1].split(", "))
            df.withColumn("attempt", F.lit(attempt)).write.mode("append").insertInto(self.names[table])
        where, store = self._file(f"{batch}={attempt}")
        store.create(where, False).close()
        return True

    def _met(self, own: DataFrame) -> DataFrame:
        """Links (a, b) that connect new nodes with the held ones near them, from rows of the new nodes' bands."""
        if self.pieces:
            return links_to(own, self.table("bands"), self.most_bits, self.n)
        is_near = distance(F.col("_a"), F.col("sig"), self.n) <= self.most_bits
        probes = around(own, self.n, self.bands, self.reach).select("band", "value", F.col("ord").alias("a"), F.col("sig").alias("_a"))
        return probes.join(self.table("bands"), ["band", "value"]).filter(is_near).select("a", F.col("node").alias("b"))

    def winners(self) -> DataFrame:
        """(ord, cluster, keep) of all clips that count, as of one batch with all of them."""
        clips, groups = self.table("clips"), connected_components(self.table("links"))
        grouped = clips.join(groups, "node", "left").select("ord", "quality", F.coalesce("component", "node").alias("_group"))
        least = grouped.groupBy("_group").agg(F.min("ord").alias("cluster"))
        return winners(checkpoint(grouped.join(least, "_group").select("ord", "cluster", "quality")))
