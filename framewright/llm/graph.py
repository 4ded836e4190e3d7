"""Groups of linked rows: connected components on DataFrames, and streams of key groups in a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import drop_table, table


#: Edges that one task may hold: 16 MB as they come, some ten times that while they are joined.
ONE_TASK = 1 << 20


def _at_once(batches):
    got = [np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]) for b in batches if b.num_rows]
    if got:
        node, place = np.unique(np.concatenate(got, 1), return_inverse=True)
        root = node[roots(len(node), *place.reshape(2, -1))]
        some = root != node
        yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(root[some])], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that edges (a, b) of longs reach from each node of an edge.

    Large-star and small-star rounds until nothing changes; every round is a table in the shared folder.
    Nodes without an edge to another node have no row. A hub's edges meet its minimum in a join that
    Spark can split, never in one row. Up to ONE_TASK different edges, 16 bytes each, are joined in one task at once.
    """
    now = table(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    if now.count() <= ONE_TASK:
        return now.coalesce(1).mapInArrow(_at_once, "node long, root long")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a table of its own: Spark splits a hot key of a join only if both sides are plain shuffles
        least = table(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        after = table(small)
        drop_table(now, least)
        now = after


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least reachable row of each of n rows, over links a-b; minima spread along links and paths are halved."""
    r = np.arange(n)
    if len(a):
        while True:
            low = np.minimum(r[a], r[b])
            new = r.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            np.minimum.at(new, r[a], low)
            np.minimum.at(new, r[b], low)
            new = new[new]
            if np.array_equal(new, r):
                break
            r = new
    return r


def runs(batches, key: int):
    """Batches of whole groups: rows arrive sorted by column `key`; a group is never cut between two batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(k[1:] != k[:-1])
        if held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != k[0]:
            yield _one(held)
            held = []
        if len(cut):
            held.append(b.slice(0, cut[-1] + 1))
            yield _one(held)
            held = [b.slice(cut[-1] + 1)]
        else:
            held.append(b)
    if held:
        yield _one(held)


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
