"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells.

The plane halfway between the centres of two cells parts their vectors. Two linked unit vectors are at most
sqrt(2 - 2 cos) apart, so if they lie in two cells, one of them is within half of that of the plane between the
cells. A vector is compared in its own cell and, as a visitor, in each cell whose plane is so near; no link is
lost, and a pair that meets in both cells counts in one. Equal vectors are one row with a count.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, roots, runs
from .util import parts, scratch, table

THRESHOLD = 0.93
#: Rows of a label for each cell aimed at; cells in all; rows and bytes that k-means is fitted on; rows of a block.
CELL_ROWS, CELLS, SAMPLE, SAMPLE_BYTES, BLOCK, ROUNDS, SEED = 1000, 4096, 40_000, 32 << 20, 2048, 8, 11

_UNIT = "uid long, vec_id long, label long, dim int, copy binary, unit binary"


def _units(batches):
    """Unit vectors in double precision with an address of (label, direction); other rows are left out."""
    for b in batches:
        rows = []
        for uid, vec, label, v in zip(*(b.column(k).to_pylist() for k in range(4))):
            if label is None or v is None or not len(v) or any(x is None for x in v):
                continue
            x = np.array(v, np.float64)
            top = np.abs(x).max()
            if not np.isfinite(top) or not top or np.isnan(x).any():
                continue
            x = x / top
            unit = (x / math.sqrt(float(x @ x)) + 0.0).tobytes()
            rows.append((uid, vec, label, len(v), hashlib.blake2b(unit + label.to_bytes(8, "little", signed=True), digest_size=16).digest(), unit))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["uid", "vec_id", "label", "dim", "copy", "unit"])


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of k cells of unit rows by cosine; an empty cell takes the row farthest from its centre."""
    centres = x[np.random.default_rng(SEED).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        dots = x @ centres.T
        cell = dots.argmax(1)
        far = np.argsort(dots[np.arange(len(x)), cell])
        for c, spare in zip(np.flatnonzero(np.bincount(cell, minlength=k) == 0), far):
            cell[spare] = c
        total = np.zeros_like(centres)
        np.add.at(total, cell, x)
        norm = np.sqrt((total**2).sum(1, keepdims=True))
        centres = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), centres)
    return centres


def visits(dots: np.ndarray, centres: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Of vectors given by their products with the centres: the cell of each, and which other cells it visits."""
    home = dots.argmax(1)
    square = (centres**2).sum(1)
    apart = np.sqrt(np.maximum(square[:, None] + square - 2 * centres @ centres.T, 0))
    near = dots[np.arange(len(dots)), home][:, None] - dots <= apart[home] * (math.sqrt(2 - 2 * threshold) / 2) + 1e-6
    near[np.arange(len(dots)), home] = False
    return home, near


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding, label).

    Rows of equal label and length are linked at a cosine of `threshold` or more. Null labels, null, empty
    or zero vectors and those with null or non-finite parts have no links and are their own component.
    Repeated vec_ids are rows of their own. A null vec_id stays null, and kept with it. An empty table
    gives no row.
    """
    with scratch() as kept:
        out = table(_near_duplicates(vectors, threshold))
        kept.append(out)
    return out


def _near_duplicates(vectors: DataFrame, threshold: float) -> DataFrame:
    spark = vectors.sparkSession
    rows = table(vectors.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")))
    units = table(rows.select("uid", "vec_id", "label", "embedding").mapInArrow(_units, _UNIT), compression="none")
    one = units.groupBy("copy").agg(F.min("uid").alias("uid"), F.count("*").alias("n"), F.min("vec_id").alias("low"))
    single = table(units.select("uid", "label", "dim", "unit").join(one.select("uid", "n"), "uid"), compression="none")

    sizes = single.groupBy("label", "dim").count().where(F.col("count") > CELL_ROWS).orderBy(F.desc("count"), "label", "dim").limit(CELLS).collect()
    total = sum(r["count"] for r in sizes)
    cells = {(r["label"], r["dim"]): min(-(-r["count"] // CELL_ROWS), max(1, CELLS * r["count"] // total)) for r in sizes}
    centres: dict[tuple, np.ndarray] = {}
    if any(k > 1 for k in cells.values()):
        sample: dict[tuple, list] = {}
        most = min(SAMPLE, max(SAMPLE_BYTES // (8 * max(r["dim"] for r in sizes)), 1))
        for r in single.where(F.col("dim") <= max(r["dim"] for r in sizes)).withColumn("at", F.xxhash64("uid")).orderBy("at", "uid").limit(most).collect():
            sample.setdefault((r["label"], r["dim"]), []).append(np.frombuffer(r["unit"]))
        for key, k in cells.items():
            if k > 1 and len(sample.get(key, ())) >= k:
                centres[key] = k_means(np.stack(sample[key]), k)
    number, begin = 0, {}
    for key, c in centres.items():
        begin[key], number = number, number + len(c)

    def place(batches):
        """A row for the own cell, with the cells visited, and one for each of these. Cell -1: groups that are one cell."""
        for b in batches:
            n = b.num_rows
            home, to = np.full(n, -1), [b""] * n
            take, cell = [np.arange(n)], []
            for key, at in _by_key(b):
                if key in centres:
                    h, near = visits(_stack(b, at) @ centres[key].T, centres[key], threshold)
                    home[at] = h + begin[key]
                    i, c = np.nonzero(near)
                    take.append(at[i])
                    cell.append(c + begin[key])
                    for k, x in zip(at, np.split((c + begin[key]).astype(np.int32), np.cumsum(np.bincount(i, minlength=len(at)))[:-1])):
                        to[k] = x.tobytes()
            i = np.concatenate(take)
            own = np.arange(len(i)) < n
            to = pa.array([to[k] if o else None for k, o in zip(i, own)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(i)) for k in range(5)), pa.array(np.concatenate([home, *cell])), pa.array(own), pa.array(home[i]), to], [*b.schema.names[:5], "cell", "own", "home", "to"])

    placed = table(single.select("label", "dim", "uid", "n", "unit").mapInArrow(place, "label long, dim int, uid long, n long, unit binary, cell long, own boolean, home long, to binary"), compression="none")
    # Blocks of a cell: its own rows in `h` parts, visitors in `v`. Pairs of parts are compared one by one.
    by = ["label", "dim", "cell"]
    many = placed.groupBy(*by).agg(F.ceil(F.sum(F.col("own").cast("long")) / BLOCK).alias("h"), F.ceil(F.sum((~F.col("own")).cast("long")) / BLOCK).alias("v"))
    part = placed.join(table(many), by).withColumn("at", F.pmod(F.xxhash64("uid"), F.when(F.col("own"), F.col("h")).otherwise(F.col("v"))))
    seq = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    own = F.transform(seq(F.col("h")), lambda k: F.struct(F.lit(0).alias("kind"), F.least(k, F.col("at")).alias("i"), F.greatest(k, F.col("at")).alias("j")))
    hosts = F.when(F.col("v") > 0, F.transform(seq(F.greatest(F.col("v"), F.lit(1))), lambda k: F.struct(F.lit(1).alias("kind"), F.col("at").alias("i"), k.alias("j")))).otherwise(F.array().cast("array<struct<kind:int,i:bigint,j:bigint>>"))
    guests = F.transform(seq(F.col("h")), lambda k: F.struct(F.lit(1).alias("kind"), k.alias("i"), F.col("at").alias("j")))
    blocks = part.withColumn("b", F.explode(F.when(F.col("own"), F.concat(own, hosts)).otherwise(guests)))
    blocks = blocks.select(F.xxhash64(*by, "b").alias("task"), *by, "b.kind", "b.i", "b.j", "own", "at", "uid", "n", "unit", "home", "to")
    tasks = parts(spark, int(placed.count()), 4 * BLOCK)
    linked = table(blocks.repartition(tasks, "task").sortWithinPartitions("task", *by, "kind", "i", "j", "uid").mapInArrow(lambda bs: _compare(bs, threshold), "uid long, links long, root long"))

    links = linked.groupBy("uid").agg(F.sum("links").alias("links"))
    root = components(linked.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    rep = one.join(links, "uid", "left").join(root.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    low = rep.groupBy("root").agg(F.min("low").alias("component_id"))
    done = rep.join(low, "root").select("copy", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    member = units.select("uid", "copy").join(done, "copy").drop("copy")
    out = rows.select("uid", "vec_id").join(member, "uid", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _by_key(b: pa.RecordBatch):
    label, dim = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    both = np.stack([label, dim.astype(np.int64)], 1)
    for key in np.unique(both, axis=0):
        yield (int(key[0]), int(key[1])), np.flatnonzero((both == key).all(1))


def _stack(b: pa.RecordBatch, at: np.ndarray) -> np.ndarray:
    return np.stack([np.frombuffer(b.column(4)[int(k)].as_py()) for k in at])


def _compare(batches, threshold: float):
    for b in runs(batches, 0):
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(8)]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:7]], axis=0)) + 1  # equal hashes of two blocks stay apart
        for a, z in zip(np.concatenate([[0], new]), np.concatenate([new, [b.num_rows]])):
            if z - a < 2:
                continue
            yield _block(b.slice(a, z - a), threshold)


def _block(b: pa.RecordBatch, threshold: float) -> pa.RecordBatch:
    cell, kind, i, j = (b.column(k)[0].as_py() for k in (3, 4, 5, 6))
    own, at, uid, n = (b.column(k).to_numpy(zero_copy_only=False) for k in (7, 8, 9, 10))
    x = np.stack([np.frombuffer(v.as_py()) for v in b.column(11)])
    left, right = (np.flatnonzero(own), np.flatnonzero(~own)) if kind else (np.flatnonzero(at == i), np.flatnonzero(at == j))
    same = not kind and i == j
    if kind:  # a pair whose own-cell row visits a lower cell, its visitor's own, counts there
        homes, of = np.unique(b.column(12).to_numpy(zero_copy_only=False)[right], return_inverse=True)
        lower = np.zeros((len(left), len(homes)), bool)
        for k, row in enumerate(left):
            lower[k] = np.isin(homes, np.frombuffer(b.column(13)[int(row)].as_py(), np.int32)) & (homes < cell)
    links, pairs = np.zeros(len(uid), np.int64), []
    for s in range(0, len(left), 512):
        some = left[s : s + 512]
        hit = x[some] @ x[right].T >= threshold
        if same:
            hit[np.arange(len(some)), np.arange(s, s + len(some))] = False
        elif kind:
            hit &= ~lower[s : s + 512][:, of]
        p, q = np.nonzero(hit)
        links[some] += hit @ n[right]
        if not same:
            links[right] += n[some] @ hit
        pairs.append((some[p], right[q]))
    p, q = (np.concatenate(c) if pairs else np.zeros(0, np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    root = uid[roots(len(uid), p, q)]
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(uid[some]), pa.array(links[some]), pa.array(root[some])], ["uid", "links", "root"])
