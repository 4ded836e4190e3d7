"""Jaccard join of shingle sets by chosen paths.

A document is its set of word shingles; equal sets are one node with a count. In each run a bucket of more
than SMALL nodes is split by sampled tokens: the bucket's own key chooses places of the nodes' signatures, one
always and a second one in four times (1 / 0.8 on average), and a node goes on to one bucket for each, that of
its least shingle there. Two nodes share such a step with the chance of their similarity. Buckets of SMALL
nodes and those of the last level are compared by brute force on short signatures. A bucket of BLOCK nodes at
most is split in one task, a larger one by Spark. BATCH runs at a time are
repeated until a further batch moves fewer than 1 - TARGET of the linked nodes to another group. What signatures
join is then compared exactly, every pair within, in blocks.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, roots, runs
from .util import alnum_table, drop_table, grams, mix, parts, scratch, slices, small, table, tidy, words

WORDS, THRESHOLD = 5, 0.8
#: Runs at a time; share of linked nodes that a further batch must leave where they are; levels; nodes of a small bucket.
BATCH, TARGET, DEPTH, SMALL, HASHES = 5, 0.999, 4, 256, 64
#: Signature places that must agree for an exact comparison: at similarity 0.8, 1 pair in 10,000 has fewer.
AGREE, BLOCK = 38, 4096
#: Bytes of shingles, and nodes, in a block of the exact comparison.
BLOCK_BYTES, BLOCK_NODES = 24 << 20, 2048
_TABLE = alnum_table()
_RNG = np.random.default_rng(5)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_C = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(data: np.ndarray, bounds: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by text) of all runs of n words; a text of fewer words, but not none, has one of all."""
    h, _, first = words(data, bounds, _TABLE)
    many = np.diff(first)
    g = grams(h, n)
    text = np.repeat(np.arange(len(many)), many)
    inside = text[: len(g)] == text[n - 1 :] if len(g) else np.zeros(0, bool)
    g, of = g[inside], text[: len(g)][inside]
    few = np.flatnonzero((many > 0) & (many < n))
    if len(few):
        short = np.array([grams(h[first[k] : first[k + 1]], int(many[k]))[0] ^ np.uint64(many[k]) for k in few], np.uint64)
        g, of = np.concatenate([g, short]), np.concatenate([of, few])
        order = np.argsort(of, kind="stable")
        g, of = g[order], of[order]
    return g, np.searchsorted(of, np.arange(len(many) + 1))


def node_of(unique: np.ndarray) -> int:
    """63-bit address of a sorted shingle set."""
    return int.from_bytes(hashlib.blake2b(unique.tobytes(), digest_size=8).digest(), "little") >> 1


@tidy
def _signatures(batches):
    for b in batches:
        for i, j, data, bounds in slices(b, "text"):
            g, first = shingles(data, bounds)
            some = np.flatnonzero(np.diff(first))
            sig = np.zeros((len(some), HASHES), np.uint32)
            for k in range(HASHES if len(some) else 0):
                sig[:, k] = np.minimum.reduceat((g ^ _C[k]) * _A[k], first[:-1][some]) >> np.uint64(32)
            node, raw = [None] * (j - i), [None] * (j - i)
            for row, s in zip(some, sig):
                node[row] = node_of(np.unique(g[first[row] : first[row + 1]]))
                raw[row] = s.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(node, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "node", "sig"])


def _chosen(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket key the signature place it always chooses, and a second one or -1."""
    x = mix(key ^ np.uint64(0x6A09E667F3BCC908))
    one = (x % np.uint64(HASHES)).astype(np.int64)
    other = (one + 1 + (x >> np.uint64(8)).astype(np.int64) % (HASHES - 1)) % HASHES
    return one, np.where(x >> np.uint64(62) == 0, other, -1)


def _step(key: np.ndarray, place: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """Key of the bucket below `key` of nodes that agree at `place`."""
    at = np.take_along_axis(sig, place[:, None], 1)[:, 0].astype(np.uint64)
    return mix(key * np.uint64(0x9E3779B97F4A7C15) + at * np.uint64(0xD6E8FEB86659FD93) + place.astype(np.uint64))


@tidy
def _split(batches, first: int | None):
    """(key, node) of the next level. first: number of a batch's first run, whose rows are (node, sig) and begin there;
    deeper rows are (key, node, sig) with signatures of a byte for each place, which part a bucket 256 ways."""
    for b in batches:
        if not b.num_rows:
            continue
        node = b.column(b.num_columns - 2).to_numpy(zero_copy_only=False)
        sig = np.frombuffer(b"".join(b.column(b.num_columns - 1).to_pylist()), np.uint8 if first is None else np.uint32).reshape(b.num_rows, HASHES)
        keys = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)] if first is None else [np.full(b.num_rows, mix(np.array([run + 1], np.uint64))[0]) for run in range(first, first + BATCH)]
        for k, key in enumerate(keys):
            one, other = _chosen(key)
            if first is not None:  # other places in each run while there are some
                one, other = np.full_like(one, (first + k) % HASHES), np.full_like(one, (first + k + HASHES // 2) % HASHES if k % 4 == 3 else -1)
            for place in (one, other):
                some = np.flatnonzero(place >= 0)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(_step(key[some], place[some], sig[some]).view(np.int64)), pa.array(node[some])], ["key", "node"])


def _leaves(key: int, mine: np.ndarray, sig: np.ndarray, depth: int, small: int) -> list[np.ndarray]:
    """Rows `mine` of a bucket, split as _split does until parts are small or `depth` steps are done."""
    if len(mine) < 2:
        return []
    if len(mine) <= small or not depth:
        return [mine]
    out = []
    k = np.array([key], np.uint64)
    for place in _chosen(k):
        if place[0] >= 0:
            below = _step(np.full(len(mine), k[0]), np.full(len(mine), place[0]), sig[mine])
            order = np.argsort(below, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(below[order])) + 1):
                out += _leaves(int(below[part[0]]), mine[part], sig, depth - 1, small)
    return out


@tidy
def _within(batches, small: int):
    """_alike for whole buckets (key, steps left, node, sig): split further here, then compared one by one."""
    for b in runs(batches, 0):
        a, z = _cut(b, 1)
        key, left, node = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        some = np.flatnonzero(z - a > 1)
        if not len(some):
            continue
        sig = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(b.num_rows, HASHES)
        p, q, even = [], [], []
        for k in some:
            if z[k] - a[k] <= 32:
                even.append(np.arange(a[k], z[k]))
                continue
            for leaf in _leaves(int(key[a[k]].view(np.uint64)), np.arange(a[k], z[k]), sig, int(left[a[k]]), small):
                if len(leaf) <= 32:
                    even.append(leaf)
                    continue
                for s in range(0, len(leaf), 64):
                    x, y = np.nonzero((sig[leaf[s : s + 64], None] == sig[None, leaf]).sum(2, dtype=np.uint8) >= AGREE)
                    p.append(leaf[s : s + 64][x])
                    q.append(leaf[y])
        if even:  # many small ones at once, by their distance in a row
            order, group = np.concatenate(even), np.repeat(np.arange(len(even)), list(map(len, even)))
            for lag in range(1, max(map(len, even))):
                one = np.flatnonzero(group[lag:] == group[:-lag])
                for s in range(0, len(one), 1 << 16):
                    o = one[s : s + (1 << 16)]
                    o = o[(sig[order[o]] == sig[order[o + lag]]).sum(1) >= AGREE]
                    p.append(order[o])
                    q.append(order[o + lag])
        root = node[roots(len(node), np.concatenate(p), np.concatenate(q))] if p else node
        far = np.flatnonzero(root != node)
        if len(far):
            yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(root[far])], ["a", "b"])


def _batch(nodes: DataFrame, low: DataFrame, first: int, tasks: int) -> DataFrame:
    """(a, b): pairs that tell which nodes BATCH runs from number `first` on find alike.

    Buckets of BLOCK nodes at most go to one task each, which splits them further; larger ones are split by Spark, a
    level at a time, and what is still larger at the last level is compared in blocks.
    """
    left = table(nodes.select("node", "sig").mapInArrow(lambda bs: _split(bs, first), "key long, node long"))
    fit, blocks, small_ = [], None, SMALL
    for level in range(1, DEPTH + 1):
        # a table of its own: Spark splits a hot key of a join only if both sides are plain shuffles
        large = table(left.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK))
        n = large.count()
        some = left.join(small(large.select("key"), 8 * n), "key", "left_anti") if n else left
        fit.append(some.withColumn("left", F.lit(DEPTH - level)))
        if not n:
            break
        here = left.join(large, "key")
        if level < DEPTH:
            left = table(here.select("key", "node").join(low, "node").select("key", "node", "sig").mapInArrow(lambda bs: _split(bs, None), "key long, node long"))
        else:
            blocks = _pairs_of_blocks(here.select(F.col("key").alias("bucket"), "node", F.ceil(F.col("size") / BLOCK).alias("blocks")), "bucket", "blocks", "node").join(low, "node")
            blocks = blocks.select("task", "bucket", "pair.i", "pair.j", "at", "node", "sig").repartition(tasks, "task").sortWithinPartitions("task", "bucket", "i", "j", "node").mapInArrow(_alike, "a long, b long")
    rows = fit[0]
    for more in fit[1:]:
        rows = rows.unionAll(more)
    rows = rows.join(low, "node").select("key", "left", "node", "sig").repartition(tasks, "key").sortWithinPartitions("key", "node")
    within = rows.mapInArrow(lambda bs: _within(bs, small_), "a long, b long")
    return within if blocks is None else within.unionAll(blocks)


def _groups(nodes: DataFrame, size: int) -> DataFrame:
    """(node, root) of nodes that runs join, the runs repeated until TARGET is reached."""
    tasks, k, near = parts(nodes.sparkSession, size * BATCH, 200_000), 0, None
    low = table(nodes.select("node", "sig").mapInArrow(_low_bytes, "node long, sig binary"))
    while True:
        with scratch() as kept:
            alike = _batch(nodes, low, k * BATCH, tasks)
            now = table(components(alike if near is None else alike.union(near.select("node", "root"))))
            kept.append(now)
        k += 1
        if near is not None:
            was = near.select("node", F.col("root").alias("was"))
            seen = now.join(was, "node", "left").agg(F.count("*").alias("n"), F.count_if(~F.col("root").eqNullSafe(F.col("was"))).alias("moved")).first()
            drop_table(near)
            if seen["moved"] <= (1 - TARGET) * seen["n"]:
                return now
        near = now


def _pairs_of_blocks(rows: DataFrame, key: str, blocks: str, node: str) -> DataFrame:
    """A row for each pair (i <= j) of `blocks` parts that holds the row's part: `at` is its part, by hash of node."""
    at = F.pmod(F.xxhash64(node), F.col(blocks))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1), lambda k: F.struct(F.least(k, F.col("at")).alias("i"), F.greatest(k, F.col("at")).alias("j")))
    return rows.withColumn("at", at).withColumn("pair", F.explode(pair)).withColumn("task", F.xxhash64(key, "pair"))


def _cut(b: pa.RecordBatch, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each group of equal first columns."""
    new = np.zeros(b.num_rows, bool)
    new[:1] = True
    for k in range(columns):
        c = b.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= c[1:] != c[:-1]
    a = np.flatnonzero(new)
    return a, np.append(a[1:], b.num_rows)


@tidy
def _alike(batches):
    """Within each bucket, nodes whose signatures agree often enough, as (node, least such node reached)."""
    for b in runs(batches, 0):
        a, z = _cut(b, 4)
        node, at = b.column(5).to_numpy(zero_copy_only=False), b.column(4).to_numpy(zero_copy_only=False)
        i, j = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False)
        sig = np.frombuffer(b"".join(b.column(6).to_pylist()), np.uint8).reshape(b.num_rows, HASHES)
        group = np.repeat(np.arange(len(a)), z - a)
        p, q = [], []
        small = z - a <= 32
        rows = small[group]
        for lag in range(1, int((z - a)[small].max(initial=1))):
            one = np.flatnonzero(rows[:-lag] & (group[lag:] == group[:-lag]))
            if lag > 0 and len(one):
                one = one[(i[one] == j[one]) | (at[one] != at[one + lag])]
            for s in range(0, len(one), 1 << 16):
                o = one[s : s + (1 << 16)]
                o = o[(sig[o] == sig[o + lag]).sum(1) >= AGREE]
                p.append(o)
                q.append(o + lag)
        for k in np.flatnonzero(~small):
            mine = np.arange(a[k], z[k])
            left, right = (mine, mine) if i[a[k]] == j[a[k]] else (mine[at[mine] == i[a[k]]], mine[at[mine] == j[a[k]]])
            for s in range(0, len(left), 64):
                x, y = np.nonzero((sig[left[s : s + 64], None] == sig[None, right]).sum(2, dtype=np.uint8) >= AGREE)
                x = left[s : s + 64][x]
                p.append(x)
                q.append(right[y])
        root = node[roots(len(node), np.concatenate(p), np.concatenate(q))] if p else node
        some = np.flatnonzero(root != node)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(root[some])], ["a", "b"])


@tidy
def _sets(batches):
    """Sorted shingle set of each row whose text is still that of its node."""
    for b in batches:
        for i, j, data, bounds in slices(b, "text"):
            g, first = shingles(data, bounds)
            want, raw = b.column(1).slice(i, j - i).to_pylist(), []
            for row in range(j - i):
                u = np.unique(g[first[row] : first[row + 1]])
                raw.append(u.tobytes() if len(u) and node_of(u) == want[row] else None)
            keep = pa.array([x is not None for x in raw])
            out = pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in (1, 2, 3)), pa.array(raw, pa.binary())], ["node", "n", "root", "set"])
            yield out.filter(keep)


@tidy
def _exact(batches, threshold: float):
    """Links of each node to others of its block pair, counting copies, and the least node that links reach."""
    ratio = Fraction(threshold).limit_denominator(1_000_000)  # 0.8 is 4/5: ties are decided in integers
    for b in runs(batches, 0):
        for a, z in zip(*_cut(b, 4)):
            if z - a < 2:
                continue
            g = b.slice(a, z - a)
            i, j = g.column(2)[0].as_py(), g.column(3)[0].as_py()
            at, node, n = (g.column(k).to_numpy(zero_copy_only=False) for k in (4, 5, 6))
            keep = np.sort(np.unique(node, return_index=True)[1])  # a node's row may be there twice
            at, node, n = at[keep], node[keep], n[keep]
            sets = [np.frombuffer(g.column(7)[int(k)].as_py(), np.uint64) for k in keep]
            size = np.array([len(s) for s in sets])
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            flat = flat[order]
            row = np.repeat(np.arange(len(sets), dtype=np.int32), size)[order]
            del order
            first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
            many = np.diff(np.append(first, len(flat)))
            shared = int((many > 1).sum())  # shingles of one set alone are in no intersection
            row = row[np.repeat(many > 1, many)]
            col = np.repeat(np.arange(shared), many[many > 1])
            del flat
            left = np.flatnonzero(at == i)
            right = left if i == j else np.flatnonzero(at == j)
            both = np.zeros((len(left), len(right)), np.int32)
            step = max(256, (1 << 22) // len(sets))
            for s in range(0, shared, step):
                x, y = np.searchsorted(col, (s, s + step))
                m = np.zeros((len(sets), step), np.float32)
                m[row[x:y], col[x:y] - s] = 1
                both += (m[left] @ m[right].T).astype(np.int32)
            # shared >= ratio * (both sizes - shared), solved for the least number shared
            hit = both >= -(-ratio.numerator * (size[left][:, None] + size[right]) // (ratio.numerator + ratio.denominator))
            if i == j:
                np.fill_diagonal(hit, False)
            links = np.zeros(len(node), np.int64)
            links[left] += hit @ n[right]
            if i != j:
                links[right] += n[left] @ hit
            p, q = np.nonzero(hit)
            root = node[roots(len(node), left[p], right[q])]
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(root[some])], ["node", "links", "root"])


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Tables (doc_id, node), a row for each of docs, and (node, root, class_id, links)."""
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    with scratch() as kept:
        signed = table(text.mapInArrow(_signatures, "doc_id long, node long, sig binary"))
        # min(sig) is any row's: equal nodes have equal signatures
        nodes = table(signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.min("sig").alias("sig")))
        rows = table(signed.select("doc_id", "node"))
        drop_table(signed)
        size = nodes.count()
        near = _groups(nodes, size)
        group = near.union(near.select(F.col("root").alias("node"), "root").distinct())
        nodes_ = table(nodes.select("node", "rep", "n"))
        drop_table(nodes)
        want = table(nodes_.join(group, "node"))
        chosen = small(want, 32 * want.count())
        again = text.join(chosen, text["doc_id"].eqNullSafe(chosen["rep"])).select("text", "node", "n", "root")
        sets = table(again.mapInArrow(_sets, "node long, n long, root long, set binary"))
        total = table(sets.groupBy("root").agg(F.greatest(F.ceil(F.sum(F.octet_length("set")) / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK_NODES)).alias("blocks")))
        exact = _pairs_of_blocks(sets.join(total, "root"), "root", "blocks", "node").select("task", "root", "pair.i", "pair.j", "at", "node", "n", "set")
        tasks = parts(spark, size, 20_000)
        found = table(exact.repartition(tasks, "task").sortWithinPartitions("task", "root", "i", "j", "node").mapInArrow(lambda bs: _exact(bs, threshold), "node long, links long, root long"))
        drop_table(sets)

        linked = found.groupBy("node").agg(F.sum("links").alias("links"))
        root = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
        full = nodes_.join(linked, "node", "left").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        low = full.groupBy("root").agg(F.min("rep").alias("class_id"))
        done = table(full.join(low, "root").select("node", "root", "class_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
        kept += [rows, done]
    return rows, done


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links, kept) for every row of docs (doc_id, text); other columns are ignored.

    Texts whose sets of 5-word shingles have a Jaccard similarity of `threshold` or more are linked; n_links
    counts other rows linked directly, copies included. class_id is the least doc_id that links reach, kept
    whether it is the row's own. Texts without words (null, empty, marks only) link with nothing. Repeated
    rows are copies of each other, and all rows of the id that stays are kept. Null ids are rows like
    others, but never a class's least id unless all are null. An empty table gives no row.
    """
    rows, done = _classes(docs, threshold)
    out = rows.join(done, "node", "left")
    out = out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def _low_bytes(batches):
    """Signatures shortened to a byte for each place."""
    for b in batches:
        if b.num_rows:
            low = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).astype(np.uint8).reshape(b.num_rows, HASHES)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in low], pa.binary())], ["node", "sig"])


def _node(text: pa.Array) -> pa.Array:
    """Address of a text's shingle set, null without words."""
    out = []
    for _, _, data, bounds in slices(pa.RecordBatch.from_arrays([text], ["t"]), "t"):
        g, first = shingles(data, bounds)
        out += [node_of(np.unique(g[a:z])) if z > a else None for a, z in zip(first[:-1], first[1:])]
    return pa.array(out, pa.int64())


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row of each class, one of the least doc_id (a null id only if all are null); columns as they are.

    Rows, not ids, stay or go: of repeated rows one stays, and where rows of one id have different texts each is judged
    by its own text. Documents without words all stay. While few go, their ids are broadcast and no text
    moves; beyond that texts are shuffled once, by id.
    """
    with scratch() as kept:
        rows, done = _classes(docs, threshold)
        each = rows.where("node is not null").distinct().join(done.select("node", "root"), "node")
        least = each.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("of"))
        stay = table(least.select(F.col("of.doc_id").alias("__id"), F.col("of.node").alias("__node")))
        ids = rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("node").alias("node"))
        odd = table(ids.where("n > 1 or doc_id is null").select(F.col("doc_id").alias("__id")))
        single = ids.where("n = 1 and doc_id is not null and node is not null")
        gone = table(single.join(stay, (single["doc_id"] == stay["__id"]) & (single["node"] == stay["__node"]), "left_anti").select(F.col("doc_id").alias("__id")))
        kept += [stay, odd, gone]
    id_ = docs["doc_id"].cast("long")
    n_gone, n_odd = gone.count(), odd.count()
    leave = small(gone.union(odd), 8 * (n_gone + n_odd), 4 << 20)
    out = docs.join(leave, id_.eqNullSafe(leave["__id"]), "left_anti")
    if not n_odd:
        return out
    again = small(odd, 8 * n_odd, 4 << 20)
    twice = docs.join(again, id_.eqNullSafe(again["__id"]), "left_semi").select(F.struct("*").alias("__all"), F.arrow_udf(_node, "long")(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("__of"))
    blank = twice.where("__of is null").select("__all.*")
    judged = twice.where("__of is not null").join(stay, F.col("__all.doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__node")), "left_semi")
    one = judged.withColumn("__key", F.col("__all.doc_id").cast("long")).dropDuplicates(["__key", "__of"]).select("__all.*")
    return out.unionByName(blank).unionByName(one)
