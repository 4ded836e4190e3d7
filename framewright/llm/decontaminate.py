"""Benchmark decontamination with suffix arrays over the training texts.

Each task cuts its texts into shards, builds the suffix array of a shard's words (sorted to the depth of
a window, by prefix doubling from two words), and binary-searches every suffix of every benchmark item
in it, level by level with the same ranks. A shard holds whole documents, so all of a document's matches
are found where it is read and no text is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import alnum_table, slices, table, tidy, words

WINDOW = 8
#: Bytes of benchmark texts that one pass takes to every executor; a larger benchmark takes more passes.
PASS_BYTES = 32 << 20
_TABLE, _HALF = alnum_table(), np.uint64(32)


class Suffixes:
    """Suffix array of word hashes, sorted by the first `WINDOW` words; texts are parted by a mark."""

    def __init__(self, h: np.ndarray, first: np.ndarray):
        n, texts = len(h), len(first) - 1
        self.names, inverse = np.unique(h, return_inverse=True)
        s = np.zeros(n + texts + WINDOW, np.uint64)
        self.at = np.arange(n) + np.repeat(np.arange(texts), np.diff(first))  # place of each word
        s[self.at] = inverse + 1
        self.s, m = s, n + texts
        key = s[:m] << _HALF | s[1 : m + 1]  # places and names have 32 bits: a shard of some 8 GB of words
        self.keys = []
        for step in (2, 4, 0):
            order = np.argsort(key)
            sorted_ = key[order]
            new = np.empty(m, bool)
            new[:1] = True
            np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
            self.keys.append(sorted_[new])
            rank = np.zeros(m + WINDOW, np.uint64)
            rank[order] = np.cumsum(new).astype(np.uint64)
            if step:
                key = rank[:m] << _HALF | rank[step : m + step]
            self.order, self.begin = order, np.append(np.flatnonzero(new), m)
            if step == 2:
                self.order2, self.begin2 = self.order, self.begin

    @staticmethod
    def _find(keys: np.ndarray, x: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, x)
        ok = ok & (keys[np.minimum(at, len(keys) - 1)] == x)
        return (at + 1).astype(np.uint64), ok

    def search(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every window of WINDOW words of t: found, and the range of the array that begins with it."""
        m = len(t) - WINDOW + 1
        name = np.searchsorted(self.names, t)
        known = self.names[np.minimum(name, len(self.names) - 1)] == t
        s = (name + 1).astype(np.uint64)
        r, ok = self._find(self.keys[0], s[:-1] << _HALF | s[1:], known[:-1] & known[1:])
        r, ok = self._find(self.keys[1], r[:-2] << _HALF | r[2:], ok[:-2] & ok[2:])
        r, ok = self._find(self.keys[2], r[:-4] << _HALF | r[4:], ok[:-4] & ok[4:])
        r = np.where(ok, r, 1).astype(np.int64) - 1
        return ok[:m], self.begin[r][:m], self.begin[r + 1][:m]

    def short(self, t: np.ndarray) -> np.ndarray:
        """Places where the fewer than WINDOW words of t occur."""
        name = np.searchsorted(self.names, t)
        if (self.names[np.minimum(name, len(self.names) - 1)] != t).any():
            return np.zeros(0, np.int64)
        low = (int(name[0]) + 1) << 32
        low, high = (low + int(name[1]) + 1,) * 2 if len(t) > 1 else (low, low + 0xFFFFFFFF)
        a, z = np.searchsorted(self.keys[0], np.uint64(low), "left"), np.searchsorted(self.keys[0], np.uint64(high), "right")
        places = self.order2[self.begin2[a] : self.begin2[z]]
        for k in range(2, len(t)):
            places = places[self.s[places + k] == np.uint64(name[k] + 1)]
        return places


class Items:
    """The benchmark as word hashes: what every task searches for."""

    def __init__(self, ids: list, texts: list[str]):
        raw = [(x or "").encode() for x in texts]
        bounds = np.cumsum([0, *map(len, raw)])
        h, _, first = words(np.frombuffer(b"".join(raw), np.uint8), bounds, _TABLE)
        n = np.diff(first)
        self.ids, self.n, self.first, self.h = ids, n, first, h
        pad = [h[a:z] for a, z in zip(first[:-1], first[1:]) if z - a >= WINDOW]
        self.t = np.concatenate(pad) if pad else np.zeros(0, np.uint64)
        item = np.flatnonzero(n >= WINDOW)
        owner = np.repeat(item, n[item])
        self.item = owner[: max(len(owner) - WINDOW + 1, 0)]
        self.whole = owner[: len(self.item)] == owner[WINDOW - 1 :] if len(self.item) else np.zeros(0, bool)
        self.offset = (np.arange(len(owner)) - np.repeat(np.cumsum(n[item]) - n[item], n[item]))[: len(self.item)]
        self.few = [(k, h[first[k] : first[k + 1]]) for k in np.flatnonzero((n > 0) & (n < WINDOW))]


def _matches(h: np.ndarray, first: np.ndarray, items: Items):
    """(place of word, item, offset in item, words) of every window found, as arrays; places count words of the shard."""
    place, item, offset, size = ([np.zeros(0, np.int64)] for _ in range(4))
    if len(h):
        sa = Suffixes(h, first)
        back = np.full(len(sa.s), -1, np.int64)
        back[sa.at] = np.arange(len(h))
        if len(items.item):
            ok, a, z = sa.search(items.t)
            ok &= items.whole
            w = np.flatnonzero(ok)
            many = (z - a)[w]
            which = np.repeat(w, many)
            at = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a[w], many)
            place.append(back[sa.order[at]])
            item.append(items.item[which])
            offset.append(items.offset[which])
            size.append(np.full(len(which), WINDOW))
        for k, t in items.few:
            p = back[sa.short(t)]
            place.append(p)
            item.append(np.full(len(p), k))
            offset.append(np.zeros(len(p), np.int64))
            size.append(np.full(len(p), len(t)))
    return tuple(np.concatenate(x).astype(np.int64) for x in (place, item, offset, size))


def longest(place: np.ndarray, item: np.ndarray, offset: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Windows that follow each other in text and item, joined: rows (place, item, offset, words)."""
    if not len(place):
        return np.zeros((0, 4), np.int64)
    order = np.lexsort((place, place - offset, item))
    p, i, o, n = (x[order] for x in (place, item, offset, size))
    new = np.ones(len(p), bool)
    new[1:] = (i[1:] != i[:-1]) | (p[1:] - o[1:] != p[:-1] - o[:-1]) | (p[1:] != p[:-1] + 1)
    a = np.flatnonzero(new)
    z = np.append(a[1:], len(p)) - 1
    return np.stack([p[a], i[a], o[a], p[z] - p[a] + n[z]], 1)


_FOUND = "n_words long, n_hit long, items array<string>, matches array<struct<item_id:string,item_start:long,start:long,length:long>>"


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """docs' columns `keep` (default all) with n_words, n_hit, items (ids as text, sorted) and matches.

    A match is a longest run of words shared verbatim by text and item, of WINDOW words at least or the
    whole of a shorter item; start counts the text's words, item_start the item's. Words are lower-cased
    (A-Z) runs of digits, letters and bytes over 0x7F. Null and empty texts have no words and no matches;
    null items none either; items of equal id count as one. Columns of docs that are called as a result
    column are left out of the result.
    """
    new = ["n_words", "n_hit", "items", "matches"]
    keep = [c for c in (keep or docs.columns) if c not in new]
    whole = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("item_id is not null and text is not null")
    passes = -(-int(whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PASS_BYTES)
    if passes <= 1:
        return _pass(docs, whole, keep)
    # each pass sees a bounded share of the items; spans and items of the passes then meet by row
    key = "__row"
    while key in docs.columns:
        key += "_"
    # written once, so that a row has the same number in every pass, whatever stands upstream
    rows = table(docs.select(*[f"`{c}`" for c in {*keep, "text"}], F.monotonically_increasing_id().alias(key)))
    out = None
    for k in range(passes):
        some = _pass(rows, whole.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k), [*keep, key])
        out = some if out is None else out.unionByName(some)
    first = [F.first(f"`{c}`").alias(c) for c in keep]
    both = out.groupBy(key).agg(*first, F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("matches")).alias("matches"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    step = lambda a, m: F.struct((a["n"] + F.greatest(F.lit(0), m["start"] + m["length"] - F.greatest(a["end"], m["start"]))).alias("n"), F.greatest(a["end"], m["start"] + m["length"]).alias("end"))
    by_start = F.array_sort("matches", lambda a, b: (a["start"] - b["start"]).cast("int"))
    return both.withColumn("n_hit", F.aggregate(by_start, zero, step)["n"]).select(*[f"`{c}`" for c in keep], *new)


def _pass(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    got = benchmark.collect()  # PASS_BYTES of text at most
    items = Items([r[0] for r in got], [r[1] for r in got])
    name = "__text"
    while name in docs.columns:
        name += "_"

    @tidy
    def run(batches):
        kept = range(len(keep))
        for b in batches:
            for i, j, data, bounds in slices(b, name, 2 << 20):
                h, _, first = words(data, bounds, _TABLE)
                place, item, offset, size = _matches(h, first, items)
                hit = np.zeros(len(h) + 1, np.int32)
                np.add.at(hit, place, 1)
                np.add.at(hit, place + size, -1)
                covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
                n_hit = covered[first[1:]] - covered[first[:-1]]
                found = longest(place, item, offset, size)
                doc = np.searchsorted(first, found[:, 0], "right") - 1
                which: dict[int, set] = {}
                where: dict[int, list] = {}
                for d, (p, k, o, n) in zip(doc.tolist(), found.tolist()):
                    which.setdefault(d, set()).add(items.ids[k])
                    where.setdefault(d, []).append({"item_id": items.ids[k], "item_start": o, "start": p - int(first[d]), "length": n})
                rows = range(j - i)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, j - i) for c in kept), pa.array(np.diff(first)), pa.array(n_hit), pa.array([sorted(which.get(r, ())) for r in rows], pa.list_(pa.string())), pa.array([where.get(r, []) for r in rows], _MATCH)],
                    [*keep, "n_words", "n_hit", "items", "matches"],
                )

    from pyspark.sql.types import StructType

    rows = docs.select(*[f"`{c}`" for c in keep], F.coalesce(F.col("text").cast("string"), F.lit("")).alias(name))
    return rows.mapInArrow(run, StructType(rows.schema.fields[:-1] + StructType.fromDDL(_FOUND).fields))


_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_items: int = 2) -> DataFrame:
    """docs without those in which windows of `min_items` or more items occur; columns as they are."""
    tag = ["n_words", "n_hit", "items", "matches"]
    plain = docs.select(F.struct("*").alias("__all"), F.col("text"))
    return find(plain, benchmark, ["__all"]).where(F.size("items") < min_items).select("__all.*").drop(*[c for c in tag if c not in docs.columns])


def items_digest(items) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
