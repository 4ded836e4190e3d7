"""Removal of byte strings that occurred before, by suffix arrays over the places where texts may repeat.

Every `length`-byte window has an anchor, the leftmost of its ANCHOR-byte strings with least hash, so equal
windows have equal anchors at equal places. Windows that follow each other on one anchor are one stretch of
text. Stretches meet by the hash of their anchor: first in the task that reads them, where equal ones become
one, then across tasks. Stretches whose hashes are equal are compared byte by byte and repeat as a whole; where
one anchor has several different stretches a suffix array finds what they share. It is built in two stages: only
suffixes smaller than their successors are sorted, one scan over the buckets of first bytes induces the others,
and adjacent common prefixes of `length` bytes or more mark equal windows.

An anchor that has HOT different stretches where it is read, or more than ARRAY bytes of them where they meet, is
split: its windows go on alone, by two hashes of all their bytes, so that no task gathers what stands around one
common string.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import _powers, mix, parts, slices, table, text_bytes, tidy

LENGTH, ANCHOR, SEGMENT = 100, 24, 1 << 20
#: Bytes of text that a task gathers before it sends stretches on, and that one shard of anchors stands for.
GATHER, SHARD = 16 << 20, 8 << 20
#: Bytes of stretches that one suffix array is built over.
ARRAY = 1 << 20
#: Different stretches of an anchor in one gathering, from which on its windows are sent one by one; bytes that a shard holds
#: before it looks for such anchors.
HOT, HELD = 64, 64 << 20
_BITS = np.uint64(21)


def _hashes(data: np.ndarray, begin: np.ndarray, length) -> np.ndarray:
    """Hash of data[b : b + length] for each begin."""
    p, q = _powers(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=c[1:])
    return mix((c[begin + length] - c[begin]) * q[begin])


def stretches(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin in data, bytes, anchor's place in it) of all stretches of windows within texts."""
    out = []
    doc_end = np.repeat(bounds[1:], np.diff(bounds))
    w = length - ANCHOR + 1
    for s in range(0, max(len(data) - length + 1, 0), SEGMENT):
        piece = data[s : s + SEGMENT + length - 1]
        n = len(piece) - length + 1
        if n <= 0:
            break
        h = _hashes(piece, np.arange(len(piece) - ANCHOR + 1), ANCHOR)
        h = (h >> _BITS << _BITS) | np.arange(len(h), dtype=np.uint64)
        m, span = h, 1
        while span * 2 <= w:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if span < w:
            m = np.minimum(m[: len(h) - w + 1], m[w - span : len(h) - w + 1 + w - span])
        place = (m[:n] & np.uint64((1 << 21) - 1)).astype(np.int64)
        at = np.arange(n)
        ok = at + s + length <= doc_end[s : s + n]
        new = np.ones(n, bool)
        new[1:] = (place[1:] != place[:-1]) | ~ok[:-1] | (doc_end[s + 1 : s + n] != doc_end[s : s + n - 1])
        first = np.flatnonzero(new & ok)
        if not len(first):
            continue
        stop = np.flatnonzero(np.append(new[1:] | ~ok[1:], True) & ok)
        out.append((first + s, stop - first + length, place[first] - first))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    begin, size, anchor = (np.concatenate(x) for x in zip(*out))
    return np.searchsorted(bounds, begin, "right") - 1, begin, size, anchor


def _gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return data[at]


def suffix_array(t: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of bytes t in the order of their first `depth` bytes at least."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    # S: smaller than its successor; equal bytes are of the next suffix's type; the last is not S
    differ = np.flatnonzero(t[1:] != t[:-1])
    nxt = np.searchsorted(differ, np.arange(n))
    small = np.zeros(n, bool)
    has = nxt < len(differ)
    at = differ[nxt[has]]
    small[has] = t[at] < t[at + 1]
    s = np.flatnonzero(small)
    padded = np.concatenate([t, np.zeros(depth + 16, np.uint8)])
    word = np.lib.stride_tricks.as_strided(padded, (n + depth + 8, 8), (1, 1))
    word = np.ascontiguousarray(word).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(word[s], kind="stable")
    s = s[order]
    k = word[s]
    tied = np.zeros(len(s) + 1, bool)  # tied[i]: equal to i-1 so far
    tied[1:-1] = k[1:] == k[:-1]
    for d in range(8, depth, 8):
        open_ = tied[:-1] | tied[1:]
        rows = np.flatnonzero(open_)
        if not len(rows):
            break
        group = np.cumsum(~tied[rows])
        key = word[s[rows] + d]
        o = np.lexsort((key, group))
        s[rows] = s[rows][o]
        key, group = key[o], group[o]
        same = np.zeros(len(rows), bool)
        same[1:] = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        tied[rows] = same
    # the scan: buckets by first byte; within one, induced suffixes stand before sorted ones
    cut = np.searchsorted(t[s], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[t[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        def scan(rows, c=c):
            prev = rows - 1
            prev = prev[prev >= 0]
            prev = prev[~small[prev]]
            b = t[prev]
            same = prev[b == c]
            more = b > c
            prev, b = prev[more], b[more]
            o = np.argsort(b, kind="stable")
            prev, b = prev[o], b[o]
            edge = np.flatnonzero(np.diff(b)) + 1
            for chunk in np.split(prev, edge) if len(prev) else ():
                waiting[t[chunk[0]]].append(chunk)
            return same

        now = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(now):
            out.append(now)
            now = scan(now)
        if cut[c + 1] > cut[c]:
            out.append(s[cut[c] : cut[c + 1]])
            scan(out[-1])
    return np.concatenate(out)


def common(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Whether t[a:] and t[b:] share `most` bytes."""
    padded = np.concatenate([t, np.zeros(most + 8, np.uint8)])
    word = np.lib.stride_tricks.as_strided(padded, (len(t) + most, 8), (1, 1))
    same = np.ones(len(a), bool)
    for d in [*range(0, most - 7, 8), *([most - 8] if most % 8 else [])]:
        rows = np.flatnonzero(same)
        if not len(rows):
            break
        same[rows] = (word[a[rows] + d] == word[b[rows] + d]).all(1)
    return same


def _windows_before(bytes_: np.ndarray, size: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, offset) of each window that a stretch of lower rank has too. Stretches lie end to end."""
    ends = np.cumsum(size)
    sa = suffix_array(bytes_, length)
    owner = np.repeat(np.arange(len(size)), size)[sa]
    whole = ends[owner] - sa >= length
    sa, owner = sa[whole], owner[whole]
    if len(sa) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = common(bytes_, sa[:-1], sa[1:], length)
    first = np.flatnonzero(np.append(True, ~same))
    low = np.minimum.reduceat(rank[owner], first)
    hit = rank[owner] > np.repeat(low, np.diff(np.append(first, len(sa))))
    return owner[hit], sa[hit] - (ends - size)[owner[hit]]


def _equal(anchor: np.ndarray, whole: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted row numbers, whether a row is like the one before): by anchor and content, earliest first."""
    o = np.lexsort((*order[::-1], whole, anchor))
    again = np.zeros(len(o), bool)
    again[1:] = (anchor[o][1:] == anchor[o][:-1]) & (whole[o][1:] == whole[o][:-1])
    return o, again


def _same_bytes(data: np.ndarray, begin: np.ndarray, size: np.ndarray, o: np.ndarray, again: np.ndarray) -> np.ndarray:
    """`again` of _equal where the bytes of both stretches agree as their hashes do."""
    rows = np.flatnonzero(again)
    ends = np.cumsum(size[o[rows]])
    for part in np.split(rows, np.searchsorted(ends, np.arange(1 << 22, ends[-1] if len(ends) else 0, 1 << 22))):
        if len(part):
            a, b = o[part], o[part - 1]
            n = np.minimum(size[a], size[b])
            differ = np.add.reduceat((_gathered(data, begin[a], n) != _gathered(data, begin[b], n)).astype(np.int32), np.cumsum(n) - n)
            again[part[(differ > 0) | (size[a] != size[b])]] = False
    return again


def _windows(data: np.ndarray, begin: np.ndarray, size: np.ndarray, uid, doc, start, length: int):
    """(two hashes, doc, uid, start) of each window of stretches, the earliest of equal ones, and the others as (uid, start)."""
    many = size - length + 1
    row = np.repeat(np.arange(len(size)), many)
    off = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    flat = _gathered(data, begin, size)
    at = (np.cumsum(size) - size)[row] + off
    half = length // 2
    one, two = _hashes(flat, at, length), mix(_hashes(flat, at, half) * np.uint64(0x9E3779B97F4A7C15) + _hashes(flat, at + half, length - half))
    out = one, two, doc[row], uid[row], start[row] + off
    o = np.lexsort(out[::-1])
    out = [x[o] for x in out]
    new = np.ones(len(o), bool)
    new[1:] = (out[0][1:] != out[0][:-1]) | (out[1][1:] != out[1][:-1])
    return [x[new] for x in out], out[3][~new], out[4][~new]


def _window_rows(data, begin, size, uid, doc, start, shards: int, length: int):
    """Rows (shard, 2, payload) of windows, and the spans of those that repeat among them (kind 1)."""
    ends = np.cumsum(size)
    for part in np.split(np.arange(len(size)), np.searchsorted(ends, np.arange(1 << 20, ends[-1] if len(ends) else 0, 1 << 20))):
        if not len(part):
            continue
        first, u, s = _windows(data, begin[part], size[part], uid[part], doc[part], start[part], length)
        if len(u):
            yield int(u[0]) % shards, 1, np.stack([u, s, s + length]).tobytes()
        shard = (first[0] % np.uint64(shards)).astype(np.int64)
        o = np.argsort(shard, kind="stable")
        edge = np.append(np.flatnonzero(np.diff(shard[o], prepend=-1)), len(o))
        for a, z in zip(edge[:-1], edge[1:]):
            k = o[a:z]
            yield int(shard[k[0]]), 2, zstandard.compress(b"".join([np.int64(len(k)).tobytes(), *(x[k].tobytes() for x in first)]), 1)


@tidy
def _meet(batches, length: int):
    """Spans of all windows but the earliest of each content, over all shards in the task."""
    shards: dict[int, list] = {}
    for b in batches:
        for shard, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            shards.setdefault(shard, []).append(payload)
    for shard in list(shards):
        parts_ = []
        for p in shards.pop(shard):
            raw = zstandard.decompress(p)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            parts_.append(np.frombuffer(raw, np.int64, 5 * n, 8).reshape(5, n))
        one, two, doc, uid, start = np.concatenate(parts_, 1)
        o = np.lexsort((start, uid, doc, two, one))
        again = np.zeros(len(o), bool)
        again[1:] = (one[o][1:] == one[o][:-1]) & (two[o][1:] == two[o][:-1])
        r = o[again]
        if len(r):
            yield _spans(uid[r], start[r], start[r] + length)


@tidy
def _send(batches, shards: int, length: int, hot_from: int = HOT):
    """Rows (shard, kind, payload): stretches by shard of anchor, one of each content (kind 0), what repeats within the task
    as spans (1), and windows of anchors that are hot there (2), with a note of these to their shard (3)."""
    squeeze = zstandard.ZstdCompressor(level=3)
    held, size_held = [], 0

    def flush():
        nonlocal held, size_held
        uid, doc, start, size, place, anchor, whole = (np.concatenate(x) for x in list(zip(*held))[:7])
        raw = np.concatenate([x[7] for x in held])
        begin = np.cumsum(size) - size
        o, again = _equal(anchor, whole, doc, uid, start)
        again = _same_bytes(raw, begin, size, o, again)
        rows = []
        if again.any():
            r = o[again]
            rows.append((int(uid[r[0]]) % shards, 1, np.stack([uid[r], start[r], start[r] + size[r]]).tobytes()))
        o = o[~again]
        first = np.flatnonzero(np.append(True, anchor[o][1:] != anchor[o][:-1])) if len(o) else np.zeros(0, np.int64)
        many = np.diff(np.append(first, len(o)))
        hot = np.repeat(many >= hot_from, many)
        if hot.any():
            r = o[hot]
            rows += _window_rows(raw, begin[r], size[r], uid[r], doc[r], start[r], shards, length)
            rows += [(int(x % np.uint64(shards)), 3, x.tobytes()) for x in anchor[o[first[many >= hot_from]]]]
            o = o[~hot]
        shard = (anchor[o] % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((start[o], uid[o], shard))
        o, shard = o[order], shard[order]
        edge = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(o))
        for a, z in zip(edge[:-1], edge[1:]):
            r = o[a:z]
            who, at = np.unique(uid[r], return_index=True)
            n = np.bincount(np.searchsorted(who, uid[r]), minlength=len(who))
            head = np.array([len(r), len(who)], np.int64).tobytes()
            index = b"".join(x.tobytes() for x in (np.diff(who, prepend=0), np.diff(doc[r][at], prepend=0), n, np.diff(start[r], prepend=0).astype(np.int32), size[r].astype(np.uint16), place[r].astype(np.uint8)))
            rows.append((int(shard[a]), 0, squeeze.compress(head + index + _gathered(raw, begin[r], size[r]).tobytes())))
        held, size_held = [], 0
        for k in range(0, len(rows), 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 16]), (pa.int32(), pa.int32(), pa.binary()))], ["shard", "kind", "payload"])

    for b in batches:
        for i, j, data, bounds in slices(b, "text"):
            text, begin, size, place = stretches(data, bounds, length)
            if not len(text):
                continue
            uid = b.column(0).slice(i, j - i).to_numpy(zero_copy_only=False)
            doc = b.column(1).slice(i, j - i).to_numpy(zero_copy_only=False)
            anchor, whole = _hashes(data, begin + place, ANCHOR), _hashes(data, begin, size)
            held.append((uid[text], doc[text], begin - bounds[text], size, place, anchor, whole, _gathered(data, begin, size)))
            size_held += len(data)
            if size_held >= GATHER:
                yield from flush()
    if held:
        yield from flush()


@tidy
def _receive(batches, shards: int, length: int, array: int = ARRAY, most: int = HELD):
    """Rows (kind, shard, uid, spans): spans that earlier text has, of all shards in the task (kind 0), and windows of
    anchors that are hot, here or where they were read (2)."""
    held: dict[int, _Shard] = {}

    def forward(rows):
        for shard, kind, payload in rows:
            if kind == 1:
                uid, start, end = np.frombuffer(payload, np.int64).reshape(3, -1)
                yield _kind0(_spans(uid, start, end))
            else:
                yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([shard], pa.int32()), pa.array([None], pa.int64()), pa.array([payload], pa.binary())], _ROWS)

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            shard, kind, payload = row
            if kind in (1, 2):
                yield from forward([row])
            elif kind == 3:
                held.setdefault(shard, _Shard(shards, length, array, most)).hot.add(payload)
            else:
                s = held.setdefault(shard, _Shard(shards, length, array, most))
                s.add(payload)
                if s.bytes > most:
                    yield from forward(s.split())
    for shard in list(held):
        s = held.pop(shard)
        yield from forward(s.split())
        yield from map(_kind0, s.spans())


_ROWS = ["kind", "shard", "uid", "spans"]


def _kind0(spans: pa.RecordBatch) -> pa.RecordBatch:
    n = spans.num_rows
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array([None] * n, pa.int32()), *spans.columns], _ROWS)


def _spans(uid, start, end) -> pa.RecordBatch:
    """Spans joined where they touch, one row for each text."""
    o = np.lexsort((start, uid))
    uid, start, end = uid[o], start[o], end[o]
    top = 1 << 40
    reach = np.maximum.accumulate(np.cumsum(np.diff(uid, prepend=uid[:1]) != 0) * top + end)
    new = np.ones(len(uid), bool)
    new[1:] = (np.cumsum(np.diff(uid, prepend=uid[:1]) != 0) * top + start)[1:] > reach[:-1]
    a = np.flatnonzero(new)
    last = np.append(a[1:], len(uid)) - 1
    u, s, e = uid[a], start[a], reach[last] % top
    edge = np.append(np.flatnonzero(np.diff(u, prepend=-1)), len(u))
    pack = [np.stack([s[x:y], e[x:y]]).tobytes() for x, y in zip(edge[:-1], edge[1:])]
    return pa.RecordBatch.from_arrays([pa.array(u[edge[:-1]]), pa.array(pack, pa.binary())], ["uid", "spans"])


class _Shard:
    """Stretches of the anchors of a shard."""

    def __init__(self, shards: int, length: int, array: int, most: int):
        self.shards, self.length, self.array, self.most = shards, length, array, most
        self.hot, self.parts, self.bytes = set(), [], 0

    def add(self, payload: bytes) -> None:
        raw = zstandard.decompress(payload)
        m, docs = np.frombuffer(raw, np.int64, 2)
        at = 16
        fields = []
        for kind, n in ((np.int64, docs), (np.int64, docs), (np.int64, docs), (np.int32, m), (np.uint16, m), (np.uint8, m)):
            fields.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
            at += n * np.dtype(kind).itemsize
        who, doc, n, start, size, place = fields
        data = np.frombuffer(raw, np.uint8, -1, at)
        begin = np.cumsum(size) - size
        anchor, whole = np.empty(m, np.uint64), np.empty(m, np.uint64)
        for a in range(0, m, 8192):
            z = min(a + 8192, m)
            piece, b = data[begin[a] : begin[z - 1] + size[z - 1]], begin[a:z] - begin[a]
            anchor[a:z], whole[a:z] = _hashes(piece, b + place[a:z], ANCHOR), _hashes(piece, b, size[a:z])
        self.parts.append((np.repeat(np.cumsum(who), n), np.repeat(np.cumsum(doc), n), np.cumsum(start), size, anchor, whole, data))
        self.bytes += len(data)

    def gather(self):
        uid, doc, start, size, anchor, whole, data = (np.concatenate(x) for x in zip(*self.parts))
        return uid, doc, start, size, anchor, whole, data, np.cumsum(size) - size

    def split(self):
        """Takes hot anchors out: rows of their windows."""
        if not self.parts or not self.hot and self.bytes <= self.array:
            return
        uid, doc, start, size, anchor, whole, data, begin = self.gather()
        names, of = np.unique(anchor, return_inverse=True)
        # copies of one content, compared first, do not make an anchor hot
        o, again = _equal(anchor, whole, doc, uid, start)
        weight = np.bincount(of[o[~again]], size[o[~again]], len(names))
        hot = weight > self.array
        if self.hot:
            hot |= np.isin(names, np.frombuffer(b"".join(self.hot), np.uint64))
        self.hot |= {x.tobytes() for x in names[hot]}
        r = np.flatnonzero(hot[of])
        if len(r):
            yield from _window_rows(data, begin[r], size[r], uid[r], doc[r], start[r], self.shards, self.length)
        if len(r) or self.bytes > self.most:
            k = np.flatnonzero(~hot[of])
            kept = (uid[k], doc[k], start[k], size[k], anchor[k], whole[k], _gathered(data, begin[k], size[k]))
            self.parts, self.bytes = [kept] if len(k) else [], len(kept[-1])

    def spans(self):
        if not self.parts:
            return
        uid, doc, start, size, anchor, whole, data, begin = self.gather()
        self.parts = []
        o, again = _equal(anchor, whole, doc, uid, start)
        again = _same_bytes(data, begin, size, o, again)
        if again.any():
            r = o[again]
            yield _spans(uid[r], start[r], start[r] + size[r])
        o = o[~again]
        x = anchor[o]
        new = np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, bool)
        edge = np.append(np.flatnonzero(new), len(o))
        several = np.repeat(np.diff(edge) > 1, np.diff(edge))
        o = o[several]
        if not len(o):
            return
        x, total = anchor[o], np.cumsum(size[o])
        edge = np.flatnonzero(np.append(True, x[1:] != x[:-1]))  # where anchors begin
        part = (total[edge] - size[o][edge]) // self.array
        cuts = np.append(edge[np.flatnonzero(np.diff(part, prepend=-1))], len(o))
        for a, z in zip(cuts[:-1], cuts[1:]):
            r = o[a:z]
            rank = np.empty(len(r), np.int64)
            rank[np.lexsort((start[r], uid[r], doc[r]))] = np.arange(len(r))
            k, off = _windows_before(_gathered(data, begin[r], size[r]), size[r], rank, self.length)
            if len(k):
                yield _spans(uid[r][k], start[r][k] + off, start[r][k] + off + self.length)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(uid, spans): for rows (uid, doc_id, text) all bytes within a window of `length` bytes that also starts earlier.

    Earlier: smaller doc_id (null least), then smaller uid, then smaller start; uids are unique longs. spans: int64
    starts, then ends; a uid may have several rows, whose spans may overlap.
    """
    shards = parts(docs.sparkSession, text_bytes(docs), SHARD)
    least = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62)))
    text = docs.select(F.col("uid"), least.alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hot, array, held = HOT, ARRAY, HELD  # workers get them with the function
    sent = text.mapInArrow(lambda bs: _send(bs, shards, length, hot), "shard int, kind int, payload binary")
    first = table(sent.repartitionById(shards, "shard").mapInArrow(lambda bs: _receive(bs, shards, length, array, held), "kind int, shard int, uid long, spans binary"))
    spans = first.where("kind = 0").select("uid", "spans")
    windows = first.where("kind = 2").select("shard", "spans")
    if windows.isEmpty():
        return spans
    met = table(windows.repartitionById(shards, "shard").mapInArrow(lambda bs: _meet(bs, length), "uid long, spans binary"))
    return spans.unionAll(met)


def merged(spans: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal spans."""
    both = np.concatenate([np.frombuffer(x, np.int64).reshape(2, -1) for x in spans], 1)
    o = np.argsort(both[0], kind="stable")
    start, end = both[0][o], np.maximum.accumulate(both[1][o])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    a = np.flatnonzero(new)
    return start[a], end[np.append(a[1:], len(start)) - 1]


def remove_repeats(docs: DataFrame, length: int = LENGTH, kept_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]) for each row of docs (doc_id, text).

    All bytes in a window of `length` bytes that also starts earlier go; windows lie within one text and are
    judged on the input. `kept` has the bytes left, which need not be whole characters. Null and empty texts
    have 0 bytes. Repeated rows and ids are texts of their own, in the order of the table's files; null ids
    come before others. An empty table gives no row. docs must be read from files or a checkpoint, so that
    its rows have the same number in both passes.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("uid"))
    spans = repeated_spans(rows, length)
    found = spans.groupBy("uid").agg(F.collect_list("spans").alias("spans"))

    @tidy
    def run(batches):
        for b in batches:
            for i, j, data, bounds in slices(b, "text", 4 << 20):
                out = []
                for k, spans in enumerate(b.column(2).slice(i, j - i).to_pylist()):
                    x = data[bounds[k] : bounds[k + 1]]
                    n, gone, many = len(x), 0, 0
                    if spans:
                        start, end = merged(spans, n)
                        gone, many = int((end - start).sum()), len(start)
                        mark = np.zeros(n + 1, np.int8)
                        mark[start] += 1
                        mark[end] -= 1
                        x = x[np.cumsum(mark[:-1]) == 0]
                    out.append((n, gone, many, hashlib.sha256(x).hexdigest()) + ((x.tobytes(),) if kept_text else ()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *(pa.array(c) for c in zip(*out))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * kept_text)

    sql = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept_text
    return rows.join(found, "uid", "left").select("doc_id", "text", "spans").mapInArrow(run, sql)
