"""Hierarchical Pitman-Yor language model of words given the word before.

One restaurant for each word that stands before another, found by its 64-bit hash; all share one parent, the
restaurant of single words, whose parent is uniform over the V known words and one unknown. The state is how
many tables each word has in each restaurant.

A task sorts the tokens of a chunk of texts by word and context. Their distinct types go, packed, to shards by
word, so that a word's tables in all contexts, its customers in the parent and its count are in one task;
frequent words are spread over several shards by context. Shards are the buckets of a table, which later passes
read where they lie. What a pass needs of other shards are the sums of its contexts, customers and tables: every
shard sends its own to the task of each group of contexts and gets the totals back, so what moves grows with the
types, and no task or driver holds all contexts. Only sums of hot words and a few numbers reach the driver. In a
Gibbs sweep a shard draws the tables of every word and context anew, given all other sums as the last sweep left
them: the seating of up to EXACT customers from its exact conditional (generalised Stirling numbers), the rest by
seating them one batch after another. Probabilities are averaged over SAMPLES draws after BURN_IN sweeps; these
draws share the sums of the last sweep.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import bucketed, drop_table, mix, parts, slices, space_table, table, text_bytes, tidy, words

#: Contexts whose sums one message carries at most.
CONTEXTS = 1 << 16
D_WORD, T_WORD, D_CONTEXT, T_CONTEXT = 0.5, 100.0, 0.8, 2.0
BURN_IN, SAMPLES, EXACT = 2, 3, 48
#: Bytes of text that a task packs at once, and that a shard of words stands for.
GATHER, SHARD = 12 << 20, 12 << 20
_TABLE = space_table()
_END, _BEGIN = np.uint64(0x51ED270B35C4A3F1), np.uint64(0xA0761D6478BD642F)


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, text) of every token; each text's last is its end."""
    h, _, first = words(data, bounds, _TABLE)
    many = np.diff(first)
    n = len(many)
    tok = np.full(len(h) + n, _END, np.uint64)
    tok[np.arange(len(h)) + np.repeat(np.arange(n), many)] = h
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[first[:-1] + np.arange(n)] = _BEGIN
    return tok, before, np.repeat(np.arange(n), many + 1)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a) for a in arrays)], np.int64).tobytes()
    kinds = "".join(a.dtype.char for a in arrays).encode().ljust(16)
    return zstandard.ZstdCompressor(level=1).compress(head + kinds + b"".join(a.tobytes() for a in arrays))


def _unpack(raw: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(raw)
    k = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, k, 8)
    at = 8 + 8 * k
    kinds = raw[at : at + 16].decode()
    at += 16
    out = []
    for n, c in zip(sizes, kinds):
        out.append(np.frombuffer(raw, c, int(n), at))
        at += int(n) * np.dtype(c).itemsize
    return out


def _shard_of(word: np.ndarray, context: np.ndarray, shards: int, hot: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Shard of each (word, context): by word, but hot words also by context over `spread` shards."""
    s = (word >> np.uint64(11)) % np.uint64(shards)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
        mine = np.flatnonzero(hot[at] == word)
        s[mine] = (s[mine] + mix(context[mine]) % spread[at[mine]]) % np.uint64(shards)
    return s.astype(np.int64)


@tidy
def _frequent(batches, shards: int):
    """Words that make up more than 1 in 8 * shards of a slice, with their counts."""
    for b in batches:
        for _, _, data, bounds in slices(b, "text"):
            w, n = np.unique(tokens(data, bounds)[0], return_counts=True)
            some = n * 8 * shards >= n.sum()
            yield pa.RecordBatch.from_arrays([pa.array(w[some].view(np.int64)), pa.array(n[some]), pa.array(np.where(np.arange(some.sum()) == 0, n.sum(), 0))], ["word", "n", "all"])


@tidy
def _send(batches, shards: int, hot: np.ndarray, spread: np.ndarray):
    """For each chunk of texts a row of facts and texts of tokens (kind 1), and a row of types for each shard (kind 0)."""
    task, no, held, size, docs = TaskContext.get().partitionId(), 0, [], 0, 0

    def flush():
        nonlocal no, held, size, docs
        chunk = (task << 24) + no
        no += 1
        tok, before, doc = (np.concatenate([x[k] for x in held]) for k in range(3))
        doc_id, null, train = (np.concatenate([x[k] for x in held]) for k in (3, 4, 5))
        n_tokens = np.bincount(doc, minlength=docs)
        name = np.unique(np.append(tok, _BEGIN))
        word, ctx = np.searchsorted(name, tok), np.searchsorted(name, before)
        del tok, before
        order = np.argsort(word * len(name) + ctx, kind="stable")  # tokens of a type stay in the order of texts
        word, ctx, doc = word[order].astype(np.int32), ctx[order].astype(np.int32), doc[order].astype(np.uint16)
        new = np.append(True, (word[1:] != word[:-1]) | (ctx[1:] != ctx[:-1]))
        type_ = np.flatnonzero(new)
        shard = _shard_of(name[word[type_]], name[ctx[type_]], shards, hot, spread)
        by_shard = np.argsort(shard, kind="stable")
        many, begin = np.diff(np.append(type_, len(word)))[by_shard], type_[by_shard]
        learned = np.add.reduceat(train[doc].astype(np.uint32), type_)[by_shard]
        word, ctx, shard = word[begin], ctx[begin], shard[by_shard]
        at = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())
        yield _row(chunk % shards, 1, chunk, _pack(doc_id, null, train, n_tokens), _pack(many.astype(np.uint16 if many.max() < 1 << 16 else np.uint32), doc[at]))
        edge = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        held, size, docs = [], 0, 0
        for a, z in zip(edge[:-1], edge[1:]):
            w, c = word[a:z], ctx[a:z]
            first = np.flatnonzero(np.diff(w, prepend=-1))
            of, place = np.unique(c, return_inverse=True)
            yield _row(int(shard[a]), 0, chunk, _pack(name[w[first]], np.diff(np.append(first, z - a)).astype(np.uint32), name[of], place.astype(np.uint16 if len(of) < 1 << 16 else np.uint32), learned[a:z]), None)

    for b in batches:
        for i, j, data, bounds in slices(b, "text"):
            for a in range(i, j, 30_000):
                z = min(a + 30_000, j)
                tok, ctx, doc = tokens(data[bounds[a - i] : bounds[z - i]], bounds[a - i : z - i + 1] - bounds[a - i])
                ids = b.column(0).slice(a, z - a)
                held.append((tok, ctx, doc + docs, ids.fill_null(0).to_numpy(zero_copy_only=False), np.array(ids.is_null()), b.column(1).slice(a, z - a).to_numpy(zero_copy_only=False).astype(bool)))
                size, docs = size + int(bounds[z - i] - bounds[a - i]), docs + z - a
                if size >= GATHER or docs > 30_000:
                    yield from flush()
    if held:
        yield from flush()


def _row(*row) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], ["shard", "kind", "chunk", "payload", "tokens"])


@tidy
def _merge(batches, groups: int):
    """One row for each shard: `types` (words, then contexts by number and training counts by word), `contexts` by group and
    hash, and `tokens` (which types each chunk has); rows of facts pass through."""
    names, kinds = ["shard", "kind", "chunk", "types", "contexts", "tokens"], (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    one = lambda *row: pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)
    shards: dict[int, list] = {}
    for b in batches:
        for shard, kind, chunk, payload, toks in zip(*(c.to_pylist() for c in b.columns)):
            if kind:
                yield one(shard, 1, chunk, payload, None, toks)
            else:
                shards.setdefault(shard, []).append((chunk, payload))
    for shard in list(shards):
        got = [(c, *_unpack(p)) for c, p in sorted(shards.pop(shard))]
        word, ctx = np.unique(np.concatenate([x[1] for x in got])), np.unique(np.concatenate([x[3] for x in got]))
        key = np.concatenate([np.repeat(np.searchsorted(word, w), n) * len(ctx) + np.searchsorted(ctx, c)[place] for _, w, n, c, place, _ in got])
        type_, inverse = np.unique(key, return_inverse=True)
        count = np.bincount(inverse, np.concatenate([x[5] for x in got]), len(type_)).astype(np.uint32)
        of, context = type_ // len(ctx), type_ % len(ctx)
        order = np.lexsort((ctx, group_of(ctx, groups)))
        number = np.empty(len(ctx), np.uint32)
        number[order] = np.arange(len(ctx))
        types = _pack(word, np.bincount(of, minlength=len(word)).astype(np.uint32), number[context], count)
        toks = _pack(np.array([x[0] for x in got], np.int64), np.array([len(x[4]) for x in got], np.int64), inverse.astype(np.uint32))
        yield one(shard, 0, -1, types, _pack(ctx[order]), toks)


def group_of(context: np.ndarray, groups: int) -> np.ndarray:
    """Group of contexts whose sums meet in one task."""
    return ((context >> np.uint64(13)) % np.uint64(groups)).astype(np.int64)


def stirling(d: float, n: int = EXACT) -> np.ndarray:
    """log of generalised Stirling numbers: [c, t] weighs the seatings of c customers at t tables."""
    s = np.full((n + 1, n + 2), -np.inf)
    s[1, 1] = 0
    t = np.arange(n + 2)
    for c in range(1, n):
        stay = c - d * t
        s[c + 1, 1:] = np.logaddexp(s[c, :-1], s[c, 1:] + np.log(np.where(stay[1:] > 0, stay[1:], 1)) + np.where(stay[1:] > 0, 0, -np.inf))
    return s


_tables: dict[float, np.ndarray] = {}


def seat(count: np.ndarray, rho: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each of `count` customers, P(t) ~ S(count, t) rho^t; rho: weight of a new table."""
    if d not in _tables:
        _tables[d] = stirling(d)
    s, t = _tables[d], np.minimum(count, 1).astype(np.int64)
    for c in range(2, EXACT + 1):
        rows = np.flatnonzero(count == c) if c < EXACT else np.flatnonzero(count >= c)
        for a in range(0, len(rows), 1 << 15):
            r = rows[a : a + (1 << 15)]
            w = s[c, 1 : c + 1] + np.log(rho[r])[:, None] * np.arange(1, c + 1)
            w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), 1)
            t[r] = 1 + (w < (rng.random(len(r)) * w[:, -1])[:, None]).sum(1)
    rows = np.flatnonzero(count > EXACT)
    at, left = np.full(len(rows), EXACT), count[rows].astype(np.int64) - EXACT
    while len(rows):
        some = np.minimum(left, np.maximum(at // 8, 1))
        t[rows] += rng.binomial(some, rho[rows] / (rho[rows] + at - d * t[rows]))
        at, left = at + some, left - some
        on = left > 0
        rows, at, left = rows[on], at[on], left[on]
    return t


class Sums:
    """What a shard knows of others: customers and tables of its contexts, all customers and tables of single words, and
    hot words' sums."""

    def __init__(self, customers: np.ndarray, hot: np.ndarray, vocabulary: float, train_tokens: float):
        self.hot, self.v, self.n = hot, vocabulary, train_tokens
        self.hot_customers = self.hot_count = np.zeros(len(hot))
        self.c1, self.t1 = max(train_tokens * 0.3, 1.0), max(vocabulary, 1.0)
        self.local(customers, customers * 0.3)

    def local(self, customers: np.ndarray, tables: np.ndarray) -> Sums:
        self.customers, self.tables = customers.astype(float), tables.astype(float)
        return self


class Shard:
    """Types of a shard with their state."""

    def __init__(self, types: bytes, sums: Sums):
        self.word, many, self.context, self.count = _unpack(types)
        self.of, self.sums = np.repeat(np.arange(len(self.word)), many), sums
        self.context = self.context.astype(np.int64)
        self.word_count = np.bincount(self.of, self.count, len(self.word)) if len(self.word) else np.zeros(0)
        at = np.minimum(np.searchsorted(sums.hot, self.word), max(len(sums.hot) - 1, 0)) if len(sums.hot) else np.zeros(len(self.word), np.int64)
        self.is_hot = sums.hot[at] == self.word if len(sums.hot) else np.zeros(len(self.word), bool)
        self.hot_at = at
        self.known = np.where(self.is_hot, sums.hot_count[at], self.word_count) if len(sums.hot) else self.word_count
        self.customers = np.minimum(self.word_count, np.bincount(self.of, self.count > 0, len(self.word)))
        self.tables = np.zeros(len(self.count), np.int64)
        self.tables1 = np.minimum(self.customers, 1)
        self.p1 = self.parent()

    def all_customers(self) -> np.ndarray:
        s = self.sums
        return np.where(self.is_hot & (s.hot_customers[self.hot_at] > 0), s.hot_customers[self.hot_at], self.customers) if len(s.hot) else self.customers

    def parent(self) -> np.ndarray:
        s = self.sums
        return (np.maximum(self.all_customers() - D_WORD * self.tables1, 0) + (T_WORD + D_WORD * s.t1) / (s.v + 1)) / (T_WORD + s.c1)

    def draw(self, rng: np.random.Generator) -> None:
        """One sweep: tables of all types given the parent, then the parent's tables."""
        s = self.sums
        rho = (T_CONTEXT + D_CONTEXT * s.tables[self.context]) * self.p1[self.of]
        self.tables = seat(self.count, rho, D_CONTEXT, rng)
        self.customers = np.bincount(self.of, self.tables, len(self.word))
        k = self.all_customers()
        self.tables1 = seat(k.astype(np.int64), np.full(len(k), (T_WORD + D_WORD * s.t1) / (s.v + 1)), D_WORD, rng)
        self.p1 = self.parent()

    def probability(self) -> np.ndarray:
        """Of each type's word in its context."""
        s, u = self.sums, self.context
        stay = np.maximum(self.count - D_CONTEXT * self.tables, 0)
        return (stay + (T_CONTEXT + D_CONTEXT * s.tables[u]) * self.p1[self.of]) / (T_CONTEXT + s.customers[u])

    def totals(self) -> np.ndarray:
        s, hot = self.sums, self.is_hot
        plain = ~hot
        h = [np.bincount(self.hot_at[hot], x[hot], len(s.hot)) for x in (self.customers, self.word_count)] if len(s.hot) else []
        tables1 = self.tables1[plain].sum()
        return np.concatenate([np.bincount(self.context, self.tables, len(s.customers)), [self.customers.sum(), tables1, (self.word_count[plain] > 0).sum()], *h])


_PASS = "kind int, key long, shard int, payload binary, value double"


def _messages(shard: int, contexts: np.ndarray, groups: int, tables: np.ndarray, customers: np.ndarray):
    """Rows (0, group, shard, payload, 0) of a shard's sums by context; contexts stand by group."""
    group = group_of(contexts, groups)
    edge = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    rows = [(0, int(group[a]), shard, _pack(contexts[k : min(k + CONTEXTS, z)], tables[k : min(k + CONTEXTS, z)].astype(np.uint32), customers[k : min(k + CONTEXTS, z)].astype(np.uint32)), 0.0) for a, z in zip(edge[:-1], edge[1:]) for k in range(a, z, CONTEXTS)]
    for k in range(0, len(rows), 64):
        yield _batch(rows[k : k + 64])


def _batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["kind", "key", "shard", "payload", "value"])


@tidy
def _totals(batches):
    """Answers (shard, first context, payload) to messages: tables and customers of the same contexts over all shards."""
    groups: dict[int, list] = {}
    for b in batches:
        for group, shard, payload in zip(*(b.column(k).to_pylist() for k in range(3))):
            groups.setdefault(group, []).append((shard, payload))
    for group in list(groups):
        got = [(shard, *_unpack(p)) for shard, p in groups.pop(group)]
        ctx, inverse = np.unique(np.concatenate([x[1] for x in got]), return_inverse=True)
        sums = [np.bincount(inverse, np.concatenate([x[k] for x in got]), len(ctx)) for k in (2, 3)]
        at, rows = 0, []
        for shard, mine, *_ in got:
            k = inverse[at : at + len(mine)]
            at += len(mine)
            rows.append((shard, group, int(mine[0] >> np.uint64(1)), _pack(*(x[k].astype(np.float64) for x in sums))))
        for k in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 64]), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["shard", "key", "first", "payload"])


def score(docs: DataFrame, train: Column, seed: int = 3) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for each row of docs (doc_id, text).

    The model learns from rows where `train` holds. Tokens are words between blanks, A-Z lower-cased, and one
    end; null and empty texts are the end alone. base_score adds log10((c + 0.1) / (N + 0.1 (V + 1))) over
    tokens, score the model's log10 probabilities. Null and repeated ids are rows like others. With nothing to
    learn from, every word is unknown. An empty table gives no row. Other columns are ignored.
    """
    spark = docs.sparkSession
    shards = parts(spark, text_bytes(docs), SHARD)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    often = text.select("text").mapInArrow(lambda bs: _frequent(bs, shards), "word long, n long, all long")
    often = table(often.groupBy("word").agg(F.sum("n").alias("n"), F.sum("all").alias("all")))
    total = often.agg(F.sum("all")).first()[0] or 0
    many = sorted((r["word"] % (1 << 64), r["n"]) for r in often.where(F.col("n") * 4 * shards >= total).collect())  # 4 * shards words at most
    hot = np.array([w for w, _ in many], np.uint64)
    spread = np.array([-(-n * 4 * shards // total) for _, n in many], np.uint64)

    groups = parts(spark, 4 * math.isqrt(shards), 1)
    sent = text.mapInArrow(lambda bs: _send(bs, shards, hot, spread), "shard int, kind int, chunk long, payload binary, tokens binary")
    merged = sent.repartitionById(shards, "shard").mapInArrow(lambda bs: _merge(bs, groups), "shard int, kind int, chunk long, types binary, contexts binary, tokens binary")
    kept = bucketed(merged, "shard", shards)
    drop_table(often)

    def passed(f, answers: DataFrame | None, sql: str, *more: str) -> DataFrame:
        """f over shards (shard, types, contexts, *more, totals), which stay where they are; answers are gathered by shard."""
        rows = kept.where("kind = 0").select("shard", "types", "contexts", *more)
        if answers is None:
            return rows.withColumn("totals", F.lit(None).cast("array<struct<key:bigint,first:bigint,payload:binary>>")).mapInArrow(f, sql)
        mine = answers.groupBy(F.col("shard").alias("of")).agg(F.array_sort(F.collect_list(F.struct("key", "first", "payload"))).alias("totals"))
        return rows.join(mine, F.col("shard") == F.col("of")).drop("of").mapInArrow(f, sql)

    def ready(types, contexts: int, totals, sums: Sums) -> Shard:
        if totals is None:
            return Shard(types, sums.local(np.zeros(contexts), np.zeros(contexts)))
        both = [_unpack(x["payload"]) for x in totals]
        customers = np.concatenate([x[1] for x in both])
        tables = np.concatenate([x[0] for x in both])
        return Shard(types, sums.local(customers, tables if tables.any() else customers * 0.3))

    answers, sums = None, Sums(np.zeros(0), hot, 0.0, 0.0)
    for sweep in range(BURN_IN + 1):
        # the first pass only counts: customers of contexts, known words, and hot ones
        @tidy
        def swept(batches, sums=sums, sweep=sweep):
            for b in batches:
                for shard, types, contexts, totals in zip(*(c.to_pylist() for c in b.columns)):
                    (ctx,) = _unpack(contexts)
                    s = ready(types, len(ctx), totals, sums)
                    if sweep:
                        s.draw(np.random.default_rng((seed, sweep, shard)))
                    got = s.totals()
                    yield from _messages(shard, ctx, groups, got[: len(ctx)] if sweep else np.zeros(len(ctx)), np.bincount(s.context, s.count, len(ctx)))
                    rest = got[len(ctx) :]
                    some = [(k, v) for k, v in enumerate([*rest[:3], s.count.sum(), *rest[3:]]) if v]
                    if some:
                        yield _batch([(1, k, shard, None, float(v)) for k, v in some])

        out = table(passed(swept, answers, _PASS))
        number = dict(out.where("kind = 1").groupBy("key").agg(F.sum("value")).collect())  # 4 numbers, and 2 for each hot word
        last, n, h = sums, number.get(3, 0.0), len(hot)
        sums = Sums(np.zeros(0), hot, number.get(2, 0.0), n)
        sums.hot_customers, sums.hot_count = (np.array([number.get(4 + at + k, 0.0) for k in range(h)]) for at in (0, h))
        sums.v += (sums.hot_count > 0).sum()
        if sweep:
            sums.c1, sums.t1 = number.get(0, 0.0), number.get(1, 0.0)
            if h:  # tables of hot words in the parent, given all their customers
                rho = (T_WORD + D_WORD * last.t1) / (sums.v + 1)
                sums.t1 += seat(sums.hot_customers.astype(np.int64), np.full(h, rho), D_WORD, np.random.default_rng((seed, sweep))).sum()
        else:
            sums.t1 = max(sums.v, 1.0)
        before, answers = answers, table(out.where("kind = 0").select("key", "shard", "payload").repartition(groups, "key").mapInArrow(_totals, "shard int, key long, first long, payload binary"))
        drop_table(out, *([before] if before is not None else []))
    base = np.log10(sums.n + 0.1 * (sums.v + 1)) if sums.n + sums.v else np.log10(0.1)
    drawn = sums

    @tidy
    def scored(batches):
        for b in batches:
            for shard, types, toks, totals in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4))):
                s = ready(types, 0, totals, drawn)
                rng, p = np.random.default_rng((seed, 99, shard)), np.zeros(len(s.count))
                for _ in range(SAMPLES):
                    s.draw(rng)
                    p += s.probability()
                log_p, count = np.log10(p / SAMPLES).astype(np.float32), s.known.astype(np.int64)
                chunk, size, type_ = _unpack(toks)
                at = 0
                for c, n in zip(chunk.tolist(), size.tolist()):
                    k = type_[at : at + n]
                    at += n
                    w = s.of[k]
                    first = np.flatnonzero(np.diff(w, prepend=-1))
                    yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([shard], pa.int32()), pa.array([_pack(log_p[k], np.diff(np.append(first, n)).astype(np.uint32), count[w[first]])], pa.binary()), pa.array([None], pa.binary())], ["chunk", "shard", "payload", "tokens"])

    @tidy
    def joined(batches):
        chunks: dict[int, list] = {}
        for b in batches:
            for c, shard, payload, toks in zip(*(x.to_pylist() for x in b.columns)):
                chunks.setdefault(c, []).append((shard, payload, toks))
        n = int(drawn.n)
        for c in list(chunks):
            (_, facts_, toks), *answers_ = sorted(chunks.pop(c), key=lambda x: x[0])
            doc_id, null, train_, n_tokens = _unpack(facts_)
            many, doc = _unpack(toks)
            got = [_unpack(p) for _, p, _ in answers_]
            log_p = np.repeat(np.concatenate([x[0] for x in got]).astype(np.float64), many)
            count = np.repeat(np.concatenate([np.repeat(x[2], x[1]) for x in got]), many)
            add = lambda x: np.bincount(doc, x, len(doc_id))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_id, mask=null), pa.array(train_), pa.array(n_tokens), pa.array(add(count > 0).astype(np.int64)), pa.array(np.full(len(doc_id), n)), pa.array(add(np.log10(count + 0.1)) - n_tokens * base), pa.array(add(log_p))],
                ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    each = passed(scored, answers, "chunk long, shard int, payload binary, tokens binary", "tokens")
    facts = kept.where("kind = 1").select("chunk", F.lit(-1).alias("shard"), F.col("types").alias("payload"), "tokens")
    return each.unionAll(facts).repartition(shards, "chunk").mapInArrow(joined, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
