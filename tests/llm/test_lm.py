"""The language model against a sequential sampler, and its sums over many shards."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import lm, util


class Restaurant:
    """Tables of one restaurant, by dish, with their customers; one customer at a time."""

    def __init__(self, d, theta):
        self.d, self.theta, self.tables, self.customers = d, theta, collections.defaultdict(list), 0

    def n_tables(self):
        return sum(map(len, self.tables.values()))

    def p(self, dish, parent):
        t = self.tables.get(dish, [])
        return (sum(t) - self.d * len(t) + (self.theta + self.d * self.n_tables()) * parent) / (self.theta + self.customers)

    def sit(self, dish, parent, rng):
        """Whether the customer opens a table."""
        t = self.tables[dish]
        weights = [n - self.d for n in t] + [(self.theta + self.d * self.n_tables()) * parent]
        at = rng.choices(range(len(weights)), weights)[0]
        self.customers += 1
        if at == len(t):
            t.append(1)
            return True
        t[at] += 1
        return False

    def leave(self, dish, rng):
        """Whether a table closes."""
        t = self.tables[dish]
        at = rng.choices(range(len(t)), t)[0]
        t[at] -= 1
        self.customers -= 1
        if not t[at]:
            del t[at]
            return True
        return False


def sequential(texts, sweeps, burn, seed=0):
    """Averaged log10 probability of each text by Gibbs sampling of single customers."""
    rng = random.Random(seed)
    pairs = [[(["<s>", *t][k], w) for k, w in enumerate([*t, "</s>"])] for t in texts]
    v = len({w for p in pairs for _, w in p})
    top = Restaurant(lm.D_WORD, lm.T_WORD)
    rest = collections.defaultdict(lambda: Restaurant(lm.D_CONTEXT, lm.T_CONTEXT))
    p1 = lambda w: top.p(w, 1 / (v + 1))
    flat = [x for p in pairs for x in p]
    total = np.zeros(len(flat))
    for sweep in range(sweeps):
        for u, w in flat:
            if sweep and rest[u].leave(w, rng):
                top.leave(w, rng)
            if rest[u].sit(w, p1(w), rng):
                top.sit(w, 1 / (v + 1), rng)
        if sweep >= burn:
            total += [rest[u].p(w, p1(w)) for u, w in flat]
    logs = np.log10(total / (sweeps - burn))
    ends = np.cumsum([len(p) for p in pairs])
    return np.diff(np.concatenate([[0], np.cumsum(logs)[ends - 1]])), np.array([len(p) for p in pairs])


def test_scores_of_a_sequential_sampler(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    follow = {w: rng.sample(words, 4) for w in words}
    texts = []
    for _ in range(50):
        t = [rng.choice(words)]
        while len(t) < 30:
            t.append(rng.choice(follow[t[-1]]) if rng.random() < 0.7 else rng.choice(words))
        texts.append(t)
    want, n = sequential(texts, 60, 20)
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score(df, F.lit(True)).collect()}
    score = np.array([got[k].score for k in range(len(texts))])
    base = np.array([got[k].base_score for k in range(len(texts))])
    assert np.abs(score - want).mean() / n.mean() < 0.03  # log10 a token, by three draws
    assert abs(score.sum() / want.sum() - 1) < 0.03 and np.corrcoef(score, want)[0, 1] > 0.95
    assert abs(base.sum() / want.sum() - 1) > 0.1  # a model of single words is far off


def test_one_model_however_many_shards(spark, monkeypatch):
    """Sums of contexts meet over shards, groups and hot words: the probabilities are close whatever the number of parts."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join("the" if rng.random() < 0.3 else rng.choice(words) for _ in range(40))) for k in range(200)]
    df = util.table(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    train = util.fold("doc_id", 10) != 0
    one = {r.doc_id: r for r in lm.score(df, train).collect()}
    monkeypatch.setattr(lm, "SHARD", 2000)
    monkeypatch.setattr(lm, "GATHER", 5000)
    many = {r.doc_id: r for r in lm.score(df, train).collect()}
    assert len(one) == len(many) == 200
    for k, r in one.items():
        s = many[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (s.n_tokens, s.n_known, s.train_tokens) and r.base_score == pytest.approx(s.base_score)
        assert abs(r.score - s.score) / r.n_tokens < 0.05 and math.isfinite(s.score)
    assert sum(r.score for r in many.values()) == pytest.approx(sum(r.score for r in one.values()), rel=0.01)


def test_contexts_do_not_collide():
    """More contexts than any fixed number of places: each keeps its own sums."""
    ctx = util.mix(np.arange(1, 200_001, dtype=np.uint64))
    ctx = ctx[np.lexsort((ctx, lm.group_of(ctx, 7)))]
    tables = np.arange(len(ctx))
    out = []
    for half in (slice(0, None, 2), slice(1, None, 2), slice(None)):
        out += [r for b in lm._messages(1, ctx[half], 7, tables[half], tables[half] * 2) for r in b.to_pylist()]
    by_group = collections.defaultdict(list)
    for r in out:
        by_group[r["key"]].append(r)
    seen = 0
    import pyarrow as pa

    for rows in by_group.values():
        batch = pa.RecordBatch.from_pylist([{"key": r["key"], "shard": r["shard"], "payload": r["payload"]} for r in rows])
        answers = [a for b in lm._totals(iter([batch])) for a in b.to_pylist()]
        for r, a in zip(rows, answers):
            mine, t, c = lm._unpack(r["payload"])
            total, customers = lm._unpack(a["payload"])
            assert (total == 2 * t).all() and (customers == 2 * c).all() and len(total) == len(mine)
            seen += len(mine)
    assert seen == 400_000
