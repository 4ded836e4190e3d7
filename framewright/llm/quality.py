"""Quality classifier: a factorisation machine over hashed words and structure statistics of texts.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]): all pairs of features
interact through vectors of RANK numbers, in time linear in the features. The features are the text's words,
hashed, what can be counted about it (length, marks, capitals, repeats, lines), and of the metadata n_chars, the
one column that may be an input; it is counted from the text, so a table without it, or with a stale one, scores alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import alnum_table, drop_table, slices, table, words

WORD_BITS, RANK, BINS = 17, 8, 16
#: Labelled rows, and bytes of their features, that the model is fitted on at most; of more, those of least xxhash64(doc_id).
TRAIN_ROWS, TRAIN_BYTES = 20_000, 64 << 20
EPOCHS, BATCH, RATE, DECAY, SEED = 6, 256, 0.08, 1e-5, 7
_TABLE = alnum_table()
STATS = ("bytes", "words", "word_length", "capitals", "digits", "marks", "kinds_of_marks", "high_bytes", "distinct", "repeats", "most_frequent", "lines", "line_length", "blank", "pairs", "capital_runs", "n_chars")
SIZE = (1 << WORD_BITS) + len(STATS) * BINS


@dataclass
class Model:
    """Weights of the machine; SIZE bounds it whatever the corpus (about 5 MB)."""

    bias: float
    w: np.ndarray
    v: np.ndarray

    def score(self, index: np.ndarray, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        z = np.full(len(first) - 1, self.bias, np.float64)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            at = first[:-1][some]
            vx = self.v[index] * x[:, None]
            total = np.add.reduceat(vx, at)
            z[some] += np.add.reduceat(self.w[index] * x, at) + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx * vx).sum(1), at))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, values, offsets by text) of texts given as bytes. Empty texts have statistics only."""
    n = len(bounds) - 1
    h, starts, first = words(data, bounds, _TABLE)
    size, many = np.diff(bounds).astype(float), np.diff(first).astype(float)
    text = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    key = text << np.uint64(WORD_BITS) | h >> np.uint64(64 - WORD_BITS)
    pair, count = np.unique(key, return_counts=True)
    of, word = (pair >> np.uint64(WORD_BITS)).astype(np.int64), (pair & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    value = np.log1p(count).astype(np.float32)
    norm = np.sqrt(np.bincount(of, value * value, n))
    value /= np.maximum(norm[of], 1e-9).astype(np.float32)

    def per(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (c[bounds[1:]] - c[bounds[:-1]]).astype(float)

    upper = (data >= 65) & (data <= 90)
    letter = upper | (data >= 97) & (data <= 122) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    blank = (data <= 32)
    mark = ~(letter | digit | blank)
    runs = np.zeros(len(data), bool)
    runs[1:] = upper[1:] & upper[:-1]
    kinds = np.zeros(n)
    if len(data):
        at = np.flatnonzero(mark)
        seen = np.unique(np.searchsorted(bounds, at, "right").astype(np.int64) * 128 + data[at])
        kinds = np.bincount(seen // 128 - 1, minlength=n).astype(float)[:n]
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    twice = np.zeros(len(h), bool)
    twice[2:] = (h[2:] == h[:-2]) & (text[2:] == text[:-2])
    top = np.zeros(n)
    np.maximum.at(top, of, count)
    over = lambda a, b: a / np.maximum(b, 1)
    lines = per(data == 10) + 1
    fraction = lambda v: np.minimum(np.floor(np.sqrt(np.clip(v, 0, 1)) * BINS), BINS - 1)
    logs = lambda v: np.minimum(np.floor(np.log2(1 + v)), BINS - 1)
    stats = [
        logs(size), logs(many), np.minimum(over(per(letter), many), BINS - 1), fraction(over(per(upper), per(letter))), fraction(over(per(digit), size)),
        fraction(over(per(mark), size)), np.minimum(kinds, BINS - 1), fraction(over(per(data >= 128), size)), fraction(over(np.bincount(of, minlength=n)[:n], many)),
        fraction(over(np.bincount(text.astype(np.int64), same, n), many)), fraction(over(top, many)), logs(lines), logs(size / lines), fraction(over(per(blank), size)),
        fraction(over(np.bincount(text.astype(np.int64), twice, n), many)), fraction(over(per(runs), per(letter))),
        logs(per((data & 0xC0) != 0x80)),
    ]
    k = len(STATS)
    number = np.stack([(1 << WORD_BITS) + i * BINS + np.floor(s).astype(np.int64) for i, s in enumerate(stats)], 1)
    per_text = np.bincount(of, minlength=n)[:n] + k
    offsets = np.concatenate([[0], np.cumsum(per_text)])
    index, x = np.empty(offsets[-1], np.int32), np.empty(offsets[-1], np.float32)
    at = np.arange(len(of)) + of * k  # words come after the k statistics of each text so far
    index[at], x[at] = word, value
    last = (offsets[1:, None] - k) + np.arange(k)
    index[last], x[last] = number, 0.5
    return index, x, offsets


def fit(index: np.ndarray, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> Model:
    """Adagrad over log loss, in batches, on rows given as in features()."""
    rng = np.random.default_rng(SEED)
    rate = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    m = Model(float(np.log(rate / (1 - rate))), np.zeros(SIZE, np.float32), rng.normal(0, 0.05, (SIZE, RANK)).astype(np.float32))
    gw, gv, gb = np.full(SIZE, 1e-3, np.float32), np.full((SIZE, RANK), 1e-3, np.float32), 1e-3
    for _ in range(EPOCHS if len(y) else 0):
        order = rng.permutation(len(y))
        for s in range(0, len(y), BATCH):
            rows = order[s : s + BATCH]
            n = (first[rows + 1] - first[rows]).astype(np.int64)
            begin = np.cumsum(n) - n
            at = np.arange(n.sum()) + np.repeat(first[rows] - begin, n)
            i, xi = index[at], x[at]
            vx = m.v[i] * xi[:, None]
            total = np.add.reduceat(vx, begin)
            z = m.bias + np.add.reduceat(m.w[i] * xi, begin) + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx * vx).sum(1), begin))
            g = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows]) / len(rows)).astype(np.float32)
            each = np.repeat(g, n)
            grad = np.concatenate([(each * xi)[:, None], (each * xi)[:, None] * (np.repeat(total, n, 0) - vx)], 1)
            o = np.argsort(i, kind="stable")
            si = i[o]
            new = np.flatnonzero(np.diff(si, prepend=-1))
            u, grad = si[new], np.add.reduceat(grad[o], new)
            grad[:, 0] += DECAY * m.w[u]
            grad[:, 1:] += DECAY * m.v[u]
            gw[u] += grad[:, 0] ** 2
            gv[u] += grad[:, 1:] ** 2
            m.w[u] -= RATE * grad[:, 0] / np.sqrt(gw[u])
            m.v[u] -= RATE * grad[:, 1:] / np.sqrt(gv[u])
            gb += g.sum() ** 2
            m.bias -= RATE * float(g.sum() / np.sqrt(gb))
    return m


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of labels (doc_id, quality) over the texts of docs (doc_id, text).

    Null ids and null qualities are left out, of repeated ids the least quality counts. Without a row the
    model gives every text the prior 0.5. At most `rows` rows and TRAIN_BYTES reach one place, as features.
    """
    sample = (
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
        .withColumn("at", F.xxhash64("doc_id")).orderBy("at", "doc_id").limit(rows)
    )
    mine = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id").select("at", "y", "text")

    def run(batches):
        for b in batches:
            for i, j, data, bounds in slices(b, "text"):
                index, x, first = features(data, bounds)
                cut = [slice(a, z) for a, z in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array([index[c].tobytes() for c in cut], pa.binary()), pa.array([x[c].astype(np.float16).tobytes() for c in cut], pa.binary())], ["at", "y", "index", "x"])

    made = table(mine.mapInArrow(run, "at long, y int, index binary, x binary"))
    sizes = sorted(tuple(r) for r in made.select("at", F.octet_length("index") + F.octet_length("x")).collect())
    fits = int(np.searchsorted(np.cumsum([n for _, n in sizes]), TRAIN_BYTES, "right"))
    got = sorted(tuple(r) for r in (made.where(F.col("at") <= sizes[fits - 1][0]) if fits else made.limit(0)).collect())
    drop_table(made)
    index = np.concatenate([np.frombuffer(r[2], np.int32) for r in got]) if got else np.zeros(0, np.int32)
    x = np.concatenate([np.frombuffer(r[3], np.float16) for r in got]).astype(np.float32) if got else np.zeros(0, np.float32)
    first = np.cumsum([0, *(len(r[2]) // 4 for r in got)])
    return fit(index, x, first, np.array([r[1] > 0 for r in got], np.float32))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with a double column `name` (replaced if there): the chance of label 1. Null text is scored as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(text: pa.Array) -> pa.Array:
        got = [shared.value.score(*features(data, bounds)) for _, _, data, bounds in slices(pa.RecordBatch.from_arrays([text], ["t"]), "t")]
        return pa.array(np.concatenate(got) if got else np.zeros(0))

    return docs.withColumn(name, run(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def keep(docs: DataFrame, model: Model, least: float = 0.7) -> DataFrame:
    """docs whose score is `least` or more; columns as they are."""
    name = "__score"
    while name in docs.columns:
        name += "_"
    return score(docs, model, name).where(F.col(name) >= least).drop(name)
