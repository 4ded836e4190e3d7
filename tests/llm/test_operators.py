"""The ten operators against brute force, exact round trips or held-out accuracy, on small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from framewright.llm import bpe, decontaminate, embeddings, graph, html, jaccard, lm, packing, quality, queries, secrets, suffixes, tokens, util

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def docs(sf):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(util.tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4"))


# 1 -----------------------------------------------------------------------------------------------


def test_quality_held_out(spark, docs):
    """On labels of sf0.1: rank and decisions on rows the model never saw."""
    sf = "/root/testdata/sf0.1"
    rows = queries.op1_quality(spark, sf).collect()
    y = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    assert len(rows) == pq.read_table(f"{sf}/documents.parquet").num_rows
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.score, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    good, bad = [s for s, v in held if v], [s for s, v in held if not v]
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert np.mean([s >= 0.7 for s in good]) > 0.97 and np.mean([s >= 0.7 for s in bad]) < 0.05


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    m = quality.Model(0.3, rng.normal(size=quality.SIZE).astype(np.float32), rng.normal(0, 0.1, (quality.SIZE, quality.RANK)).astype(np.float32))
    index, x = np.array([5, 9, 70, 5000]), np.array([0.5, 1, 0.2, 0.7], np.float32)
    z = 0.3 + sum(m.w[i] * v for i, v in zip(index, x)) + sum(float(m.v[index[a]] @ m.v[index[b]]) * x[a] * x[b] for a in range(4) for b in range(a))
    assert m.score(index, x, np.array([0, 4, 4])) == pytest.approx([1 / (1 + math.exp(-z)), 1 / (1 + math.exp(-0.3))], rel=1e-4)


# 2 -----------------------------------------------------------------------------------------------


def test_decontaminate_sql(spark, sf):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.op2_decontaminate(spark, sf)
    got = c.sql(queries.SQL["op2_decontaminate"])
    assert sorted(map(tuple, df.select(*got.columns).collect())) == sorted(got.fetchall())


def test_matches_are_longest(spark):
    item = "a b c d e f g h i j k l"
    text = "x A, b c d e f g h i j! z a b c d e f g h i j k l l a b c d e f g"
    d = spark.createDataFrame([(1, text), (2, "q r"), (3, "")], "doc_id long, text string")
    b = spark.createDataFrame([(1, item), (2, "q r"), (3, None), (4, "!!")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find(d, b).collect()}
    assert {tuple(m) for m in got[1].matches} == {("1", 0, 1, 10), ("1", 0, 12, 12)}
    assert (got[1].n_words, got[1].n_hit, got[1].items) == (32, 22, ["1"])
    assert (got[2].n_hit, got[2].items) == (2, ["2"]) and got[3].n_words == 0
    assert {r.doc_id for r in decontaminate.decontaminate(d, b, 1).collect()} == {3}


def test_benchmark_in_passes(spark, sf, monkeypatch):
    d, b = util.read(spark, sf, "documents"), util.read(spark, sf, "benchmark")
    cols = ("doc_id", "n_words", "n_hit", "items")
    one = sorted(map(str, decontaminate.find(d, b, ["doc_id"]).select(*cols).collect()))
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 4000)
    assert sorted(map(str, decontaminate.find(d, b, ["doc_id"]).select(*cols).collect())) == one


# 3 -----------------------------------------------------------------------------------------------


def test_pieces_encode_as_texts(tokenizer, docs):
    odd = ["", " a", "a  b", "a\n b", "a \nb", "x <|endoftext|> y", "a b ", "\x00 z", "don't we'll 12 3a", "é è  x", "日本 語", "a\tb c", "it's, ab' 'll b'll x_y __ a.,b c...", "²³ x² a½ ٣x aͅb", "a" * 5000, "  \x1c x"]
    texts = odd + [t for _, t in docs[:80]]
    enc = bpe.Encoder(util.tokenizer_path(), most=3000)
    assert [x.tolist() for x in enc.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 255, 256, 257, 20_000])
def test_huffman_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 50_000).astype(np.uint16)
    lengths = tokens.code_lengths(np.bincount(ids, minlength=50_257))
    payload, marks = tokens.pack(ids, lengths, tokens.codes_of(lengths))
    assert np.array_equal(tokens.Decoder(lengths).decode(payload, marks, n), ids)
    assert lengths.max() <= tokens.LIMIT


def test_code_lengths_are_least():
    """Without the limit in the way, as short as Huffman's; with it, within it and complete."""
    import heapq

    counts = np.array([int(1.6**k) for k in range(30)])
    heap, total = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    assert int((tokens.code_lengths(counts, 29).astype(int) * counts).sum()) == total
    short = tokens.code_lengths(counts, 6)
    assert short.max() == 6 and sum(2.0 ** -int(x) for x in short) == 1


def test_token_files(spark, sf, tokenizer, docs):
    start, want = 0, []
    for d, t in sorted(docs):
        ids = ids_of(tokenizer, t)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, queries.op3_token_ids(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


# 4 -----------------------------------------------------------------------------------------------

BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("password|passwd|secret|token|api_?key", "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")))), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def base_spans(text):
    found = [(m.start(), n, m.end()) for n, (_, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return [f"{BASE[n][0]}:{s}:{e}" for s, n, e in sorted(found)]


def test_secrets(spark):
    sf = "/root/testdata/sf0.01"  # the smallest table with secrets
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    got = {r.doc_id: r for r in queries.op4_secrets(spark, sf).collect()}
    assert len(got) == len(docs) and sum(r.n_assign + r.n_access + r.n_hex for r in got.values()) > 0
    for d, t in docs:
        base = base_spans(t)
        assert got[d].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[d].n_assign, got[d].n_access, got[d].n_hex] == [sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")]
        assert set(base) <= set(got[d].spans.split(",")) or not base


def test_base_rules_on_odd_texts():
    rng = random.Random(6)
    parts = ["token", "API_KEY", "apikey", "passwd", "Secret", ":", "=", " ", '"', "'", "abc", "0f" * 12, "AKIA", "X9" * 9, "é", "ſ", "K", "-", ".", "\n", "f" * 23]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert [f"{secrets.RULES[k][0]}:{s}:{e}" for s, k, e in secrets.spans_of(text) if k < secrets.BASE] == base_spans(text)


def test_ledger_scans_once(spark, tmp_path):
    key = "AKIA" + "A1" * 8
    one = spark.createDataFrame([(1, f"x {key}"), (2, f"x {key}"), (3, "clean"), (4, None)], "doc_id long, text string")
    path = str(tmp_path / "ledger")
    assert {r.doc_id: r.n_access for r in secrets.scan(one, path).collect()} == {1: 1, 2: 1, 3: 0, 4: 0}
    assert spark.read.parquet(path).count() == 3
    assert secrets.scan_unseen(one, spark.read.schema(secrets.LEDGER).parquet(path)).count() == 0
    two = one.union(spark.createDataFrame([(5, "TOKEN = abcdef"), (6, f"x {key}")], one.schema))
    assert {r.doc_id: r.spans for r in secrets.scan(two, path).collect()}[5] == "assign:0:14"
    assert spark.read.parquet(path).count() == 4
    assert {r.doc_id: r.text for r in secrets.redact(two, path).collect()} == {1: "x [secret]", 2: "x [secret]", 3: "clean", 4: None, 5: "[secret]", 6: "x [secret]"}


# 5 -----------------------------------------------------------------------------------------------


def test_embeddings_cells(spark, monkeypatch):
    """Many small cells and blocks lose no link."""
    monkeypatch.setattr(embeddings, "CELL_ROWS", 25)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8))
    x = (centres[rng.integers(0, 40, 400)] + rng.normal(0, 0.25, (400, 8))).astype(np.float32)
    x[10] = x[11] = x[12]
    rows = [(k, x[k].tolist(), int(k % 3) if k % 50 else None) for k in range(400)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 8, 1), (403, [float("nan")] * 8, 1), (404, [1.0, None], 1), (405, [float("inf")] * 8, 1), (406, x[1].tolist()[:4], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = (u @ u.T >= 0.93) & np.array([[a[2] is not None and a[2] == b[2] for b in rows[:400]] for a in rows[:400]])
    np.fill_diagonal(link, False)
    root = graph.roots(400, *np.nonzero(link))
    for k in range(400):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (link[k].sum(), root[k], root[k] == k)
    assert all((got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True) for k in range(400, 407))
    assert link.sum() > 100


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, 5000)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    part = {k: k for p in pairs for k in p}

    def find(k):
        while part[k] != k:
            k = part[k]
        return k

    for a, b in pairs:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    assert {k: r for k, r in got.items() if k != r} == {k: find(k) for k in part if find(k) != k}


# 6 -----------------------------------------------------------------------------------------------


def test_lm_base_and_gain(spark, sf, docs):
    got = {r.doc_id: r for r in queries.op6_lm(spark, sf).collect()}
    words = {d: [*(t or "").encode().lower().split(), b" end"] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    c = collections.Counter(w for d, ws in words.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    for d, ws in words.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)
    assert sum(got[d].score for d in words if held[d]) > 1.0 * sum(got[d].base_score for d in words if held[d])
    assert all(r.score < 0 for r in got.values())


def test_seats_follow_their_distribution():
    """Drawn numbers of tables against those of all orders of seating, weighed by rho."""
    d, rho, c, rng = 0.8, 0.7, 6, np.random.default_rng(0)
    weight = {1: {1: 1.0}}
    for n in range(1, c):
        nxt = collections.Counter()
        for t, w in weight[n].items():
            nxt[t] += w * (n - d * t)
            nxt[t + 1] += w
        weight[n + 1] = nxt
    p = np.array([weight[c][t] * rho**t for t in range(1, c + 1)])
    drawn = np.bincount(lm.seat(np.full(40_000, c), np.full(40_000, rho), d, rng), minlength=c + 1)[1:]
    assert drawn / 40_000 == pytest.approx(p / p.sum(), abs=0.01)
    many = lm.seat(np.array([0, 1, 5000]), np.array([0.5, 0.5, 0.5]), d, rng)
    assert many[0] == 0 and many[1] == 1 and 1 < many[2] < 5000


def test_lm_is_a_distribution():
    """Probabilities of all words in a context, known and unknown, add up to one."""
    rng = np.random.default_rng(1)
    word = np.arange(1, 30, dtype=np.uint64)
    count = rng.integers(0, 5, (29, 4)).astype(np.uint32)
    count[:, 0] += 1
    types = lm._pack(word, np.full(29, 4, np.uint32), np.tile(np.arange(4, dtype=np.uint16), 29), count.ravel())
    customers = np.zeros(lm.CONTEXTS)
    customers[:4] = count.sum(0)
    sums = lm.Sums(customers, np.zeros(0, np.uint64), 29.0, count.sum())
    s = lm.Shard(types, sums)
    s.draw(rng)
    total = s.totals()
    sums.tables, (sums.c1, sums.t1, sums.v) = total[: lm.CONTEXTS], total[lm.CONTEXTS : lm.CONTEXTS + 3]
    s.p1 = s.parent()
    unknown = (lm.T_WORD + lm.D_WORD * sums.t1) / (sums.v + 1) / (lm.T_WORD + sums.c1)
    for u in range(4):
        back = (lm.T_CONTEXT + lm.D_CONTEXT * sums.tables[u]) / (lm.T_CONTEXT + customers[u])
        assert s.probability()[s.context == u].sum() + back * unknown == pytest.approx(1)


def test_lm_hot_words(spark):
    """A word with most of all tokens is spread over shards; its count stays whole."""
    rows = [(k, "the " * 200 + f"w{k} other") for k in range(60)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()
    n, v = 60 * 203, 63
    c = {"the": 60 * 200, "other": 60, "end": 60}
    want = 200 * math.log10((c["the"] + 0.1) / (n + 0.1 * (v + 1))) + 2 * math.log10(60.1 / (n + 0.1 * (v + 1))) + math.log10(1.1 / (n + 0.1 * (v + 1)))
    assert all(r.base_score == pytest.approx(want) and r.n_known == 203 for r in got) and len(got) == 60


# 7 -----------------------------------------------------------------------------------------------


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_classes(rows):
    sets = [shingle_set(t) for _, t in rows]
    n, part = [0] * len(rows), list(range(len(rows)))

    def find(k):
        while part[k] != k:
            k = part[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                n[a] += 1
                n[b] += 1
                x, y = find(a), find(b)
                part[max(x, y)] = min(x, y)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), d), d)
    return [(d, least[find(k)], n[k]) for k, (d, _) in enumerate(rows)]


def near_copies(n, size, seed=0):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(n)]
    out = []
    for k in range(size):
        w = list(base[k % n])
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = rng.choice(vocabulary)
        out.append((k, " ".join(w)))
    return out


def test_jaccard(spark, sf, docs):
    got = queries.op7_jaccard(spark, sf).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got)) == sorted(brute_classes(docs))


def test_jaccard_deep_buckets_and_blocks(spark, monkeypatch):
    """Large groups of near copies, split by all levels and compared in many blocks."""
    for name, v in (("SMALL", 8), ("BLOCK", 40), ("BLOCK_NODES", 16)):
        monkeypatch.setattr(jaccard, name, v)
    rows = near_copies(3, 240) + [(1000, ""), (1001, None), (1002, "!!"), (1003, "one two"), (1004, "One, two"), (1005, "one two three")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.join(df).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got)) == sorted(brute_classes(rows))


# 8 -----------------------------------------------------------------------------------------------


def brute_removed(rows, length=100):
    seen, out = set(), {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_array_order():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 500, 3000):
        for letters in (1, 2, 4, 256):
            t = rng.integers(0, letters, n).astype(np.uint8)
            sa, b = suffixes.suffix_array(t, 100), t.tobytes()
            assert sorted(sa.tolist()) == list(range(n))
            assert all(b[x : x + 100] <= b[y : y + 100] for x, y in zip(sa, sa[1:]))


def test_repeats(spark, sf, docs):
    rows = queries.op8_suffixes(spark, sf).collect()
    want = brute_removed(sorted(docs))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want and any(v[1] for v in want.values())


def test_repeats_of_periodic_and_shared_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 300)
    monkeypatch.setattr(suffixes, "ARRAY", 200)
    rng = random.Random(3)
    text = "".join(rng.choice("abc ") for _ in range(700))
    rows = [(0, "ab" * 400), (1, text), (2, "x" + text[50:400] + "é" * 90 + text[300:650]), (3, "a" * 250), (4, text[:99]), (5, text[:100]), (6, None), (7, ""), (8, "xab" * 40 + "ab" * 60)]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_removed(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


# 9 -----------------------------------------------------------------------------------------------


def check_packing(rows, tokenizer, docs, seq_len=1024):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for d, t in docs:
        ids, at = ids_of(tokenizer, t), 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= seq_len
    return sum(r.length for r in rows) / (seq_len * len(by_sequence))


def test_packing(spark, sf, tokenizer, docs):
    assert check_packing(queries.op9_packing(spark, sf).collect(), tokenizer, docs) > 0.97


def test_patterns_place_everything():
    rng = np.random.default_rng(2)
    counts = np.zeros(65, np.int64)
    counts[1:] = rng.integers(0, 50, 64)
    found = packing.patterns(counts, 64)
    placed = np.zeros(65, np.int64)
    for packs, lengths in found:
        assert sum(lengths) <= 64
        for n in lengths:
            placed[n] += packs
    assert np.array_equal(placed, counts)


# 10 ----------------------------------------------------------------------------------------------


def test_pages(spark, sf):
    """The article of every page, cut out by its tags."""
    import html as entities

    rows = {r.page_id: r for r in queries.op10_html(spark, sf).collect()}
    pages = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    assert len(rows) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p["html"], re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1|li|ul)>", article)]
        assert rows[p["page_id"]].text == "\n".join(b for b in blocks if b)
        assert rows[p["page_id"]].n_chars == len(rows[p["page_id"]].text)


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), ("<script>x</script>", ""), ("<p>only text", "only text"), ("plain &amp; more", "plain & more"),
        ("<article><header><h1>T</h1></header><p>Body &eacute;\n  x<br>y</p><aside>no</aside><form>f</form></article><section class='comments'><article><p>a long comment, a long comment</p></article></section>", "T\nBody é x y"),
        ("<div class='menu'><a href=1>a</a></div><main><h2>T</h2><p>Some long text that goes on and on.</p><p>short</p><div class='cookie-notice'>ok?</div></main><div class='sidebar'>x</div>", "T\nSome long text that goes on and on.\nshort"),
        ("<div id=w><div class='menu'><a>a</a></div><div><p>Some long text that goes on and on and on.</p><p>Another text that goes on.</p></div><div id='comments'><p>Reader, reader, reader, reader</p></div></div>", "Some long text that goes on and on and on.\nAnother text that goes on."),
        ("<article><p>One<p>Two<ul><li>a<li>b</ul><style>p{}</style></article>", "One\nTwo\na\nb"),
        ("<article><p>a <b>b</b>c</p><!-- no --><p hidden>h</p><p>x</p></article>", "a bc\nx"),
    ],
)
def test_page_kinds(page, want):
    assert html.main_text(page) == want
