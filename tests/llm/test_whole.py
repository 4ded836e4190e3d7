"""Cases in which an operator once did less than its whole job."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framewright.llm import decontaminate, embeddings, graph, html, jaccard, secrets, suffixes, util


def test_stage_removes_single_item_documents(spark, tmp_path):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"before it {item} and after"), (2, "three four five six seven eight nine TEN"), (3, "four five six seven eight nine ten and more"), (4, "clean"), (5, None)]
    spark.createDataFrame([(1, item), (2, "another item that no document has at all in it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.benchmark_passages(spark, docs, str(tmp_path)).collect()} == {3, 4, 5}


def test_jaccard_links_ties(spark):
    rows, want = [], {}
    # words of a pair: shared shingles, those of either text alone; every second pair is at 0.8, the others just below
    for k, (shared, one, other) in enumerate([(12, 1, 2), (12, 2, 2), (24, 2, 4), (24, 3, 4), (28, 3, 4), (28, 4, 4), (32, 8, 0), (32, 8, 1)]):
        for d, (end, n) in enumerate((("a", one), ("b", other))):
            rows.append((2 * k + d, " ".join([*(f"p{k}w{x}" for x in range(shared + 4)), *(f"p{k}{end}{x}" for x in range(n))])))
            want[2 * k + d] = (2 * k, 1) if k % 2 == 0 else (2 * k + d, 0)
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == want


LINE = "Some long text that goes on and on, {} times over and then some more."


@pytest.mark.parametrize(
    "page, want",
    [
        ("<body><div id=a><p>{0}</p><p>{1}</p><p>{2}</p></div><div id=b><p>{3}</p></div></body>", "{0}\n{1}\n{2}\n{3}"),
        ("<article><p>{0}</p></article><article><p>{1}</p><p>{2}</p></article>", "{0}\n{1}\n{2}"),
        ("<main><p>{0}</p><p>{1}</p><p>{2}</p><article><p>{3}</p></article></main>", "{0}\n{1}\n{2}\n{3}"),
        ("<article><p>{0}</p></article><div><p>{1}</p><p>{2}</p></div>", "{0}\n{1}\n{2}"),
        ("<div><p>{0}</p><p>{1}</p><p>{2}</p><p>{3}</p><hr><br><p>End.</p></div>", "{0}\n{1}\n{2}\n{3}\nEnd."),
    ],
)
def test_all_content_of_a_page(page, want):
    lines = [LINE.format(x) * 3 for x in ("one", "two", "three", "four")]
    assert html.main_text(page.format(*lines)) == want.format(*lines)


def brute_repeats(texts, length):
    """Bytes of each text within a window that also starts earlier."""
    seen, out = set(), []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(w)
        out.append(bytes(b for b, g in zip(t, gone) if not g))
    return out


@pytest.mark.parametrize("hot, array", [(2, 1 << 20), (1 << 30, 400), (3, 400)])
def test_repeats_around_common_strings(spark, monkeypatch, hot, array):
    """Anchors with many different neighbours, split where they are read or where they meet."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "ARRAY", array)
    monkeypatch.setattr(suffixes, "HELD", 4 * array)
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    common, shared = [word(30) for _ in range(3)], [word(160) for _ in range(4)]
    texts = []
    for k in range(120):
        parts = [word(rng.randrange(120)), rng.choice(common), word(rng.randrange(120))]
        if k % 3 == 0:
            parts.append(rng.choice(shared)[rng.randrange(30) :])
        if k % 7 == 0:
            parts.append(common[0] + shared[0][:90] + common[1])
        texts.append("".join(parts) if k % 11 or not texts else texts[rng.randrange(len(texts))])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(util.table(df), 100).collect()}
    assert [got[k] for k in range(len(texts))] == brute_repeats([t.encode() for t in texts], 100)


def test_one_common_string_everywhere(spark):
    """A 24-byte string with other neighbours in each of 100,000 documents: no task holds them all, nothing is removed."""
    common = "this line is everywhere!"
    df = spark.range(100_000, numPartitions=8).select(F.col("id").alias("doc_id"), F.concat(F.sha2(F.concat(F.lit("a"), F.col("id").cast("string")).cast("binary"), 256), F.lit(common), F.sha2(F.concat(F.lit("b"), F.col("id").cast("string")).cast("binary"), 256)).alias("text"))
    got = suffixes.remove_repeats(util.table(df), 100, kept_text=False).agg(F.sum("n_bytes").alias("n"), F.sum("n_removed").alias("gone")).first()
    assert (got.n, got.gone) == (100_000 * 152, 0)


def test_text_of_many_words(spark):
    """More different words in one text than 21 bits count, and a window at its end."""
    text = " ".join(map(str, range(2_200_000))) + " one two three four five six seven eight nine"
    docs = spark.createDataFrame([(1, text), (2, "one two three four five six seven eight"), (3, "seven eight")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "zero one two three four five six seven eight"), (2, "2199998 2199999 one"), (3, "eight")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.find(docs, bench).collect()}
    assert got == {1: (2_200_009, 10, ["1", "2", "3"]), 2: (8, 8, ["1", "3"]), 3: (2, 1, ["3"])}


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    rows = [(3, a), (7, a), (7, b), (9, c), (9, d), (9, d), (None, d), (None, ""), (None, None), (11, a + " more"), (12, None), (12, None), (None, "x y z")]
    docs = spark.createDataFrame([(*r, k, "s", k) for k, r in enumerate(rows)], "doc_id long, text string, __id int, __all string, node int")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted(map(str, ((r.doc_id, r.text) for r in got.collect())))
    want = [(3, a), (7, b), (9, c), (9, d), (None, ""), (None, None), (12, None), (12, None), (None, "x y z")]
    assert kept == sorted(map(str, want))


def test_pairs_far_down_are_found(spark, monkeypatch):
    """Buckets that are split to the last level, batches repeated until nothing moves."""
    monkeypatch.setattr(jaccard, "SMALL", 2)
    rng = random.Random(9)
    rows, want = [], {}
    for g in range(25):
        base = [f"g{g}w{k}" for k in range(120)]
        for _ in range(8):
            words = list(base)
            words[rng.randrange(120)] = f"x{rng.random()}"  # ten of 232 shingles differ: similarity over 0.9
            want[len(rows)] = g * 8
            rows.append((len(rows), " ".join(words)))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == want and all(r.n_links == 7 for r in got)


def test_ledger_counts_a_pair_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    docs = spark.createDataFrame([(1, "password=hunter22"), (2, "clean"), (3, "clean")], "doc_id long, text string")
    for _ in range(2):  # as two runs beside each other do
        secrets.scan_unseen(docs).write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == 4
    rows = secrets.scan(docs, path).collect()
    assert sorted((r.doc_id, r.spans) for r in rows) == [(1, "assign:0:17"), (2, ""), (3, "")]
    assert secrets.redact(docs, path).count() == 3 and spark.read.parquet(path).count() == 4


def test_rules_are_linear():
    for text in ("eyJ" * 200_000, "gh" + "p_gh" * 100_000, "-----BEGIN A PRIVATE KEY-----" * 10_000, "token " * 100_000, "eyJaaaaaaaaa." * 50_000):
        started = time.time()
        secrets.spans_of(text)
        assert time.time() - started < 5
    assert secrets.spans_of("x eyJabcdefgh.abcdefgh.x y") == [(2, 4, 24)]


def test_findings_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(secrets, "small", lambda df, _: df)
    docs = spark.createDataFrame([(k, f"n {k % 5} password=hunter{k % 5}2", k) for k in range(40)], "doc_id long, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(docs).collect()}
    assert got == {k: (f"n {k % 5} [secret]", 12) for k in range(40)}


def test_cells_rule_most_out_and_lose_nothing():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x[1500:] = x[:1500] + rng.normal(0, 0.35, (1500, 64))  # near copies, about half of them linked
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = embeddings.k_means(x, 48)
    home, near = embeddings.visits(x @ centres.T, centres)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    assert len(a) > 300 and (home[a] != home[b]).any()
    assert ((home[a] == home[b]) | near[a, home[b]] | near[b, home[a]]).all()
    assert near.mean() < 0.6  # at random directions, the worst there is


PARA = "This paragraph tells a part of the story at some length, and {} of them follow each other."


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p>{0}</p><p class='share-price'>The share price rose.</p><div class='legal-analysis'><p>The court said no.</p></div></article>", "{0}\nThe share price rose.\nThe court said no."),
        ("<article><p>{0}</p><p><a href=x>A whole sentence is a link here.</a></p></article>", "{0}\nA whole sentence is a link here."),
        ("<article><p>{0}</p><div class='cookie-banner'>{1}</div><div class='ad'>{2}</div><ul class='nav-links'><li>Home</li></ul></article>", "{0}"),
        ("<div id=comments><p>{1}</p></div><div><p>{0}</p><p>{2}</p></div><div class='site-footer'>{3}</div>", "{0}\n{2}"),
        ("<main><section><p>{0}</p></section><section class=promo><p>{1}</p></section><section><p>{2}</p></section></main>", "{0}\n{2}"),
    ],
)
def test_classes_count_as_whole_words(page, want):
    lines = [PARA.format(x) * 3 for x in ("one", "two", "three", "four")]
    assert html.main_text(page.format(*lines)) == want.format(*lines)


def test_smoothing_decides(monkeypatch):
    """Many lines of middling ratio are content beside one long line; by single ratios that line alone would be."""
    middling = "".join(f"<p>A line of middling size {k}.</p>" for k in range(20))
    page = f"<body>{'<div><p>menu</p></div>' * 12}<article>{middling}</article>{'<div><p>menu</p></div>' * 12}<article><p>{PARA.format(1) * 5}</p></article></body>"
    text = html.main_text(page)
    assert text.split("\n") == [f"A line of middling size {k}." for k in range(20)] + [PARA.format(1) * 5]
    monkeypatch.setattr(html, "smooth", lambda v: list(v))
    assert html.main_text(page) == PARA.format(1) * 5


def test_pages_of_open_tags_take_linear_time():
    for page in ("<div>" * 100_000 + "text", "<div>" * 100_000 + "</section>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "<header><h1>" * 50_000):
        started = time.time()
        html.main_text(page)
        assert time.time() - started < 20


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_components_in_one_task_and_in_rounds(spark, monkeypatch, most):
    monkeypatch.setattr(graph, "ONE_TASK", most)
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, 900) for k in range(500, 600)] + [(7, 7)]
    low = {k: k for e in edges for k in e}
    for _ in range(len(low)):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in low.items() if k != v}
