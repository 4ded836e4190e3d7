"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for operators and stages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framewright.llm import decontaminate, embeddings, html, jaccard, lm, packing, quality, secrets, suffixes, tokens, util

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, items string, node long, ids string"
LONG = "long " * 60_000
ROWS = [
    (1, "some words that are here twice and more", None, None, None, None, None, None, None),
    (1, "some words that are here twice and more", None, None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None),
    (None, "", "en", "s", 0, 1.0, "x", 1, "y"),
    (5, "", None, "s", None, None, None, None, None),
    (6, LONG, "en", "s", len(LONG), None, None, None, None),
    (7, "password=hunter22", "en", None, 17, None, None, None, None),
    (8, "\x00   é 日本", "en", None, 9, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """The odd rows as a table, beside the side tables that stages read."""
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(ROWS, SCHEMA).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 0, 1), (7, 1, 0), (None, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "some words that are here twice and more"), (2, None), (None, "x"), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module", params=["odd", "none"])
def docs(request, spark, odd):
    df = spark.read.parquet(f"{odd}/documents.parquet")
    return df if request.param == "odd" else df.where("false")


def test_quality(spark, docs, odd):
    model = quality.train(docs, spark.read.parquet(f"{odd}/labels.parquet"))
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.keep(docs, model).columns == docs.columns


def test_quality_without_labels(spark, docs, odd):
    model = quality.train(docs, spark.read.parquet(f"{odd}/labels.parquet").where("false"))
    assert all(0 <= r.score <= 1 for r in quality.score(docs, model).collect())


def test_decontaminate(spark, docs, odd):
    bench = spark.read.parquet(f"{odd}/benchmark.parquet")
    found = decontaminate.find(docs, bench)
    assert found.count() == docs.count() and {r.n_hit for r in found.where("doc_id = 1").collect()} <= {8}
    kept = decontaminate.decontaminate(docs, bench, 1)
    assert kept.columns == docs.columns and kept.where("doc_id = 1").count() == 0
    assert decontaminate.find(docs, bench.where("false")).where("size(items) > 0").count() == 0


def test_tokens(spark, docs, tmp_path):
    path = str(tmp_path / "tokens")
    tokens.write_tokens(docs, path, util.tokenizer_path())
    rows = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert len(rows) == docs.count() and all(r.ids[-1] == 0 and len(r.ids) == r.n_tokens for r in rows)
    assert [r.start for r in rows] == [int(x) for x in np.cumsum([0, *(r.n_tokens for r in rows)])[:-1]]
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in rows[: len(rows) - len(known)])


def test_secrets(docs):
    rows = secrets.scan(docs).collect()
    assert len(rows) == docs.count() and {r.spans for r in rows} <= {"", "assign:0:17"}
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert {(r.text, r.n_chars) for r in clean.where("doc_id = 7").collect()} <= {("[secret]", 8)}


def test_embeddings(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [1.0, 0.0], 1), (3, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("copy", F.lit(1))
    got = sorted(map(str, embeddings.near_duplicates(df).collect()))
    assert len(got) == 5 and sum("n_links=2, component_id=1" in x for x in got) == 3
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_lm(docs):
    rows = lm.score(docs, util.fold("doc_id", 10) != 0).collect()
    assert len(rows) == docs.count() and all(r.n_tokens >= 1 and r.score < 0 for r in rows)
    assert all(np.isfinite(r.score) for r in lm.score(docs, F.lit(False)).collect())


def test_jaccard(docs):
    rows = jaccard.join(docs).collect()
    assert len(rows) == docs.count()
    assert [(r.class_id, r.n_links) for r in rows if r.doc_id == 1] in ([(1, 1)] * 2, [])
    one = jaccard.one_of_each(docs)
    assert one.columns == docs.columns and one.where("doc_id = 1").count() == min(1, docs.count())
    assert one.count() == max(docs.count() - 1, 0)


def test_suffixes(docs):
    rows = suffixes.remove_repeats(docs).collect()
    assert len(rows) == docs.count() and all(r.n_bytes - r.n_removed == len(r.kept) for r in rows)
    assert all(r.n_removed == len(LONG) - 105 + 0 or r.n_removed > len(LONG) - 110 for r in rows if r.doc_id == 6)


def test_packing(docs):
    rows = packing.pack_documents(docs, util.tokenizer_path(), 64).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert all(len(r.ids) == r.length and r.offset + r.length <= 64 for r in rows)
    assert len([r for r in rows if r.start == 0]) == docs.count()


def test_html(spark):
    df = spark.createDataFrame([(1, "u", None, 5), (1, "u", "", 5), (None, None, "<p>" + "a " * 100_000, None)], "page_id long, url string, html string, n_chars int")
    assert [(r.page_id, r.n_chars) for r in html.extract(df).collect()] == [(1, 0), (1, 0), (None, 199_999)]
    assert html.extract(df.where("false")).count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, docs, odd, k):
    out = corpus_pipeline.STAGES[k][1](spark, docs, odd)
    assert out.count() <= 100_000
    if k < 4:
        assert out.columns == docs.columns
