"""The pipeline against a stage-by-stage brute force that takes the classifier's scores as given."""

import pyarrow.parquet as pq
from tests.llm.test_operators import LOWER, WORD, brute_classes, check_packing

import corpus_pipeline
from framewright.llm import quality, secrets, util


def windows(text):
    w = WORD.findall((text or "").translate(LOWER))
    n = min(8, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def test_run(spark, sf):
    from tokenizers import Tokenizer

    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    table = util.read(spark, sf, "documents")
    model = quality.train(table, util.read(spark, sf, "labels").where(util.fold("doc_id", 4) != 2))
    good = {r.doc_id for r in quality.score(table, model).where("score >= 0.7").collect()}
    left = [d for d in docs if d[0] in good]
    assert 0.5 * len(docs) < len(left) < len(docs)
    left = [d for d, c in zip(left, brute_classes(left)) if c[0] == c[1]]
    items = [windows(r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    def clean(text):
        w = WORD.findall((text or "").translate(LOWER))
        have = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
        return not any(have & i for i in items)

    assert any(not clean(t) for _, t in left)
    left = [d for d in left if clean(d[1])]
    left = [(d, secrets._masked(t, ",".join(f"x:{s}:{e}" for s, _, e in secrets.spans_of(t or "")), "[secret]")) for d, t in left]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in left}
    assert check_packing(rows, Tokenizer.from_file(util.tokenizer_path()), left) > 0.95
