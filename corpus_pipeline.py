"""A corpus in five stages: quality, near-duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns a DataFrame; run()
writes it as Parquet to the shared folder and hands the reread table on. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewright.llm import decontaminate, jaccard, packing, quality, secrets
from framewright.llm.util import drop_table, fold, read, scratch, table, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more by a factorisation machine of the labels outside fold 2 of 4."""
    return quality.keep(docs, quality.train(docs, read(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)), 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each class of similar shingle sets."""
    return jaccard.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of any benchmark item occurs."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), min_items=1)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mask and n_chars of the new text."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids, with their ids."""
    return packing.pack_documents(docs, tokenizer_path(), 1024)


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark_passages), ("secret scans", secret_scan), ("packing", pack)]

#: No SQL: the classifier, the join and the tokenizer have none. tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch() as kept:  # tables that only this stage reads go when its result is written
            after = table(stage(spark, docs, sf_dir))
            kept.append(after)
        drop_table(docs)
        docs = after
    return docs
