"""The operators of this subpackage over their whole tables, as the driver's contract wants their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embeddings, html, jaccard, lm, packing, quality, secrets, suffixes, tokens
from .sql import SQL  # noqa: F401
from .util import fold, read, tokenizer_path


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, by a model of the labelled rows outside fold 2 of 4."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(fold("doc_id", 4) != 2))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand in a benchmark window, and the items found."""
    found = decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    n = F.size("items").cast("long")
    return found.select("doc_id", "n_words", "n_hit", n.alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n >= 2).alias("contaminated"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as their token files, written and read back, have them."""
    path = tokens.new_path(spark)
    tokens.write_tokens(read(spark, sf_dir, "documents"), path, tokenizer_path())
    return tokens.read_tokens(spark, path, ids=False)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in every document, each distinct text scanned once."""
    found = secrets.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of equal label at a cosine of 0.93 or more."""
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents by a model of those outside fold 0 of 10."""
    scored = lm.score(read(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and link counts of documents by 5-word shingles at a similarity of 0.8 or more."""
    return jaccard.join(read(spark, sf_dir, "documents"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without bytes of 100-byte strings that start earlier."""
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"), 100, kept_text=False)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1024 ids."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), 1024, ids=False)


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {f.__name__: f for f in (op1_quality, op2_decontaminate, op3_token_ids, op4_secrets, op5_embeddings, op6_lm, op7_jaccard, op8_suffixes, op9_packing, op10_html)}
