"""Sinks. Every write goes through Spark's commit protocol: a rerun replaces whole partitions, never half a file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.spans import union_spans


def write_parts(df: DataFrame, path: str, *by: str) -> None:
    """Parquet by partitions; only those in df are replaced (keyframes, embeddings, detections, indexes)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_scenes(spans: DataFrame, path: str, stage: str) -> None:
    """Spans as a new version `stage`; earlier stages stay as they are."""
    write_parts(spans.withColumn("stage", F.lit(stage)), path, "stage")


def write_scene_lists(spans: DataFrame, path: str) -> None:
    """Text files of `start end` lines, a folder vid=... for each video."""
    line = F.concat_ws(" ", F.col("f_start").cast("string"), F.col("f_end").cast("string")).alias("value")
    spans.repartition("vid").sortWithinPartitions("vid", "f_start", "f_end").select("vid", line).write.mode("overwrite").partitionBy("vid").text(path)


def write_transcripts(rows: DataFrame, path: str) -> None:
    """CSV files with a header time_start_ms,time_end_ms,text, a folder vid=... for each video, rows by idx."""
    out = rows.repartition("vid").sortWithinPartitions("vid", "idx").select("vid", "time_start_ms", "time_end_ms", "text")
    out.write.mode("overwrite").partitionBy("vid").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_frame_texts(texts: DataFrame, path: str) -> None:
    """JSON documents {frame: text}, one line in a folder vid=... for each video; letters stay letters."""
    doc = texts.groupBy("vid").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("frame", "text"))))).alias("value"))
    doc.write.mode("overwrite").partitionBy("vid").text(path)


def write_cut_spans(known: DataFrame | None, found: DataFrame, path: str) -> None:
    """Exact union of known and found spans (vid, f_start, f_end) as a new Parquet table, sorted by video."""
    out = union_spans(*([known, found] if known is not None else [found]))
    out.repartitionByRange("vid").sortWithinPartitions("vid", "f_start", "f_end").write.mode("overwrite").parquet(path)


def cut_spans_json(spans: DataFrame) -> DataFrame:
    """(value): {vid: [[start, end], ...]} in one text. Cut spans are few: those of a batch of videos."""
    pair = F.array("f_start", "f_end")
    by = spans.groupBy("vid").agg(F.array_sort(F.collect_list(pair)).alias("p"))
    return by.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("vid", "p"))))).alias("value"))


def progress(before: DataFrame, after: DataFrame) -> DataFrame:
    """(vid, n_before, n_after) spans of each video, the report of a refining step."""
    n = lambda d, c: d.groupBy("vid").agg(F.count("*").alias(c))
    return n(before, "n_before").join(n(after, "n_after"), "vid", "left").select("vid", "n_before", F.coalesce("n_after", F.lit(0)).alias("n_after"))
