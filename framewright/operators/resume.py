"""What is left to do: videos whose outputs are not complete, by count, shape or key set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_count(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Videos of wanted (vid, one row each output) whose number of rows in done (vid) differs."""
    want = wanted.groupBy("vid").agg(F.count("*").alias("n"))
    return want.join(done.groupBy("vid").agg(F.count("*").alias("n")), ["vid", "n"], "left_anti").select("vid")


def by_shape(wanted: DataFrame, done: DataFrame, dim: int) -> DataFrame:
    """Videos whose vectors in done (vid, vec) are not as many as wanted rows, or not all of length dim."""
    want = wanted.groupBy("vid").agg(F.count("*").alias("n"))
    got = done.groupBy("vid").agg(F.count("*").alias("n"), F.min(F.size("vec")).alias("_a"), F.max(F.size("vec")).alias("_z")).where((F.col("_a") == dim) & (F.col("_z") == dim))
    return want.join(got, ["vid", "n"], "left_anti").select("vid")


def by_keys(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Videos whose keys (vid, key) in done are not those wanted. Keys meet pairwise; no key set is gathered."""
    both = wanted.select("vid", "key").distinct().withColumn("_w", F.lit(1)).join(done.select("vid", "key").distinct().withColumn("_d", F.lit(1)), ["vid", "key"], "full")
    return both.groupBy("vid").agg(F.max("_w").alias("_any"), F.max(F.when(F.col("_w").isNull() | F.col("_d").isNull(), 1)).alias("_off")).where("_any = 1 and _off = 1").select("vid")


def failures(status: DataFrame) -> DataFrame:
    """Videos of status (vid, ok) that failed, a row each, however many."""
    return status.where(~F.col("ok")).select("vid")


def status_summary(status: DataFrame) -> DataFrame:
    """(done, failed, failed_ids): counts of status (vid, ok) and the failed videos, sorted, in one text to be printed; see failures for rows."""
    return status.agg(F.count_if("ok").alias("done"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("vid").cast("string")))), ","), F.lit("")).alias("failed_ids"))


def by_files(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Videos of wanted (vid) without a file of files (vid, size) that has any bytes."""
    return wanted.select("vid").distinct().join(files.where("size > 0").select("vid"), "vid", "left_anti")
