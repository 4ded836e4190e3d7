"""Text lines of frames: order, confidence, documents, and a vision model's reading set against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reconcile_lines


def reading_order(lines: DataFrame, *by: str) -> DataFrame:
    """lines with `place`, 0-based: by mean y, then mean x of the quad (array of x, y), then `idx`."""
    from pyspark.sql import Window

    mean = lambda k: F.aggregate("quad", F.lit(0.0), lambda a, p: a + p[k]) / F.size("quad")
    return lines.withColumn("place", (F.row_number().over(Window.partitionBy(*by).orderBy(mean("y"), mean("x"), "idx")) - 1).cast("bigint"))


def confident(lines: DataFrame, least: float = 0.6) -> DataFrame:
    return lines.where(F.col("p") >= least)


def lines_to_text(lines: DataFrame, *by: str, least: float = 0.6) -> DataFrame:
    """(by, text): lines of confidence `least` or more, joined in reading order."""
    order = F.struct("my", "mx", "idx", "line")
    mean = lambda k: F.aggregate("quad", F.lit(0.0), lambda a, p: a + p[k]) / F.size("quad")
    got = confident(lines, least).withColumn("my", mean("y")).withColumn("mx", mean("x"))
    return got.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda s: s["line"]), "\n").alias("text"))


def frame_map(texts: DataFrame) -> DataFrame:
    """(vid, doc): map of frame name to text."""
    return texts.groupBy("vid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("frame", "text")))).alias("doc"))


def degenerate(texts: DataFrame, *by: str, short: int = 5) -> DataFrame:
    """(by, degenerate): whether more than half of a batch's texts have `short` characters or fewer."""
    return texts.groupBy(*by).agg((F.count_if(F.char_length("text") <= short) > F.expr("count(*) div 2")).alias("degenerate"))


def cross_check(base: DataFrame, vlm: DataFrame, keys: list[str]) -> DataFrame:
    """base (keys, text) with lines reconciled to vlm (keys, vlm_text); frames without text or reading stay."""
    joined = base.join(vlm, keys, "left")
    blank: Column = F.trim("text") == ""
    return joined.withColumn("text", F.when(blank, F.col("text")).otherwise(reconcile_lines(F.col("text"), F.col("vlm_text")))).drop("vlm_text")
