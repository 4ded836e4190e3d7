"""Video lists: first of equal ids, filters, limits and their side tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the author whose frames carry an overlay.
OVERLAY_AUTHOR = "60 Giây Official"


def first_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the first by order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def only(videos: DataFrame, wanted: DataFrame) -> DataFrame:
    """Videos that are among wanted (vid)."""
    return videos.join(wanted.select("vid").distinct(), "vid", "left_semi")


def with_prefix(videos: DataFrame, prefix: str, column: str = "vid") -> DataFrame:
    """Videos of a batch; the prefix reaches the scan."""
    return videos.where(F.col(column).startswith(prefix))


def limit_sorted(videos: DataFrame, n: int, column: str = "vid") -> DataFrame:
    """First n videos by id; 0 is no limit."""
    return videos.orderBy(column).limit(n) if n else videos.orderBy(column)


def with_scenes(videos: DataFrame, scenes: DataFrame) -> DataFrame:
    """(vid, n_scenes, failed): a video without scenes is a recorded failure."""
    n = scenes.groupBy("vid").agg(F.count("*").alias("n_scenes"))
    return videos.select("vid").join(n, "vid", "left").select("vid", F.coalesce("n_scenes", F.lit(0)).alias("n_scenes"), F.col("n_scenes").isNull().alias("failed"))


def overlay_flag(videos: DataFrame, info: DataFrame, author: str = OVERLAY_AUTHOR) -> DataFrame:
    """(vid, overlay): whether the video's author (vid, author) is the one with an overlay; false without info."""
    return videos.select("vid").join(info.select("vid", "author"), "vid", "left").select("vid", F.coalesce(F.col("author") == author, F.lit(False)).alias("overlay"))


