"""Picks from score series (vid, idx, score): one extreme for each run past a threshold, a gap apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import signal

#: Bytes of a reference clip that go to all tasks at once.
REFERENCE_BYTES = 32 << 20


def gap_fold(places: Column, gap: Column | int) -> Column:
    """Of ascending places those at least `gap` after the last one taken."""
    g = F.lit(gap).cast("bigint") if isinstance(gap, int) else gap
    zero = F.array().cast("array<bigint>")
    return F.aggregate(places, zero, lambda a, x: F.when((F.size(a) == 0) | (x - F.element_at(F.when(F.size(a) > 0, a).otherwise(F.array(F.lit(0).cast("bigint"))), -1) >= g), F.concat(a, F.array(x))).otherwise(a))


def _picks(marked: DataFrame, best: Column, gap: int, by: list[str]) -> DataFrame:
    run = F.col("idx") - F.row_number().over(Window.partitionBy(*by).orderBy("idx"))
    one = marked.withColumn("_run", run).groupBy(*by, "_run").agg(best.cast("bigint").alias("_at"))
    return one.groupBy(*by).agg(gap_fold(F.array_sort(F.collect_list("_at")), gap).alias("_at")).select(*by, F.explode("_at").alias("idx"))


def peaks(scores: DataFrame, threshold: float, gap: int, by: list[str] | None = None) -> DataFrame:
    """(vid, idx) of the first greatest score of each run above threshold; place 0 is never in a run. by: columns of a series."""
    return _picks(scores.where((F.col("score") > threshold) & (F.col("idx") >= 1)), F.max_by("idx", F.struct("score", -F.col("idx"))), gap, by or ["vid"])


def find_matches(scores: DataFrame, threshold: float, gap: int | None, clip: int) -> DataFrame:
    """(vid, idx) of the first least score of each run at or below threshold. A gap of None or 0 is the clip's length."""
    return _picks(scores.where(F.col("score") <= threshold), F.min_by("idx", F.struct("score", "idx")), gap or clip, ["vid"])


def match_scores(frames: DataFrame, reference: DataFrame, window: int) -> DataFrame:
    """(vid, idx, score): mean absolute difference of every run of `window` frames to the reference.

    frames: (vid, t, px) with px an array, t from 0 without gaps; reference: (t, px) with t 0..window-1. The clip goes
    to all tasks in parts of REFERENCE_BYTES at most; a video meets each part in runs of frames, the first window - 1
    of which the run before has too. Only sums of differences by place leave a run.
    """
    pixels = reference.agg(F.max(F.size("px"))).first()[0] or 0
    most = max(REFERENCE_BYTES // max(2 * pixels, 1), 1)
    out = None
    for first in range(0, window, most):
        clip = reference.where(F.col("t").between(first, min(first + most, window) - 1)).select("t", F.col("px").cast("array<short>")).toArrow()
        part = _differences(frames, *signal.stacked(clip), window) if clip.num_rows else None
        out = part if out is None else out.unionAll(part) if part is not None else out
    if out is None:
        return frames.select("vid", F.col("t").cast("long").alias("idx"), F.lit(0.0).alias("score")).limit(0)
    full = out.groupBy("vid", "idx").agg(F.sum("d").alias("d"), F.sum("n").alias("n"), F.sum("k").alias("k")).where(F.col("k") == window)
    return full.select("vid", "idx", (F.col("d") / F.col("n")).alias("score"))


def _differences(frames: DataFrame, at: np.ndarray, clip: np.ndarray, window: int) -> DataFrame:
    """(vid, idx, d, n, k): sums over the clip's frames `at` of differences to frames from idx on, pixels and frames summed."""
    size = max(signal.RUN, window)
    run = F.expr(f"t div {size}")
    head = (F.col("t") % size < window - 1) & (F.col("t") >= size)
    rows = frames.select("vid", F.col("t").cast("long").alias("t"), "px").withColumn("_run", F.explode(F.when(head, F.array(run - 1, run)).otherwise(F.array(run))))

    def slide(table: pa.Table) -> pa.Table:
        t, x = signal.stacked(table)
        first = table.column("_run")[0].as_py() * size
        own = int((t < first + size).sum())  # places that begin in this run
        d, n = np.zeros(own, np.int64), np.zeros(own, np.int64)
        for k, row in zip(at.tolist(), clip):
            some = x[k : k + own]
            for a in range(0, len(some), 16):
                d[a : a + 16][: len(some[a : a + 16])] += np.abs(some[a : a + 16].astype(np.int32) - row).sum(1)
            n[: len(some)] += 1
        return pa.table({"vid": table.column("vid").slice(0, own), "idx": t[:own], "d": d, "n": n * x.shape[1], "k": n})

    kind = StructType([frames.schema["vid"]] + [StructField(c, LongType()) for c in ("idx", "d", "n", "k")])
    return rows.groupBy("vid", "_run").applyInArrow(slide, kind)
