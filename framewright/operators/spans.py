"""Inclusive frame spans (vid, ord, f_start, f_end): picks, cuts, subdivision, exclusion, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_even


def pick_frame(start: Column, end: Column, mode: str = "mid") -> Column:
    """First, last or, for any other mode, middle frame (rounded down)."""
    return start if mode == "left" else end if mode == "right" else F.floor((start + end) / 2)


def select_frames(spans: DataFrame, mode: str = "mid") -> DataFrame:
    """spans with `frame`; a span whose frame an earlier span of the video has goes."""
    w = Window.partitionBy("vid", "frame").orderBy("ord")
    return spans.withColumn("frame", pick_frame(F.col("f_start"), F.col("f_end"), mode)).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def number_keyframes(frames: DataFrame) -> DataFrame:
    """frames with `kf`, 1-based in the order of frames, as a decoder writes them."""
    return frames.withColumn("kf", F.row_number().over(Window.partitionBy("vid").orderBy("frame")).cast("bigint"))


def keyframe_name(kf: Column) -> Column:
    return F.format_string("%04d", kf)


def stride(seconds: float, fps: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), half_even(F.lit(seconds) * fps))


def subdivide(spans: DataFrame, step: Column) -> DataFrame:
    """Spans of two steps or more in nearly equal cells of a step; `cell` counts them."""
    n = F.col("f_end") - F.col("f_start") + 1
    cells = F.when(n < 2 * F.col("_step"), F.lit(1).cast("bigint")).otherwise(F.expr("(f_end - f_start + 1) div _step"))
    out = spans.withColumn("_step", step.cast("bigint")).withColumn("_cells", cells).withColumn("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_cells") - 1)))
    edge = lambda k: F.expr(f"f_start + ((f_end - f_start + 1) * (cell + {k})) div _cells")
    return out.withColumn("_s", edge(0)).withColumn("f_end", edge(1) - 1).withColumn("f_start", F.col("_s")).drop("_s", "_step", "_cells")


def exclude_spans(spans: DataFrame, cuts: DataFrame, min_len: int = 10) -> DataFrame:
    """spans less the cuts (vid, c_start, c_end): remainders of min_len frames or more; untouched spans whole.

    One range join and one window by span: remainders lie between a cut and the furthest end before it.
    """
    hit = (F.col("c.vid") == F.col("s.vid")) & (F.col("c.c_end") >= F.col("s.f_start")) & (F.col("c.c_start") <= F.col("s.f_end"))
    joined = spans.alias("s").join(cuts.alias("c"), hit, "left")
    cut = lambda x: F.when(F.col("c.c_end").isNotNull(), x)  # noqa: E731  greatest and least pass nulls over
    joined = joined.select("s.*", cut(F.greatest("c.c_start", "s.f_start")).alias("_a"), cut(F.least("c.c_end", "s.f_end")).alias("_b"))
    w = Window.partitionBy("vid", "ord", "f_start", "f_end").orderBy("_a", "_b")
    reach = F.max("_b").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.max("_b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    last = F.lead(F.lit(1)).over(w).isNull()
    gap = F.struct(F.coalesce(before + 1, F.col("f_start")).alias("s"), (F.col("_a") - 1).alias("e"))
    tail = F.struct((reach + 1).alias("s"), F.col("f_end").alias("e"))
    rest = F.filter(F.when(last, F.array(gap, tail)).otherwise(F.array(gap)), lambda p: p["e"] - p["s"] + 1 >= min_len)
    whole = F.array(F.struct(F.col("f_start").alias("s"), F.col("f_end").alias("e")))
    pieces = joined.withColumn("_p", F.when(F.col("_a").isNull(), whole).otherwise(rest)).withColumn("_p", F.explode("_p"))
    return pieces.withColumn("f_start", F.col("_p.s")).withColumn("f_end", F.col("_p.e")).drop("_p", "_a", "_b")


def cut_pieces(start: Column, end: Column, points: Column, min_len: Column | int) -> Column:
    """Pieces of a span at sorted cut points; a point nearer than min_len to the last one taken or the end is passed over."""
    n = F.lit(min_len).cast("bigint") if isinstance(min_len, int) else min_len.cast("bigint")
    piece = "array<struct<s:bigint,e:bigint>>"
    zero = F.struct(start.cast("bigint").alias("prev"), F.array().cast(piece).alias("out"))

    def step(acc: Column, c: Column) -> Column:
        taken = F.struct(c.alias("prev"), F.concat(acc["out"], F.array(F.struct(acc["prev"].alias("s"), (c - 1).alias("e")))).alias("out"))
        return F.when((c - acc["prev"] < n) | (end - c < n), acc).otherwise(taken)

    return F.aggregate(points, zero, step, lambda a: F.concat(a["out"], F.array(F.struct(a["prev"].alias("s"), end.cast("bigint").alias("e")))))


def split_spans(spans: DataFrame, points: DataFrame, min_len: int, min_split: int = 0) -> DataFrame:
    """spans cut at the points (vid, at), or (vid, ord, at) of one span, inside them (start < at <= end); shorter ones than min_split stay whole."""
    own = F.col("p.ord") == F.col("s.ord") if "ord" in points.columns else F.lit(True)
    inside = (F.col("p.vid") == F.col("s.vid")) & own & (F.col("p.at") > F.col("s.f_start")) & (F.col("p.at") <= F.col("s.f_end"))
    by = ["vid", "ord", "f_start", "f_end"]
    got = spans.alias("s").join(points.alias("p"), inside, "left").select("s.*", F.col("p.at").cast("bigint").alias("_at")).groupBy(*by).agg(F.array_sort(F.collect_set("_at")).alias("_at"))
    long_ = F.col("f_end") - F.col("f_start") + 1 >= min_split
    at = F.when(long_, F.col("_at")).otherwise(F.array().cast("array<bigint>"))
    pieces = got.withColumn("_p", F.explode(cut_pieces(F.col("f_start"), F.col("f_end"), at, min_len)))
    return pieces.withColumn("f_start", F.col("_p.s")).withColumn("f_end", F.col("_p.e")).drop("_p", "_at")


def union_spans(*parts: DataFrame) -> DataFrame:
    """Exact pairs (vid, f_start, f_end) of all parts once; overlaps are not joined."""
    out = parts[0].select("vid", "f_start", "f_end")
    for p in parts[1:]:
        out = out.unionByName(p.select("vid", "f_start", "f_end"))
    return out.distinct()


def reference_window(start: Column, end: Column, fps: Column | float, sample_fps: Column | float) -> Column:
    """struct(lo, hi) of samples of a clip, hi exclusive."""
    rate = lambda x: half_even(x / F.lit(fps) * F.lit(sample_fps))
    return F.struct(rate(start).alias("lo"), (rate(end) + 1).alias("hi"))


def match_to_span(at: Column, samples: int, fps: float, sample_fps: float) -> Column:
    """struct(f_start, f_end) of a match of `samples` samples that begins at a sample."""
    frame = lambda x: half_even(x / F.lit(float(sample_fps)) * F.lit(float(fps)))
    return F.struct(frame(at).alias("f_start"), frame(at + samples).alias("f_end"))
