"""Lazily built plans over the operators, from scene spans to packed keyframes, cuts and transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import vector_id
from ..functions.numeric import half_even, to_ms
from ..functions.text import normalize_transcript
from ..operators import models, ocr, peaks, signal, spans
from ..operators.images import with_size


def keyframe_plan(scenes: DataFrame, cuts: DataFrame, video: Column, step: Column, min_len: int = 10, mode: str = "mid") -> DataFrame:
    """(vid, kf, frame, f_start, f_end, vec_id): scenes less cuts, in cells of `step`, one frame each, packed ids."""
    kept = spans.exclude_spans(scenes, cuts, min_len)
    frames = spans.select_frames(spans.subdivide(kept, step).withColumn("ord", F.col("f_start")), mode)
    return spans.number_keyframes(frames).select("vid", "kf", "frame", "f_start", "f_end", vector_id(video, F.col("kf")).alias("vec_id"))


def slide_plan(scenes: DataFrame, frames: DataFrame, fps: float, sample_fps: float, height: int, width: int, *, motion: float = 20, pixel: float = 14, block: int = 16, least: int = 20, threshold: float = 0.10, min_scene: float = 1.5, min_split: float = 25, reach: int = 2) -> DataFrame:
    """Scenes cut where slides change: mask, change scores and peaks of each scene's own samples, cut frames, pieces.

    Only scenes of min_split seconds or more are looked at; what moves in one says nothing of another. Samples count
    from 0. Samples meet scenes by (vid, t), so a long video is no hot key.
    """
    long_ = scenes.where(F.col("f_end") - F.col("f_start") + 1 >= round(min_split * fps))
    lo, hi = (spans.reference_window(F.col("f_start"), F.col("f_end"), fps, sample_fps)[k] for k in ("lo", "hi"))
    places = long_.select("vid", "ord", lo.alias("_lo"), F.explode(F.sequence(lo, hi - 1)).alias("t"))
    by = ["vid", "ord", "_lo"]
    mine = frames.select("vid", F.col("t").cast("long").alias("t"), "px").join(places, ["vid", "t"]).select(*by, (F.col("t") - F.col("_lo")).alias("t"), "px")
    scores = signal.slide_scores(mine, signal.motion_masks(mine, width, by, motion, reach=reach), width, by, pixel, block, least)
    at = peaks.peaks(scores.withColumnRenamed("t", "idx"), threshold, max(1, round(min_scene * sample_fps)), by)
    cuts = at.select("vid", "ord", half_even((F.col("_lo") + F.col("idx") - 0.5) * fps / sample_fps).alias("at"))
    return spans.split_spans(scenes, cuts, max(1, round(min_scene * fps)), round(min_split * fps))


def advert_plan(frames: DataFrame, reference: DataFrame, clip: int, fps: float, sample_fps: float, max_score: float = 35, gap: int | None = None) -> DataFrame:
    """(vid, f_start, f_end) of a clip's occurrences in frames."""
    at = peaks.find_matches(peaks.match_scores(frames, reference, clip), max_score, gap, clip)
    return at.select("vid", spans.match_to_span(F.col("idx"), clip, fps, sample_fps).alias("s")).select("vid", "s.f_start", "s.f_end")


def transcript_plan(audio: DataFrame, rate: int, speak, seconds: tuple[float, float, float, float] = (20, 1, 0.02, 1)) -> DataFrame:
    """(vid, idx, time_start_ms, time_end_ms, text) of samples (vid, i, smp); speak: chunks (vid, idx, s0, s1) to text."""
    chunk, search, frame, least = (int(s * rate) for s in seconds)
    long_ = audio.groupBy("vid").agg(F.count("*").alias("_n")).where(F.col("_n") >= rate).select("vid")
    cut = signal.silence_chunks(audio.join(long_, "vid", "left_semi"), chunk, search, max(1, frame), least).where("s1 > s0")
    return speak(cut).select("vid", "idx", to_ms(F.col("s0"), rate).alias("time_start_ms"), to_ms(F.col("s1"), rate).alias("time_end_ms"), normalize_transcript(F.col("text")).alias("text"))


def speech_plan(recordings: DataFrame, runner: models.Runner, seconds: tuple[float, float, float, float] = (20, 1, 0.02, 1)) -> DataFrame:
    """(vid, idx, time_start_ms, time_end_ms, text, error) of recordings (vid, rate, samples) by a speech model.

    The model gets structs (rate, samples) of chunks that end in silence; a chunk that fails has an empty text and its error.
    """
    cut = signal.recording_chunks(recordings, seconds, samples=True).where("s1 > s0")
    said = models.apply(cut.withColumn("speech", F.struct("rate", "samples")).drop("samples"), "speech", runner, "text")
    return said.select("vid", "idx", to_ms(F.col("s0"), F.col("rate")).alias("time_start_ms"), to_ms(F.col("s1"), F.col("rate")).alias("time_end_ms"), F.coalesce(normalize_transcript(F.col("text")), F.lit("")).alias("text"), "error")


def ocr_plan(frames: DataFrame, runner: models.Runner, least: float = 0.6) -> DataFrame:
    """(vid, frame, text, error) of frames (vid, frame, image): a text reader's lines of enough confidence, in reading order.

    A frame without such lines has the text ''.
    """
    read = models.apply(frames.select("vid", "frame", "image"), "image", runner, "lines").select("vid", "frame", "lines", "error")
    line = read.select("vid", "frame", F.posexplode("lines").alias("idx", "l")).select("vid", "frame", "idx", "l.*")
    return read.drop("lines").join(ocr.lines_to_text(line, "vid", "frame", least=least), ["vid", "frame"], "left").select("vid", "frame", F.coalesce("text", F.lit("")).alias("text"), "error")


def detect_plan(frames: DataFrame, runner: models.Runner, slots: int = 32) -> DataFrame:
    """detection_plan over a detector's boxes of frames (img, image), img a long; sizes are those of the JPEGs."""
    sized = with_size(models.apply(frames.select(F.col("img").cast("long"), "image"), "image", runner, "boxes"))
    raw = sized.select("img", F.posexplode("boxes").alias("rid", "b")).select("img", F.col("rid").cast("long"), "b.*")
    return detection_plan(raw, sized.where("size is not null").select("img", "size.width", "size.height"), slots=slots)


def detection_plan(raw: DataFrame, sizes: DataFrame, *, pool: int = 300, overlap: float = 0.7, slots: int = 32) -> DataFrame:
    """(img, slot, box, emb, shift, scale, objectness) of a detector's raw output (img, rid, cx, cy, w, h, obj, shift, scale, emb).

    Class vectors to unit length, boxes within the square, pool and suppression there, then boxes of the image
    (sizes: img, width, height), half precision, empty slots filled.
    """
    from ..functions import boxes, numeric
    from ..operators import detections

    box = boxes.corners(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"))
    kept = detections.greedy_nms(raw.select("img", "rid", "obj", box.alias("box")), pool, overlap, slots)
    half = lambda c: numeric.half(c)
    fit = boxes.from_square(F.col("box"), F.col("width"), F.col("height"))
    full = kept.join(raw.select("img", "rid", box.alias("box"), "obj", "shift", "scale", "emb"), ["img", "rid"]).join(sizes, "img").withColumn("box", fit)
    out = full.select(
        "img", "slot", F.struct(*[half(F.col(f"box.{k}")).alias(k) for k in ("x1", "y1", "x2", "y2")]).alias("box"),
        F.transform(numeric.l2_normalize_eps(F.col("emb")), half).alias("emb"), half(F.col("shift")).alias("shift"), half(numeric.elu_scale(F.col("scale"))).alias("scale"), half(F.col("obj")).alias("objectness"),
    )
    grid = sizes.select("img").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint"))))
    dim = raw.agg(F.max(F.size("emb")).alias("_dim"))
    empty = F.lit(detections.EMPTY)
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("x1", "y1", "x2", "y2")])
    joined = grid.join(out, ["img", "slot"], "left").crossJoin(F.broadcast(dim))  # dim is one row
    return joined.select(
        "img", "slot", F.coalesce("box", zero).alias("box"), F.coalesce("emb", F.transform(F.sequence(F.lit(1), F.col("_dim")), lambda _: F.lit(0.0))).alias("emb"),
        *[F.coalesce(c, empty).alias(c) for c in ("shift", "scale", "objectness")],
    )
