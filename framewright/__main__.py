"""Command line: python -m framewright COMMAND ... Each command reads and writes Parquet tables or the files of sources.readers."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.ids import vector_id
from .functions.media import decoder
from .operators import encoders, models, resume, shards, signal, spans, videos
from .plans import pipelines
from .session import session
from .sources import archives, decode, readers, writers


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="framewright", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, **flags: object) -> None:
        c = sub.add_parser(name.replace("_", "-"))
        for k, v in flags.items():
            flag = "--" + k.replace("_", "-")
            if v is None:
                c.add_argument(flag, required=True)
            elif isinstance(v, bool):
                c.add_argument(flag, action="store_true")
            else:
                c.add_argument(flag, type=type(v), default=v)
        c.add_argument("--video", nargs="*", default=[], help="only these videos")
        c.add_argument("--limit", type=int, default=0, help="first videos by id; 0: all")

    command("find_ad_span", frames=None, out=None, ref_video=None, ref_start=0, ref_end=0, fps=25.0, rates="", sample_fps=2.0, max_score=35.0, min_gap=0)
    command("exclude_spans", scenes=None, spans=None, out=None, min_len=10)
    command("split_slides", scenes=None, frames=None, out=None, height=144, width=256, fps=25.0, rates="", sample_fps=2.0, min_scene_sec=1.5, min_split_sec=25.0, motion_pct=20.0, pixel_thresh=14.0, block_size=16, threshold=0.10)
    command("resample", scenes=None, out=None, stride_sec=1.0, fps=25.0, rates="", dry_run=False)
    command("keyframes", scenes=None, out=None, mode="mid", videos="", media_info="", ffmpeg="ffmpeg", quality=2, gpu=False)
    command("stream_extract_keyframes", archive=None, scenes=None, out=None, mode="mid", media_info="", ffmpeg="ffmpeg", quality=2)
    command("embed_keyframes", keyframes=None, out=None, slot="siglip2", model="", force=False)
    command("ocr_keyframes", keyframes=None, out=None, model=None, least=0.6)
    command("detect_keyframes", keyframes=None, out=None, model=None, slots=32)
    command("extract_transcript", audio=None, out=None, model=None, chunk=20.0)
    command("embed_transcript", transcripts=None, out=None, force=False)
    command("build_index", shards=None, out=None, bit_width=4)
    command("chunk_audio", audio=None, out=None, chunk=20.0)
    return p


def _chosen(df: DataFrame, a: argparse.Namespace) -> DataFrame:
    if a.video:
        df = df.where(F.col("vid").isin(a.video))
    if a.limit:
        df = videos.only(df, videos.limit_sorted(df.select("vid").distinct(), a.limit))
    return df


def _loader(place: str) -> Callable:
    """The function named MODULE:FUNCTION, which loads a model in a worker."""
    module, _, name = place.partition(":")
    return lambda: getattr(importlib.import_module(module), name)()


def _existing(spark, path: str) -> DataFrame | None:
    """The table at path; None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return None


def _by_rate(spark, a, rows: DataFrame, plan: Callable[[DataFrame, float], DataFrame]) -> DataFrame:
    """plan(rows, fps) for the videos of each frame rate: those of --rates (vid, fps), --fps for others. Rates are few."""
    if not a.rates:
        return plan(rows, a.fps)
    rated = rows.join(spark.read.parquet(a.rates).select("vid", F.col("fps").alias("_fps")), "vid", "left").withColumn("_fps", F.coalesce("_fps", F.lit(a.fps)))
    out = None
    for (fps,) in rated.select("_fps").distinct().orderBy("_fps").collect():
        got = plan(rated.where(F.col("_fps") == fps).drop("_fps"), fps)
        out = got if out is None else out.unionByName(got)
    return plan(rows, a.fps) if out is None else out


def _decoded(spark, a, scenes: DataFrame, files: DataFrame) -> DataFrame:
    """Keyframes of files, overlays blacked out where the media info says so."""
    chosen = spans.number_keyframes(spans.select_frames(scenes, a.mode))
    if a.media_info:
        files = files.join(videos.overlay_flag(files, readers.read_media_info(spark, a.media_info)), "vid")
    got = decode.extract_keyframes(chosen, files, a.ffmpeg.split(), a.quality)
    return got.withColumn("keyframe_id", spans.keyframe_name(F.col("kf")))


def _scenes(spark, a) -> DataFrame:
    return _chosen(readers.read_scenes(spark, a.scenes), a)


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = session(a.command)
    if a.command == "find-ad-span":
        frames = spark.read.parquet(a.frames)  # the reference clip counts even if its video is not chosen
        w = frames.limit(1).select(spans.reference_window(F.lit(a.ref_start), F.lit(a.ref_end), a.fps, a.sample_fps).alias("w")).first().w
        clip = frames.where((F.col("vid") == a.ref_video) & F.col("t").between(w.lo, w.hi - 1)).select((F.col("t") - w.lo).alias("t"), "px")
        if clip.select("t").distinct().count() < 2:
            raise SystemExit("the reference clip has fewer than two samples")
        clip.cache()
        found = _by_rate(spark, a, _chosen(frames, a), lambda rows, fps: pipelines.advert_plan(rows, clip, w.hi - w.lo, fps, a.sample_fps, a.max_score, a.min_gap))
        known = _existing(spark, a.out)
        if known is not None:  # spans of earlier runs stay; they are read before the table is replaced
            known = spark.createDataFrame(known.toArrow())
        writers.write_cut_spans(known, found, a.out)
    elif a.command == "exclude-spans":
        cuts = readers.read_cut_spans(spark, a.spans).select("vid", F.col("f_start").alias("c_start"), F.col("f_end").alias("c_end"))
        scenes = _scenes(spark, a)
        kept = spans.exclude_spans(scenes, cuts, a.min_len)
        writers.write_scenes(kept, a.out, "excluded")
        writers.progress(scenes, kept).orderBy("vid").show(1000, False)
    elif a.command == "split-slides":
        frames = spark.read.parquet(a.frames)
        more = dict(motion=a.motion_pct, pixel=a.pixel_thresh, block=a.block_size, threshold=a.threshold, min_scene=a.min_scene_sec, min_split=a.min_split_sec)
        got = _by_rate(spark, a, _scenes(spark, a), lambda rows, fps: pipelines.slide_plan(rows, frames, fps, a.sample_fps, a.height, a.width, **more))
        writers.write_scenes(got, a.out, "split")
    elif a.command == "resample":
        scenes = _scenes(spark, a)
        got = _by_rate(spark, a, scenes, lambda rows, fps: spans.subdivide(rows, spans.stride(a.stride_sec, F.lit(fps))))
        writers.progress(scenes, got).orderBy("vid").show(1000, False)
        if not a.dry_run:
            writers.write_scenes(got.drop("cell"), a.out, "resampled")
    elif a.command == "keyframes":
        if a.videos:
            files = readers.find_videos(spark, a.videos)
            about = readers.probe(files)
            files = files.join(about.select("vid", decoder(F.col("codec"), a.gpu).alias("decoder"), F.col("frame_rate").alias("fps")), "vid")
            writers.write_parts(_decoded(spark, a, _scenes(spark, a), files), a.out, "vid")
        else:
            got = spans.number_keyframes(spans.select_frames(_scenes(spark, a), a.mode))
            writers.write_parts(got.withColumn("keyframe_id", spans.keyframe_name(F.col("kf"))), a.out, "vid")
    elif a.command == "stream-extract-keyframes":
        spark.dataSource.register(archives.ZipMembers)
        members = spark.read.format("zip_members").option("path", a.archive).load()
        files = members.select(readers.stem(F.col("name")).alias("vid"), "content")
        writers.write_parts(_decoded(spark, a, _scenes(spark, a), files), a.out, "vid")
    elif a.command == "embed-keyframes":
        rows, slot = _chosen(readers.keyframes(spark, a.keyframes), a), encoders.SLOTS[a.slot]
        done = None if a.force else _existing(spark, a.out)
        if done is not None:
            rows = videos.only(rows, resume.by_shape(rows, done.withColumn("vid", F.col("vid").cast("string")), slot.dim))
        got = encoders.encode(rows.select("vid", "frame", "image"), "image", replace(slot, load=_loader(a.model)) if a.model else slot)
        writers.write_parts(got.drop("image").withColumn("vec_id", vector_id(F.col("vid"), F.col("frame"))), a.out, "vid")
    elif a.command == "ocr-keyframes":
        got = pipelines.ocr_plan(_chosen(readers.keyframes(spark, a.keyframes), a), models.Runner(a.model, models.LINES, _loader(a.model)), a.least)
        writers.write_frame_texts(got.select("vid", "frame", "text"), a.out)
    elif a.command == "detect-keyframes":
        frames = _chosen(readers.keyframes(spark, a.keyframes), a).select(vector_id(F.col("vid"), F.col("frame")).alias("img"), "image")
        pipelines.detect_plan(frames, models.Runner(a.model, models.DETECTIONS, _loader(a.model)), a.slots).write.mode("overwrite").parquet(a.out)
    elif a.command == "extract-transcript":
        wav = _chosen(readers.wav_samples(spark, a.audio), a)
        writers.write_transcripts(pipelines.speech_plan(wav, models.Runner(a.model, models.SPEECH, _loader(a.model)), (a.chunk, 1, 0.02, 1)), a.out)
    elif a.command == "embed-transcript":
        rows = _chosen(readers.read_transcripts(spark, a.transcripts), a)
        done = None if a.force else _existing(spark, a.out)
        if done is not None:
            rows = videos.only(rows, resume.by_shape(rows, done.withColumn("vid", F.col("vid").cast("string")), encoders.SLOTS["gte"].dim))
        got = encoders.encode_transcripts(rows).withColumn("vec_id", vector_id(F.col("vid"), F.col("idx")))
        writers.write_parts(got, a.out, "vid")
    elif a.command == "build-index":
        rows = _chosen(readers.read_shards(spark, a.shards), a)
        shards.require_valid(shards.validate(rows.where("vec is not null"), rows.where("vec_id is not null"))).count()
        twice = shards.duplicate_ids(rows).limit(5).collect()
        if twice:
            raise SystemExit("ids of several vectors: " + ", ".join(str(r.vec_id) for r in twice))
        shards.build_index(rows, a.bit_width).write.mode("overwrite").parquet(a.out)
    elif a.command == "chunk-audio":
        wav = _chosen(readers.wav_samples(spark, a.audio), a)
        signal.recording_chunks(wav, (a.chunk, 1, 0.02, 1)).drop("rate").write.mode("overwrite").parquet(a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
