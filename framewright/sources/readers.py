"""Readers: videos, scene lists, transcripts, media info, cut spans, binary files and arrays."""

from __future__ import annotations

import io
import subprocess

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import duration_ms, frame_rate, raw_frame_rate
from ..operators.videos import first_by_key

# Suffixes of videos and of audio files.
VIDEO_SUFFIXES = (".webm", ".mp4", ".mkv", ".mov")
AUDIO_SUFFIXES = (".ogg", ".wav", ".flac", ".mp3", ".m4a")


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, modified, size) of a folder's files, not of those below it; contents are not read. Missing: none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "path string, modified timestamp, size long")
    got = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return got.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def find_videos(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = VIDEO_SUFFIXES) -> DataFrame:
    """(vid, path, suffix): one file for each stem, the first by path."""
    got = list_files(spark, folder).select(stem(F.col("path")).alias("vid"), "path", suffix(F.col("path")).alias("suffix"))
    return first_by_key(got.where(F.col("suffix").isin(*suffixes)), "vid", "path")


def find_audio(spark: SparkSession, folder: str | None = None, files: list[str] = ()) -> DataFrame:
    """(vid, path): given files, then a folder's; nothing is dropped for being there twice."""
    out = spark.createDataFrame([(f,) for f in files], "path string")
    if folder:
        out = out.unionByName(list_files(spark, folder).where(suffix(F.col("path")).isin(*AUDIO_SUFFIXES)).select("path"))
    return out.select(stem(F.col("path")).alias("vid"), "path").orderBy("path")


def keyframes(spark: SparkSession, folder: str) -> DataFrame:
    """(vid, frame, path, image) of <folder>/<vid>/NNNN.jpg."""
    got = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", "true").load(folder)
    return got.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("vid"), stem(F.col("path")).alias("frame"), "path", F.col("content").alias("image"))


def keyframe_videos(frames: DataFrame) -> DataFrame:
    return frames.select("vid").distinct()


def parse_scenes(lines: DataFrame, strict: bool = True) -> DataFrame:
    """(vid, ord, f_start, f_end) of lines (vid, line_no, line): two numbers each, blank lines passed over.

    strict: any other line raises; else its row is left out.
    """
    part = F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " ")
    a, b = F.get(part, F.lit(0)).try_cast("bigint"), F.get(part, F.lit(1)).try_cast("bigint")
    good = (F.size(part) == 2) & a.isNotNull() & b.isNotNull()
    text = lines.where(F.trim(F.regexp_replace("line", r"\s+", " ")) != "")
    if strict:
        a = F.when(good, a).otherwise(F.raise_error(F.concat(F.lit("bad scene line: "), F.col("line"))).cast("bigint"))
    else:
        text = text.where(good)
    from pyspark.sql import Window

    order = (F.row_number().over(Window.partitionBy("vid").orderBy("line_no")) - 1).cast("bigint")
    return text.select("vid", order.alias("ord"), a.alias("f_start"), b.alias("f_end"))


def read_scenes(spark: SparkSession, folder: str, kind: str = ".scenes.txt", strict: bool = True) -> DataFrame:
    """Scene lists <vid><kind> of a folder. A file is one row, so its line numbers are certain."""
    got = spark.read.option("pathGlobFilter", f"*{kind}").text(folder, wholetext=True)
    vid = F.regexp_extract(F.col("_metadata.file_name"), "^(.*)" + kind.replace(".", r"\.") + "$", 1)
    return parse_scenes(got.select(vid.alias("vid"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line_no", "line")), strict)


def read_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """(vid, idx, time_start_ms, time_end_ms, text) of <vid>.csv files; idx is 0-based in file order.

    A file is one row, split by the CSV rules in Arrow batches, so quoted line breaks keep their place.
    """
    import csv

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select(stem(F.col("path")).alias("vid"), "content")

    def run(batches):
        for b in batches:
            rows = []
            for vid, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for k, r in enumerate(csv.DictReader(io.StringIO(content.decode(), newline=""))):
                    rows.append((vid, k, int(r["time_start_ms"]), int(r["time_end_ms"]), r["text"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["vid", "idx", "time_start_ms", "time_end_ms", "text"])

    return raw.mapInArrow(run, "vid string, idx long, time_start_ms long, time_end_ms long, text string")


def read_media_info(spark: SparkSession, folder: str) -> DataFrame:
    """(vid, author) of <vid>.json files; other fields are left alone."""
    got = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return got.select(stem(F.col("_metadata.file_name")).alias("vid"), F.get_json_object("value", "$.author").alias("author"))


def explode_cut_spans(docs: DataFrame) -> DataFrame:
    """(vid, f_start, f_end) of JSON texts (value) {vid: [[start, end], ...]}."""
    pairs = docs.select(F.explode(F.from_json("value", "map<string,array<array<bigint>>>")).alias("vid", "_p"))
    return pairs.select("vid", F.explode("_p").alias("_p")).select("vid", F.get("_p", F.lit(0)).alias("f_start"), F.get("_p", F.lit(1)).alias("f_end"))


def read_cut_spans(spark: SparkSession, path: str) -> DataFrame:
    return explode_cut_spans(spark.read.text(path, wholetext=True))


def parse_probe(rows: DataFrame) -> DataFrame:
    """rows (vid, rate, seconds, codec) of a prober's texts as (vid, fps, duration_ms, codec, frame_rate)."""
    return rows.select("vid", frame_rate(F.col("rate")).alias("fps"), duration_ms(F.col("seconds")).alias("duration_ms"), "codec", raw_frame_rate(F.col("rate")).alias("frame_rate"))


def probe(videos: DataFrame, command: tuple[str, ...] = ("ffprobe",)) -> DataFrame:
    """parse_probe of what an external prober says about videos (vid, path); needs the program on the executors."""

    def run(batches):
        ask = [*command, "-v", "error", "-select_streams", "v:0", "-show_entries", "stream=r_frame_rate,codec_name:format=duration", "-of", "default=noprint_wrappers=1"]
        for b in batches:
            rows = []
            for vid, path in zip(*(c.to_pylist() for c in b.columns)):
                said = subprocess.run([*ask, path], capture_output=True, text=True, check=False).stdout
                got = dict(x.split("=", 1) for x in said.splitlines() if "=" in x)
                rows.append((vid, got.get("r_frame_rate", ""), got.get("duration", ""), got.get("codec_name", "")))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["vid", "rate", "seconds", "codec"])

    return parse_probe(videos.select("vid", "path").mapInArrow(run, "vid string, rate string, seconds string, codec string"))


def gray_frames(videos: DataFrame, fps: float, command: tuple[str, ...] = ("ffmpeg",), width: int = 256, height: int = 144) -> DataFrame:
    """(vid, t, px): gray samples of videos (vid, path) by an external decoder; a short last frame is dropped."""

    def run(batches):
        for b in batches:
            for vid, path in zip(*(c.to_pylist() for c in b.columns)):
                ask = [*command, "-v", "error", "-i", path, "-vf", f"fps={fps},scale={width}:{height}", "-f", "rawvideo", "-pix_fmt", "gray", "-"]
                with subprocess.Popen(ask, stdout=subprocess.PIPE) as pipe:
                    t = 0
                    while len(raw := pipe.stdout.read(width * height)) == width * height:
                        yield pa.RecordBatch.from_arrays([pa.array([vid]), pa.array([t]), pa.array([np.frombuffer(raw, np.uint8).astype(np.int16)], pa.list_(pa.int16()))], ["vid", "t", "px"])
                        t += 1
                if pipe.returncode:
                    raise RuntimeError(f"{vid}: the decoder ended with {pipe.returncode} after {t} frames")

    return videos.select("vid", "path").mapInArrow(run, "vid string, t long, px array<short>")


def _npy(raw: bytes) -> np.ndarray:
    return np.load(io.BytesIO(raw), allow_pickle=False)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """(vid, row, vec, vec_id) of <vid>.npy with <vid>.ids.npy; vectors without ids are left out.

    Both files of a video meet in one join; a shard is one video, so it fits a task.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ids = raw.where(name.endswith(".ids.npy")).select(F.regexp_extract(name, r"^(.*)\.ids\.npy$", 1).alias("vid"), F.col("content").alias("ids"))
    vec = raw.where(~name.endswith(".ids.npy")).select(F.regexp_extract(name, r"^(.*)\.npy$", 1).alias("vid"), F.col("content").alias("vec"))

    def run(batches):
        for b in batches:
            for vid, v, i in zip(*(c.to_pylist() for c in b.columns)):
                v, i = _npy(v).astype(np.float32), _npy(i).astype(np.int64)
                if len(v) != len(i):
                    raise ValueError(f"{vid}: {len(v)} vectors, {len(i)} ids")
                yield pa.RecordBatch.from_arrays([pa.array([vid] * len(i)), pa.array(np.arange(len(i))), pa.array(list(v), pa.list_(pa.float32())), pa.array(i)], ["vid", "row", "vec", "vec_id"])

    return vec.join(ids, "vid").select("vid", "vec", "ids").mapInArrow(run, "vid string, row long, vec array<float>, vec_id long")


def pcm(raw: bytes, width: int) -> np.ndarray:
    """Samples of `width` bytes, little-endian, as numbers in -1..1; one byte is unsigned."""
    if width == 1:
        return (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    if width == 3:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        return wide.view("<i4").ravel() / (1 << 31)
    return np.frombuffer(raw, f"<i{width}") / (1 << (8 * width - 1))


def decoded_samples(audio: DataFrame, rate: int = 16_000, command: tuple[str, ...] = ("ffmpeg",)) -> DataFrame:
    """(vid, rate, samples) of audio or video files (vid, path) of any codec, mono, by an external decoder."""

    def run(batches):
        for b in batches:
            for vid, path in zip(*(c.to_pylist() for c in b.columns)):
                done = subprocess.run([*command, "-v", "error", "-i", path, "-ac", "1", "-ar", str(rate), "-f", "s16le", "-"], capture_output=True, check=False)
                if done.returncode:
                    raise RuntimeError(f"{vid}: {done.stderr.decode(errors='replace').strip()[-200:]}")
                yield pa.RecordBatch.from_arrays([pa.array([vid]), pa.array([rate], pa.int32()), pa.array([pcm(done.stdout, 2).astype(np.float32)], pa.list_(pa.float32()))], ["vid", "rate", "samples"])

    return audio.select("vid", "path").mapInArrow(run, "vid string, rate int, samples array<float>")


def wav_samples(spark: SparkSession, folder: str) -> DataFrame:
    """(vid, rate, samples): PCM .wav files of 8, 16, 24 or 32 bits, channels averaged, in -1..1. Other codecs need a decoder."""
    import wave

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(folder).select(stem(F.col("path")).alias("vid"), "content")

    def run(batches):
        for b in batches:
            for vid, content in zip(*(c.to_pylist() for c in b.columns)):
                with wave.open(io.BytesIO(content)) as w:
                    x = pcm(w.readframes(w.getnframes()), w.getsampwidth()).reshape(-1, w.getnchannels()).mean(1)
                    yield pa.RecordBatch.from_arrays([pa.array([vid]), pa.array([w.getframerate()], pa.int32()), pa.array([x.astype(np.float32)], pa.list_(pa.float32()))], ["vid", "rate", "samples"])

    return raw.mapInArrow(run, "vid string, rate int, samples array<float>")
