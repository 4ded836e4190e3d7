"""Keyframes from videos by an external decoder, one run for each video, JPEGs through a pipe.

Nothing is written to the executor's disk. A decoder that fails or gives another number of frames than asked
for is followed by the next one; a video that none can read is a row with its error, so one bad file
does not lose the rest.
"""

from __future__ import annotations

import os
import subprocess
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import BADGE, TICKER

_BOXES = ({"x": 0, "y": TICKER["y"], "w": 1, "h": TICKER["h"]}, BADGE)
#: Filter that blacks the overlay out before a frame is coded; the decoder knows the frame's size.
COVER = ",".join("drawbox=" + ":".join(f"{k}={'iw' if k in 'xw' else 'ih'}*{b[k]}" for k in "xywh") + ":color=black:t=fill" for b in _BOXES)


def split_images(raw: bytes) -> list[bytes]:
    """JPEGs that follow each other in a stream."""
    end_begin = b"\xff\xd9\xff\xd8"
    parts = raw.split(end_begin) if raw else []
    last = len(parts) - 1
    return [(b"\xff\xd8" if k else b"") + p + (b"\xff\xd9" if k < last else b"") for k, p in enumerate(parts)]


def decode(source: str | bytes, filters: str, count: int, decoders: Sequence[str], command: Sequence[str], quality: int) -> tuple[list[bytes], str | None]:
    """(images, None), or ([], what went wrong with the last decoder). source: a path, or a file's bytes, which stay in memory."""
    if not isinstance(source, str):
        memory = os.memfd_create("video")
        try:
            with os.fdopen(os.dup(memory), "wb") as f:
                f.write(source)
            return decode(f"/proc/{os.getpid()}/fd/{memory}", filters, count, decoders, command, quality)
        finally:
            os.close(memory)
    path, error = source, "no decoder"
    for name in dict.fromkeys([*filter(None, decoders), ""]):  # '' leaves the choice to the program
        ask = [*command, "-v", "error", *(("-c:v", name) if name else ()), "-i", path, "-vf", filters, "-vsync", "0", "-an", "-q:v", str(quality), "-f", "image2pipe", "-c:v", "mjpeg", "-"]
        try:
            done = subprocess.run(ask, capture_output=True, check=False)
        except OSError as e:
            return [], str(e)
        images = split_images(done.stdout)
        if done.returncode == 0 and len(images) == count:
            return images, None
        said = done.stderr.decode(errors="replace").strip().splitlines()
        error = said[-1] if done.returncode and said else f"{len(images)} of {count} frames"
    return [], error


def extract_keyframes(frames: DataFrame, videos: DataFrame, command: Sequence[str] = ("ffmpeg",), quality: int = 2) -> DataFrame:
    """(vid, kf, frame, image, error) of frames (vid, kf, frame) of videos (vid, path or content[, decoder, fps, overlay]).

    kf counts a video's frames in ascending order, as the decoder gives them. fps: the rate, as text, at which frame numbers
    count; overlay: whether the overlay is blacked out. A video that fails is one row of null kf, with its error. Needs the
    program on the executors, and paths that they can open.
    """
    from ..functions.media import select_expr

    column = lambda c, default: F.col(c) if c in videos.columns else F.lit(default)
    source = "path" if "path" in videos.columns else "content"
    about = videos.select("vid", F.col(source).alias("source"), column("decoder", "").alias("decoder"), F.coalesce(column("fps", ""), F.lit("")).alias("fps"), F.coalesce(column("overlay", False), F.lit(False)).alias("overlay"))
    wanted = frames.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("frame", "kf"))).alias("want"))  # a video's keyframes: thousands at most
    ask = F.concat(F.when(F.col("fps") != "", F.concat(F.lit("fps="), "fps", F.lit(","))).otherwise(""), select_expr(F.col("want.frame")), F.when(F.col("overlay"), F.lit("," + COVER)).otherwise(""))
    rows = wanted.join(about, "vid").select(F.col("vid").cast("string"), "source", "decoder", ask.alias("filters"), "want")

    def run(batches):
        for b in batches:
            for vid, source, name, filters, want in zip(*(c.to_pylist() for c in b.columns)):
                images, error = decode(source, filters, len(want), [name], command, quality)
                out = [(vid, w["kf"], w["frame"], x, None) for w, x in zip(want, images)] or [(vid, None, None, None, error)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()))], ["vid", "kf", "frame", "image", "error"])

    return rows.mapInArrow(run, "vid string, kf long, frame long, image binary, error string")
