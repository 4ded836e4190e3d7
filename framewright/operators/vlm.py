"""A vision model's reading of frames: bounded attempts, batches that say nothing, and the way back to the base text."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ocr import cross_check

SHORT = 5
_readers: dict[str, Callable[[list], list]] = {}


class Reader:
    """Calls `start()` for a function of images to texts. A text of SHORT characters or fewer is asked for once
    more; a batch more than half of which is short, or that raises, counts as failed and starts the model anew;
    after `restarts` new starts no more is asked."""

    def __init__(self, start: Callable[[], Callable[[list], list]], attempts: int = 2, restarts: int = 3):
        self.start, self.attempts, self.left, self.read = start, attempts, restarts, None

    def __call__(self, images: list) -> list:
        for _ in range(self.attempts):
            if self.left < 0:
                break
            try:
                self.read = self.read or self.start()
                said = self.read(images)
                again = [k for k, t in enumerate(said) if len(t) <= SHORT]
                if again:
                    for k, t in zip(again, self.read([images[k] for k in again])):
                        said[k] = t
                if sum(len(t) <= SHORT for t in said) <= len(said) // 2:
                    return said
            except Exception:  # noqa: BLE001  whatever the model does, the base text is still there
                pass
            self.read = None
            self.left -= 1
        return [None] * len(images)


def read_frames(frames: DataFrame, start: Callable[[], Callable[[list], list]], name: str = "vlm", batch: int = 8) -> DataFrame:
    """(vid, frame, vlm_text) of frames (vid, frame, image); null where the model failed."""

    def run(batches):
        reader = _readers.setdefault(name, Reader(start))
        for b in batches:
            for i in range(0, b.num_rows, batch):
                some = b.slice(i, batch)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(reader(some.column(2).to_pylist()), pa.string())], ["vid", "frame", "vlm_text"])

    rows = frames.select(F.col("vid").cast("string"), F.col("frame").cast("string"), "image")
    return rows.mapInArrow(run, "vid string, frame string, vlm_text string")


def checked_text(base: DataFrame, frames: DataFrame, start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """base (vid, frame, text) reconciled with the model's reading; only frames with text are shown to it."""
    shown = frames.join(base.where(F.trim("text") != "").select("vid", "frame"), ["vid", "frame"], "left_semi")
    return cross_check(base, read_frames(shown, start), ["vid", "frame"])
