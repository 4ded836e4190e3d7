"""Pixels of decoded frames: overlays blacked out. px holds rows of gray values."""

from __future__ import annotations

import pyarrow as pa
import numpy as np
from pyspark.sql import DataFrame

from ..functions.boxes import BADGE, TICKER


def black_out(frames: DataFrame, height: int, width: int) -> DataFrame:
    """frames with the overlay rectangles of px set to 0, corners included."""
    boxes = [(0, int(height * TICKER["y"]), width, int(height * TICKER["h"])), (int(width * BADGE["x"]), int(height * BADGE["y"]), int(width * BADGE["w"]), int(height * BADGE["h"]))]

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index("px")
            out = []
            for v in b.column(at):
                p = np.array(v.values).reshape(height, width).copy()
                for x, y, w, h in boxes:
                    p[y : y + h + 1, x : x + w + 1] = 0
                out.append(p.ravel())
            yield b.set_column(at, "px", pa.array(out, b.schema.field(at).type))

    return frames.mapInArrow(run, frames.schema)


def jpeg_size(raw: bytes | None) -> tuple[int, int] | None:
    """(width, height) from a JPEG's frame header; None if there is none."""
    if not raw or raw[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 < len(raw):
        if raw[at] != 0xFF:
            return None
        kind = raw[at + 1]
        if kind == 0xFF:
            at += 1
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(raw[at + 7 : at + 9], "big"), int.from_bytes(raw[at + 5 : at + 7], "big")
        else:
            at += 2 + int.from_bytes(raw[at + 2 : at + 4], "big")
    return None


def with_size(frames: DataFrame, column: str = "image") -> DataFrame:
    """frames with struct size(width, height) of each JPEG, null where it cannot be read."""
    from pyspark.sql import functions as F

    kind = pa.struct([("width", pa.int32()), ("height", pa.int32())])

    @F.arrow_udf("struct<width:int,height:int>")
    def size(images: pa.Array) -> pa.Array:
        got = map(jpeg_size, images.to_pylist())
        return pa.array([None if s is None else {"width": s[0], "height": s[1]} for s in got], kind)

    return frames.withColumn("size", size(F.col(column)))
