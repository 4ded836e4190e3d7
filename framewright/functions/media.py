"""What is handed to external decoders, and the lookup of decoders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hardware and software decoder by codec.
DECODERS = {"av1": ("av1_cuvid", "libdav1d"), "h264": ("h264", "h264"), "hevc": ("hevc_cuvid", "hevc")}


def select_expr(frames: Column, fps: str = "") -> Column:
    """Filter expression that selects the frames of an array, ascending; with fps, after that rate's filter."""
    return F.concat(F.lit((f"fps={fps}," if fps else "") + "select='"), F.array_join(F.transform(F.array_sort(frames), lambda n: F.concat(F.lit("eq(n\\,"), n.cast("string"), F.lit(")"))), "+"), F.lit("'"))


def decoder(codec: Column, gpu: bool) -> Column:
    """Decoder for a codec; null where the default is left to choose."""
    table = F.create_map(*[F.lit(x) for k, v in DECODERS.items() for x in (k, v[0 if gpu else 1])])
    return F.try_element_at(table, codec)
