"""Packed ids of videos and frames as column expressions.

A video id is a prefix letter, a group, a separator, `V` and a number; its head packs them into a long, and
a vector id packs head and frame number. Either separator and any zero padding are read, one canonical form
is written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix letters in the order of their codes, the id's pattern, and the written form of each prefix.
PREFIXES = "LSNM"
PATTERN = r"^([LSNM])([0-9]+)[-_]V([0-9]+)$"
FORMS = {0: "L%02d_V%03d", 1: "S%02d-V%03d", 2: "N%03d-V%03d", 3: "M%02d_V%03d"}


def try_video_head(video: Column) -> Column:
    """(code * 1000 + group) * 1000 + number, or null where the id is malformed or out of range."""
    part = lambda k: F.regexp_extract(video, PATTERN, k)
    group, number = part(2).try_cast("bigint"), part(3).try_cast("bigint")
    code = F.instr(F.lit(PREFIXES), part(1)).cast("bigint") - 1
    return F.when(video.rlike(PATTERN) & (group < 1000) & (number < 1000), (code * 1000 + group) * 1000 + number)


def video_head(video: Column) -> Column:
    """As try_video_head; raises on a bad id."""
    head = try_video_head(video)
    return F.when(video.isNull(), F.lit(None).cast("bigint")).otherwise(F.coalesce(head, F.raise_error(F.concat(F.lit("not a video id: "), video)).cast("bigint")))


def video_id(head: Column) -> Column:
    """Canonical id of a head."""
    group, number = F.floor(head / 1000) % 1000, head % 1000
    code = F.floor(head / 1_000_000)
    out = None
    for k, form in FORMS.items():
        text = F.format_string(form, group, number)
        out = F.when(code == k, text) if out is None else out.when(code == k, text)
    return out


def vector_id(video: Column, frame: Column) -> Column:
    """head * 10000 + frame; raises where the frame number is outside 0..9999."""
    n = frame.cast("bigint")
    bad = F.raise_error(F.concat(F.lit("frame number out of range: "), frame.cast("string"))).cast("bigint")
    return video_head(video) * 10_000 + F.when((n >= 0) & (n <= 9_999), n).otherwise(bad)


def split_vector_id(vec: Column) -> tuple[Column, Column]:
    """(video id, four-digit frame) of a vector id."""
    return video_id(F.floor(vec / 10_000)), F.format_string("%04d", vec % 10_000)
