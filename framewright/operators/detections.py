"""Detections (img, rid, box, obj): pool, greedy suppression, fixed slots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What an empty slot holds in each auxiliary field.
EMPTY = -10_000.0


def top_pool(boxes: DataFrame, pool: int = 300) -> DataFrame:
    """The `pool` boxes of an image with most objectness, by rid where equal; `rank` is 1-based."""
    return boxes.withColumn("rank", F.row_number().over(Window.partitionBy("img").orderBy(F.desc("obj"), "rid"))).where(F.col("rank") <= pool)


def suppress(box: np.ndarray, overlap: float = 0.7) -> np.ndarray:
    """Places of rows (x1, y1, x2, y2), best first, that overlap no kept one by more than `overlap`."""
    area = (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])
    alive, out = np.ones(len(box), bool), []
    for k in range(len(box)):
        if not alive[k]:
            continue
        out.append(k)
        w = np.maximum(0, np.minimum(box[k, 2], box[k + 1 :, 2]) - np.maximum(box[k, 0], box[k + 1 :, 0]))
        h = np.maximum(0, np.minimum(box[k, 3], box[k + 1 :, 3]) - np.maximum(box[k, 1], box[k + 1 :, 1]))
        union = area[k] + area[k + 1 :] - w * h
        with np.errstate(divide="ignore", invalid="ignore"):
            alive[k + 1 :] &= ~(w * h / union > overlap)
    return np.array(out, np.int64)


def greedy_nms(boxes: DataFrame, pool: int = 300, overlap: float = 0.7, keep: int = 32) -> DataFrame:
    """(img, slot, rid): of each image's pool those left by suppression, best first, `keep` at most.

    A pool is bounded, so each image is one array; suppression in sequence runs over Arrow batches of images.
    """
    row = F.struct("rank", "rid", "box.x1", "box.y1", "box.x2", "box.y2")
    one = top_pool(boxes, pool).groupBy("img").agg(F.array_sort(F.collect_list(row)).alias("_b"))

    def run(batches):
        for b in batches:
            rows = []
            for img, got in zip(b.column(0).to_pylist(), b.column(1)):
                s = got.values
                box = np.stack([s.field(k).to_numpy(zero_copy_only=False) for k in range(2, 6)], 1)
                rid = s.field(1).to_numpy(zero_copy_only=False)
                rows += [(img, n, int(rid[k])) for n, k in enumerate(suppress(box, overlap)[:keep])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["img", "slot", "rid"])

    return one.select(F.col("img").cast("long"), "_b").mapInArrow(run, "img long, slot long, rid long")


def pad_slots(kept: DataFrame, images: DataFrame, columns: dict[str, object], slots: int = 32) -> DataFrame:
    """Every image (img) with slots 0..slots-1; empty ones have the given value in each of `columns`."""
    grid = images.select("img").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint"))))
    out = grid.join(kept, ["img", "slot"], "left")
    return out.select("img", "slot", *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in columns.items()])
