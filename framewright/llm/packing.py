"""Packing by shortest-pack-first over the length histogram.

Texts become ids, an end id follows, and every document is cut into pieces of seq_len ids and one rest.
Only the histogram of piece lengths (seq_len numbers) reaches the driver. Lengths are placed longest
first, each into the shortest open pack; equal packs are one pattern with a count. A pattern's count and slots then give every piece, by its rank among pieces of its length,
a sequence and an offset.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe
from .util import small, table, tidy


def patterns(counts: np.ndarray, seq_len: int) -> list[tuple[int, list[int]]]:
    """(packs, their lengths) of each pattern. counts[n]: pieces of length n.

    Lengths go longest first. The shortest pack, the one with most room left, takes the next length, as
    often as both last; only if even that has no room a new pack opens.
    """
    room: dict[int, list[list]] = {}  # free places -> [packs, lengths]
    for n in range(seq_len, 0, -1):
        left = int(counts[n]) if n < len(counts) else 0
        while left:
            free = max((f for f, p in room.items() if p), default=0)
            if free < n:
                room.setdefault(seq_len - n, []).append([left, [n]])
                break
            packs, lengths = room[free].pop()
            many = min(packs, left)
            if packs > many:
                room[free].append([packs - many, lengths])
            room.setdefault(free - n, []).append([many, [*lengths, n]])
            left -= many
    return [(p, lengths) for some in room.values() for p, lengths in some]


def slots(found: list[tuple[int, list[int]]], seq_len: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of every run of ranks. Bounded by the patterns."""
    rank, runs, sequence = np.zeros(seq_len + 1, np.int64), {}, 0
    for packs, lengths in found:
        offset = 0
        for n in lengths:
            runs.setdefault(n, []).append((int(rank[n]), sequence, offset))
            rank[n] += packs
            offset += n
        sequence += packs
    return {n: tuple(np.array(x, np.int64) for x in zip(*r)) for n, r in runs.items()}


def pieces(docs: DataFrame, tokenizer: str, seq_len: int, end_id: int = 0, ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, task, rank[, ids]): rank counts equal lengths within the task."""

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank"]

    @tidy
    def run(batches):
        enc, task = bpe.encoder(tokenizer), TaskContext.get().partitionId()
        seen, end = np.zeros(seq_len + 1, np.int64), np.array([end_id], "<u4")
        for b in batches:
            for i in range(0, b.num_rows, 500):
                some = b.slice(i, 500)
                rows, flat = [], []
                for d, x in zip(some.column(0).to_pylist(), enc.encode([t or "" for t in some.column(1).to_pylist()])):
                    x = np.concatenate([x.astype("<u4"), end])
                    flat.append(x)
                    for s in range(0, len(x), seq_len):
                        cut = x[s : s + seq_len]
                        rows.append((d, s, len(cut), zlib.crc32(cut), len(x), task, int(seen[len(cut)])))
                        seen[len(cut)] += 1
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                if ids:  # pieces lie end to end, as the ids of texts do
                    ends = np.cumsum([0, *(r[2] for r in rows)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * ids)

    sql = ", ".join(f"{n} long" for n in names) + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, sql)


def pack_documents(docs: DataFrame, tokenizer: str, seq_len: int = 1024, end_id: int = 0, ids: bool = True) -> DataFrame:
    """Packs all texts of docs (doc_id, text): one row for each piece with sequence_id and offset.

    Null text: empty, its piece is the end id. Rows of equal or null doc_id are packed one by one; an empty
    table gives no piece. Other columns of docs are ignored. Padding: what a sequence lacks of seq_len.
    """
    cut = table(pieces(docs, tokenizer, seq_len, end_id, ids))
    # One row for each task and length: equal lengths, however many, are counted before any shuffle.
    by_task = table(cut.groupBy("length", "task").agg(F.count("*").alias("n")))
    before = by_task.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n"))
    counts = np.zeros(seq_len + 1, np.int64)
    for n, c in by_task.groupBy("length").agg(F.sum("n")).collect():
        counts[n] = c
    where = slots(patterns(counts, seq_len), seq_len)

    def placed(length: pa.Array, rank: pa.Array, offsets: bool) -> pa.Array:
        length, rank = length.to_numpy(), rank.to_numpy()
        out = np.zeros(len(length), np.int64)
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            first, to, off = where[int(n)]
            k = np.searchsorted(first, rank[mine], "right") - 1
            out[mine] = off[k] if offsets else to[k] + rank[mine] - first[k]
        return pa.array(out)

    sequence = F.arrow_udf(lambda length, rank: placed(length, rank, False), "long")
    offset = F.arrow_udf(lambda length, rank: placed(length, rank, True), "long")
    side = small(before.select("length", "task", "before"), 24 * by_task.count())
    rank = F.col("rank") + F.col("before")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * ids
    return cut.join(side, ["length", "task"]).select(*names, sequence("length", rank).alias("sequence_id"), offset("length", rank).alias("offset"))
