"""Token-id files: canonical length-limited Huffman codes over ids, in blocks that decode on their own.

Format. A folder with
- `codebook`: one row, `lengths` (a byte for each id: bits of its code, 0 for an id that does not occur);
  codes are canonical, shorter first, then by id.
- `blocks`: rows (part, block, start_in_part, n_ids, doc_ids int64[], doc_lens uint32[], marks uint32[],
  payload). The ids of whole documents, coded most significant bit first; `marks` are the bit offsets of
  every STRIDE-th id, so decoding runs over all of them at once. Ascending (part, block) is ascending
  doc_id; a part is one range of doc_ids and was written by one task.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .util import drop_table, parts, shared_dir, table, tidy

LIMIT, STRIDE, BLOCK_IDS, PART_IDS = 18, 256, 1 << 20, 1 << 24


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id's code, at most `limit`, least in total (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, leaf_at = leaves, []
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        leaf_at.append(at < len(leaves))
        level = both[at]
    take, bits = 2 * len(order) - 2, np.zeros(len(order), np.int64)
    for is_leaf in reversed(leaf_at):
        n = int(is_leaf[:take].sum())
        bits[:n] += 1
        take = 2 * (take - n)
    bits[:take] += 1
    out[order] = bits
    return out


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes for the lengths."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == bits)
        code <<= bits - last
        last = bits
        codes[ids] = code + np.arange(len(ids), dtype=np.uint64)
        code += len(ids)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Coded bytes of ids and the bit offset of every STRIDE-th."""
    bits, code = lengths[ids].astype(np.int64), codes[ids]
    if len(ids) % 2:
        bits, code = np.append(bits, 0), np.append(code, np.uint64(0))
    second = bits[1::2]
    code = code[::2] << second.astype(np.uint64) | code[1::2]  # two codes are one of 2 * LIMIT bits at most
    bits = bits[::2] + second
    ends = np.cumsum(bits)
    begin = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    out = np.zeros(total // 64 + 2, np.uint64)
    room = 64 - (begin & 63) - bits
    at = begin >> 6
    over = np.flatnonzero(room < 0)
    split, beyond = code[over], room[over]
    room[over] = 0
    code <<= room.astype(np.uint64)
    code[over] = split >> (-beyond).astype(np.uint64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    if len(first):
        out[at[first]] = np.add.reduceat(code, first)
    out[at[over] + 1] += split << (64 + beyond).astype(np.uint64)  # one code at most runs into a word
    return out.astype(">u8").tobytes()[: (total + 7) // 8], begin[:: STRIDE // 2].astype(np.uint32)


class Decoder:
    """Table-driven: the next `limit` bits give an id and the bits of its code."""

    def __init__(self, lengths: np.ndarray):
        self.limit = limit = max(int(lengths.max(initial=1)), 1)
        ids = np.flatnonzero(lengths)
        ids = ids[np.argsort(lengths[ids], kind="stable")]
        step = 1 << (limit - lengths[ids].astype(np.int64))
        entry = (ids.astype(np.uint32) << np.uint32(5)) | lengths[ids].astype(np.uint32)
        self.table = np.zeros(1 << limit, np.uint32)
        filled = np.repeat(entry, step)
        self.table[: len(filled)] = filled

    def decode(self, payload: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((STRIDE, len(marks)), np.uint32)
        raw = np.frombuffer(payload + bytes(16), np.uint8)
        words = np.lib.stride_tricks.as_strided(raw.view(), (len(raw) - 7, 8), (1, 1))
        at, mask = marks.astype(np.int64), np.uint64((1 << self.limit) - 1)
        window = np.ascontiguousarray(words[:, :4]).view(">u4").ravel().astype(np.uint64)
        last = len(window) - 1
        shift = np.int64(32 - self.limit)
        for k in range(min(STRIDE, n)):
            e = self.table[(window[np.minimum(at >> 3, last)] >> (shift - (at & 7)).astype(np.uint64)) & mask]
            out[k] = e >> np.uint32(5)
            at += e & np.uint32(31)
        return out.T.ravel()[:n]


_ENCODED = "doc_id long, seq long, n_ids long, ids binary"


def encode(docs: DataFrame, tokenizer: str, end_id: int | None = 0) -> DataFrame:
    """(doc_id, seq, n_ids, ids): each whole text's ids, then end_id; ids are zstd over the vocabulary's word size.

    seq tells rows of equal doc_id apart. Null text: empty. A last row of each task, of seq -1, has its counts by id.
    """

    @tidy
    def run(batches):
        enc, task, row = bpe.encoder(tokenizer), TaskContext.get().partitionId(), 0
        counts = np.zeros(enc.size, np.int64)
        squeeze = zstandard.ZstdCompressor(level=1)
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        for b in batches:
            for i in range(0, b.num_rows, 500):
                some = b.slice(i, 500)
                got = enc.encode([t or "" for t in some.column(1).to_pylist()])
                counts += np.bincount(np.concatenate(got), minlength=enc.size)
                if end_id is not None:
                    counts[end_id] += len(got)
                raw = [x.tobytes() + end for x in got]
                n = [len(x) // enc.dtype().itemsize for x in raw]
                seq = np.arange(row, row + len(n)) + (task << 33)
                row += len(n)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(seq), pa.array(n, pa.int64()), pa.array([squeeze.compress(x) for x in raw], pa.binary())], ["doc_id", "seq", "n_ids", "ids"])
        if row:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([-1]), pa.array([0]), pa.array([counts.tobytes()])], ["doc_id", "seq", "n_ids", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _ENCODED)


def unpack_ids(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), np.uint16 if size <= 1 << 16 else np.uint32)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0) -> None:
    """Writes the token files of docs (doc_id, text) to a new folder `path` in ascending doc_id order.

    Rows of equal or null doc_id are all kept, null first, equal ones side by side. An empty table gives a
    codebook without codes and no block. Ids are encoded once, kept in the shared folder until coded.
    """
    spark = docs.sparkSession
    size = bpe.encoder(tokenizer).size
    coded = table(encode(docs, tokenizer, end_id), compression="none")

    def count(batches):
        c = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(0):
                c += np.frombuffer(x.as_py(), np.int64)
        k = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(c[k], pa.int64())], ["id", "n"])

    counts = np.zeros(size, np.int64)  # bounded by the vocabulary
    for k, n in coded.where("seq < 0").select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n")).collect():
        counts[k] = n
    lengths = code_lengths(counts)
    codes = codes_of(lengths)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codebook")

    @tidy
    def block(batches):
        part, no, start = TaskContext.get().partitionId(), 0, 0
        docs_, ids, n = [], [], 0

        def flush():
            nonlocal no, start, docs_, ids, n
            flat = np.concatenate(ids)
            payload, marks = pack(flat, lengths, codes)
            row = [part, no, start, n, np.array([-1 if d is None else d for d in docs_], np.int64).tobytes(), np.array([d is None for d in docs_]).tobytes(), np.array([len(x) for x in ids], np.uint32).tobytes(), marks.tobytes(), payload]
            no, start, docs_, ids, n = no + 1, start + n, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)

        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1)):
                docs_.append(d)
                ids.append(unpack_ids(x.as_py(), size))
                n += len(ids[-1])
                if n >= BLOCK_IDS:
                    yield flush()
        if docs_:
            yield flush()

    n = parts(spark, int(counts.sum()), PART_IDS)
    ordered = coded.where("seq >= 0").repartitionByRange(n, F.asc_nulls_first("doc_id"), "seq").sortWithinPartitions(F.asc_nulls_first("doc_id"), "seq")
    ordered.select("doc_id", "ids").mapInArrow(block, _BLOCK_SQL).write.option("compression", "none").parquet(f"{path}/blocks")
    drop_table(coded)


_BLOCK = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("doc_nulls", pa.binary()), ("doc_lens", pa.binary()), ("marks", pa.binary()), ("payload", pa.binary())])
_BLOCK_SQL = "part long, block long, start_in_part long, n_ids long, doc_ids binary, doc_nulls binary, doc_lens binary, marks binary, payload binary"


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, if asked for, ids): the documents of token files.

    start: ids of all documents before it. The driver gets one number for each part.
    """
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codebook").first()[0]), np.uint8)
    blocks = spark.read.schema(_BLOCK_SQL).parquet(f"{path}/blocks")
    sums = dict(blocks.groupBy("part").agg(F.sum("n_ids")).collect())
    before, total = {}, 0
    for part in sorted(sums):
        before[part], total = total, total + sums[part]

    @tidy
    def run(batches):
        decoder = Decoder(lengths)
        for b in batches:
            for r in b.to_pylist():
                flat = decoder.decode(r["payload"], np.frombuffer(r["marks"], np.uint32), r["n_ids"]).astype("<u4")
                lens = np.frombuffer(r["doc_lens"], np.uint32).astype(np.int64)
                ends = np.cumsum(lens)
                doc = pa.array(np.frombuffer(r["doc_ids"], np.int64), mask=np.frombuffer(r["doc_nulls"], bool))
                cuts = [flat[e - n : e] for e, n in zip(ends, lens)]
                cols = [doc, pa.array(ends - lens + (before[r["part"]] + r["start_in_part"])), pa.array(lens), pa.array([zlib.crc32(x) for x in cuts], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array([x.astype(np.int32) for x in cuts], pa.list_(pa.int32()))] if ids else []), ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids)

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)


def new_path(spark: SparkSession) -> str:
    from .util import _made

    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path
