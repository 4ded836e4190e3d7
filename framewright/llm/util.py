"""Shared plumbing: shared-folder tables, sizing and word hashing over Arrow buffers."""

from __future__ import annotations

import atexit
import ctypes
import functools
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[tuple[SparkSession, str]] = []
#: Spark's own setting: a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which every executor sees.

    Only a local session (tests) may name none: a folder of this machine is set then. A cluster must name one.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="framewright-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place


def table(df: DataFrame, *, compression: str = "zstd") -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends at replicated files.

    The shuffle files behind it are deleted as soon as it is written; nothing lazy can refer to them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/framewright-{uuid.uuid4().hex}"
    _made.append((spark, path))
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.select("*").write.option("compression", compression).parquet(path)  # a query of its own, planned under the setting
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._framewright_path = path
    return out


def bucketed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """table() in as many buckets by an integer column: joins on it, and passes over it, do not move its rows."""
    spark = df.sparkSession
    name = f"framewright_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    _made.append((spark, path))
    most = spark.conf.get(_BUCKETS, "100000")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_BUCKETS, str(max(int(most), buckets)))
    try:
        df.select("*").write.format("parquet").option("path", path).option("compression", "none").bucketBy(buckets, column).saveAsTable(name)
    finally:
        spark.conf.set(_CLEANUP, before)
        spark.conf.set(_BUCKETS, most)
    out = spark.table(name)
    out._framewright_path = path
    return out


def drop_table(*tables: DataFrame) -> None:
    """Deletes the files of table()s that nothing lazy still reads."""
    for df in tables:
        path = getattr(df, "_framewright_path", None)
        if path:
            _delete(df.sparkSession, path)
            _made[:] = [x for x in _made if x[1] != path]


@contextmanager
def scratch(*keep: DataFrame):
    """Drops all tables made inside when it ends, but those added to the list it gives."""
    before, kept = {x[1] for x in _made}, list(keep)
    try:
        yield kept
    finally:
        stay = before | {getattr(df, "_framewright_path", None) for df in kept}
        for spark, path in [x for x in _made if x[1] not in stay]:
            _delete(spark, path)
            _made.remove((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    """On whatever file system the path is; a bucketed() table leaves the catalog too."""
    name = path.rsplit("/", 1)[-1]
    if name.startswith("framewright_"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session has ended, its gateway with it
            if path.startswith("file:/"):
                shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)


def small(df: DataFrame, bytes_: int, most: int = 16 << 20) -> DataFrame:
    """df for the side of a join that may be broadcast: only if the measured `bytes_` are `most` at most; else Spark shuffles it."""
    return F.broadcast(df) if bytes_ <= most else df


def parts(spark: SparkSession, size: int | None, each: int) -> int:
    """Partitions for `size` bytes (or rows) at about `each` per task, never fewer than the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size or 0) // each), 1)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one scan, one number."""
    return int(docs.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def fold(column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def _trim() -> None:
    """Hands freed memory back, so that a worker kept for the next stage holds no more than its caches."""
    if "p" in _pow and len(_pow["p"]) > 1 << 22:  # of a very long text
        _pow.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # not glibc
        pass


def tidy(f):
    """A function over a task's batches that trims memory when the task ends."""

    @functools.wraps(f)
    def run(*args, **kwargs):
        try:
            yield from f(*args, **kwargs)
        finally:
            _trim()

    return run


# Word hashing ------------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INV = pow(_BASE, -1, 1 << 64)
_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _pow.get("p")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        p, q = np.full(size, _BASE, np.uint64), np.full(size, _INV, np.uint64)
        p[0] = q[0] = 1
        _pow["p"], _pow["q"] = np.cumprod(p), np.cumprod(q)
    return _pow["p"][:n], _pow["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def alnum_table() -> np.ndarray:
    """Byte map: A-Z to a-z, digits, letters and bytes over 0x7F kept, all others 0."""
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    keep = np.zeros(256, bool)
    keep[ord("0") : ord("9") + 1] = keep[ord("a") : ord("z") + 1] = keep[ord("A") : ord("Z") + 1] = keep[0x80:] = True
    t[~keep] = 0
    return t


def space_table() -> np.ndarray:
    """Byte map: A-Z to a-z, the blanks 0x20 and 0x09-0x0D to 0, NUL moved off 0."""
    t = np.arange(256, dtype=np.uint16)
    t[0] = 256
    t[ord("A") : ord("Z") + 1] += 32
    t[[0x20, 9, 10, 11, 12, 13]] = 0
    return t


def words(data: np.ndarray, bounds: np.ndarray, table_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and begin of each word, and the number of words before each text.

    data: the texts' UTF-8 bytes, end to end; bounds: the n+1 offsets into it. No word spans two texts.
    """
    n = len(data)
    t = table_[data]
    is_word = t != 0
    begin = is_word.copy()
    begin[1:] &= ~is_word[:-1]
    at = bounds[1:-1]
    at = at[at < n]
    begin[at] = is_word[at]
    starts = np.flatnonzero(begin)
    stop = np.zeros(n + 1, bool)
    stop[1:] = is_word
    stop[1:n] &= ~is_word[1:]
    if len(at):
        at = at[at > 0]
        stop[at] = is_word[at - 1]
    ends = np.flatnonzero(stop)
    p, q = _powers(n + 1)
    c = np.empty(n + 1, np.uint64)
    c[0] = 0
    np.cumsum(t.astype(np.uint64) * p[:n], out=c[1:])
    h = mix((c[ends] - c[starts]) * q[starts])
    return h, starts, np.searchsorted(starts, bounds)


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """(first row, last row, bytes, bounds) of runs of rows whose texts have about `most` bytes at most; null is empty."""
    col = batch.column(column)
    if pa.types.is_string(col.type):
        col = col.cast(pa.large_string())
    col = col.fill_null("") if col.null_count else col
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8)
    buf = col.buffers()[2]
    raw = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        j = min(j, n)
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words; position i covers words i..i+n-1."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[k : k + m]
    return mix(out)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
