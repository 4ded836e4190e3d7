"""Members of remote archives: where their stored bytes are, and a data source that lists them."""

from __future__ import annotations

import io
import time
import urllib.error
import urllib.request
import zipfile
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the ZIP format: a local header's signature, size, and where its two name lengths begin.
SIGNATURE, HEADER, LENGTHS = b"PK\x03\x04", 30, 26


def entry_range(header: Column, offset: Column, size: Column) -> Column:
    """struct(start, end), both inclusive, of a stored member: `header` is the local header at `offset`.

    Raises on a wrong signature. All arithmetic is on bytes, inside the JVM.
    """
    byte = lambda k: F.conv(F.hex(F.substring(header, k + 1, 1)), 16, 10).cast("bigint")
    short = lambda k: byte(k) + byte(k + 1) * 256
    good = F.hex(F.substring(header, 1, 4)) == SIGNATURE.hex().upper()
    start = offset.cast("bigint") + HEADER + short(LENGTHS) + short(LENGTHS + 2)
    start = F.when(good, start).otherwise(F.raise_error(F.lit("bad local header")).cast("bigint"))
    return F.struct(start.alias("start"), (start + size - 1).alias("end"))


class RangeFile(io.RawIOBase):
    """A seekable remote file by HTTP ranges. Failed requests are made again, `attempts` in all."""

    def __init__(self, url: str, attempts: int = 4, wait: float = 0.5):
        self.url, self.at, self.attempts, self.wait = url, 0, attempts, wait
        _, headers, _ = self._ask("HEAD", {})
        self.size = int(headers["Content-Length"])

    def _ask(self, method: str, headers: dict, most: int | None = None) -> tuple[int, object, bytes]:
        for k in range(self.attempts):
            try:
                with urllib.request.urlopen(urllib.request.Request(self.url, method=method, headers=headers), timeout=60) as r:
                    return r.status, r.headers, r.read() if most is None else r.read(most)
            except urllib.error.HTTPError as e:
                if e.code < 500 and e.code != 429 or k + 1 == self.attempts:
                    raise
            except OSError:
                if k + 1 == self.attempts:
                    raise
            time.sleep(self.wait * 2**k)
        raise OSError(f"no attempt to read {self.url}")

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def readinto(self, buffer) -> int:
        n = min(len(buffer), self.size - self.at)
        if n <= 0:
            return 0
        status, _, got = self._ask("GET", {"Range": f"bytes={self.at}-{self.at + n - 1}"}, n)
        if status != 206 and n < self.size:
            raise OSError(f"{self.url} does not serve ranges: status {status}")
        if not got:
            raise OSError(f"{self.url} gave nothing at {self.at}")
        buffer[: len(got)] = got
        self.at += len(got)
        return len(got)


class _Member(InputPartition):
    def __init__(self, name: str, offset: int, size: int, packed: int, method: int):
        self.name, self.offset, self.size, self.packed, self.method = name, offset, size, packed, method


def _whole(f, n: int) -> bytes:
    """n bytes of a file that may give fewer at a time."""
    parts = []
    while n > 0 and (got := f.read(n)):
        parts.append(got)
        n -= len(got)
    return b"".join(parts)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.place, self.ending = options["path"], options.get("suffix", ".mp4")

    def _open(self):
        return RangeFile(self.place) if self.place.startswith(("http://", "https://")) else open(self.place, "rb")

    def partitions(self):
        with self._open() as f, zipfile.ZipFile(f) as z:
            return [_Member(i.filename, i.header_offset, i.file_size, i.compress_size, i.compress_type) for i in z.infolist() if i.filename.endswith(self.ending)]

    def read(self, partition):
        with self._open() as f:
            f.seek(partition.offset)
            head = _whole(f, HEADER)
            if head[:4] != SIGNATURE:
                raise ValueError(f"bad local header for {partition.name}")
            lengths = head[LENGTHS : LENGTHS + 4]
            start = partition.offset + HEADER + int.from_bytes(lengths[:2], "little") + int.from_bytes(lengths[2:], "little")
            f.seek(start)
            content = _whole(f, partition.packed)
            if partition.method == zipfile.ZIP_DEFLATED:
                content = zlib.decompress(content, -15)
            elif partition.method != zipfile.ZIP_STORED:
                raise ValueError(f"{partition.name}: compression {partition.method}")
            if len(content) != partition.size:
                raise ValueError(f"{partition.name}: {len(content)} of {partition.size} bytes")
            yield partition.name, partition.offset, start, start + partition.packed - 1, content


class ZipMembers(DataSource):
    """format("zip_members"): one partition for each member of an archive (option path: file or URL;
    suffix, .mp4 unless given). first_byte and last_byte are those of the member as stored; content is inflated."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return "name string, header_offset long, first_byte long, last_byte long, content binary"

    def reader(self, schema):
        return _Reader(self.options)
