"""Incremental ingestion: new files become rows once, a checkpoint remembers which."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.readers import parse_probe, stem


def new_files(spark: SparkSession, folder: str, pattern: str = "*", each: int = 1000) -> DataFrame:
    """Stream (vid, path, size) of files as they come, `each` in a batch at most."""
    got = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).option("maxFilesPerTrigger", each).load(folder)
    return got.select(stem(F.col("path")).alias("vid"), "path", F.col("length").alias("size"))


def scene_stream(spark: SparkSession, folder: str, kind: str = ".scenes.txt") -> DataFrame:
    """Stream (vid, ord, f_start, f_end) of scene lists as they come; a bad line fails its batch."""
    got = spark.readStream.option("pathGlobFilter", f"*{kind}").text(folder, wholetext=True)
    vid = F.regexp_extract(F.col("_metadata.file_name"), "^(.*)" + kind.replace(".", r"\.") + "$", 1)
    line = F.filter(F.split("value", r"\r\n|\n|\r"), lambda x: F.trim(x) != "")
    part = F.split(F.trim(F.col("line")), r"\s+")
    rows = got.select(vid.alias("vid"), F.posexplode(line).alias("ord", "line"))
    bad = F.raise_error(F.concat(F.lit("bad scene line: "), F.col("line"))).cast("bigint")
    number = lambda k: F.coalesce(F.when(F.size(part) == 2, F.get(part, F.lit(k)).try_cast("bigint")), bad)
    return rows.select("vid", F.col("ord").cast("bigint").alias("ord"), number(0).alias("f_start"), number(1).alias("f_end"))


def probe_stream(rows: DataFrame) -> DataFrame:
    """Probe texts of a stream as typed columns."""
    return parse_probe(rows)


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all there is to a Parquet table and stops; a rerun adds only what is new."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
