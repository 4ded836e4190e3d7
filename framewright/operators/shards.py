"""Embedding shards: pairing of vectors and ids, validation, totals, and the quantised index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import quantize

#: Bytes of query vectors that go to all tasks at once.
QUERY_BYTES = 16 << 20


def pair(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    """vectors (vid, row, vec) with their ids (vid, row, vec_id); videos without ids drop out."""
    return vectors.join(ids, ["vid", "row"])


def validate(vectors: DataFrame, ids: DataFrame) -> DataFrame:
    """(vid, n_vectors, n_ids, dim, ok): rows of both agree and all vectors have the first video's length."""
    v = vectors.groupBy("vid").agg(F.count("*").alias("n_vectors"), F.min(F.size("vec")).alias("_low"), F.max(F.size("vec")).alias("dim"))
    both = v.join(ids.groupBy("vid").agg(F.count("*").alias("n_ids")), "vid")
    first = both.agg(F.min_by("dim", "vid").alias("_dim"))
    ok = (F.col("n_vectors") == F.col("n_ids")) & (F.col("_low") == F.col("dim")) & (F.col("dim") == F.col("_dim"))
    return both.crossJoin(F.broadcast(first)).select("vid", "n_vectors", "n_ids", "dim", ok.alias("ok"))


def require_valid(checked: DataFrame) -> DataFrame:
    """Raises, when run, on the first shard that is not ok."""
    return checked.where(F.assert_true(F.col("ok"), F.concat(F.lit("bad shard "), F.col("vid").cast("string"))).isNull())


def totals(ids: DataFrame) -> DataFrame:
    """(vid, n, total): rows of each video and of all up to it.

    Videos are sorted in ranges; each range sums its own, and only a sum for each range reaches one task.
    """
    n = ids.groupBy("vid").agg(F.count("*").alias("n"))
    ranged = n.repartitionByRange("vid").withColumn("_range", F.spark_partition_id())
    own = Window.partitionBy("_range").orderBy("vid").rowsBetween(Window.unboundedPreceding, 0)
    sums = ranged.groupBy("_range").agg(F.sum("n").alias("_sum"), F.min("vid").alias("_low"))
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_range").select("vid", "n", (F.sum("n").over(own) + F.col("_before")).alias("total"))


def duplicate_ids(ids: DataFrame) -> DataFrame:
    """(vec_id, n) of ids that several rows have."""
    return ids.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1")


def build_index(paired: DataFrame, bits: int = 4) -> DataFrame:
    """(vec_id, codes, lo, step) of validated pairs: each vector in 2^bits steps of its own range."""
    q = quantize(F.col("vec"), bits)
    return paired.select("vec_id", q.alias("q")).select("vec_id", "q.codes", "q.lo", "q.step")


def search(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, place, vec_id, score): of each query (query_id, vec) the k rows of an index whose decoded vectors
    have the greatest product with it, the smaller id first where equal.

    Queries are a stated set, compared with all rows in blocks: each task keeps its own best k, so k rows for each
    query and task are all that moves. QUERY_BYTES of queries go to all tasks at once; more take further passes.
    """
    dim = queries.agg(F.max(F.size("vec")).alias("dim"), F.count("*").alias("n")).first()
    passes = max(1, -(-(dim["n"] * 8 * (dim["dim"] or 1)) // QUERY_BYTES))
    out = None
    for part in range(passes):
        some = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == part).select("query_id", F.col("vec").cast("array<double>")).collect()
        if some:
            got = _best(index, [r[0] for r in some], np.array([r[1] for r in some]), k)
            out = got if out is None else out.unionAll(got)
    if out is None:
        return index.sparkSession.createDataFrame([], "query_id long, place long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= k).select("query_id", "place", "vec_id", "score")


def _best(index: DataFrame, ids: list, vectors: np.ndarray, k: int) -> DataFrame:
    def run(batches):
        score, who = np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            codes = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            lo, step = (b.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            new = vectors @ (codes * step[:, None] + lo[:, None]).T
            score = np.concatenate([score, new], 1)
            who = np.concatenate([who, np.broadcast_to(b.column(0).to_numpy(zero_copy_only=False), new.shape)], 1)
            order = np.lexsort((who, -score))[:, :k]
            score, who = np.take_along_axis(score, order, 1), np.take_along_axis(who, order, 1)
        n = score.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n), pa.int64()), pa.array(who.ravel()), pa.array(score.ravel())], ["query_id", "vec_id", "score"])

    return index.select(F.col("vec_id").cast("long"), F.col("codes").cast("array<int>"), F.col("lo").cast("double"), F.col("step").cast("double")).mapInArrow(run, "query_id long, vec_id long, score double")
