"""Views of the driver's tables as spans, scores, frames and the like, for queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name: (Spark SQL, DuckDB SQL). {table} is a table of the driver. 28401120 is 2024-01-01 in minutes of the epoch;
# a minute is a frame.
VIEWS = {
    "scenes": (
        """with m as (select distinct user_id, unix_micros(cast(ts as timestamp)) div 60000000 - 28401120 f from {events})
           select user_id vid, cast(row_number() over (partition by user_id order by f) - 1 as bigint) ord, f f_start,
             coalesce(lead(f) over (partition by user_id order by f) - 1, f + 59) f_end from m""",
        """select user_id vid, row_number() over (partition by user_id order by f) - 1 ord, f f_start,
             coalesce(lead(f) over (partition by user_id order by f) - 1, f + 59) f_end
           from (select distinct user_id, epoch_us(ts) // 60000000 - 28401120 f from events)""",
    ),
    "cuts": (
        """select distinct user_id vid, unix_micros(cast(ts as timestamp)) div 60000000 - 28401165 c_start,
             unix_micros(cast(ts as timestamp)) div 60000000 - 28401075 c_end from {events} where event_type = 'error'""",
        """select distinct user_id vid, epoch_us(ts) // 60000000 - 28401165 c_start, epoch_us(ts) // 60000000 - 28401075 c_end
           from events where event_type = 'error'""",
    ),
    "scores": (
        "select user_id vid, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as bigint) idx, value score from {events}",
        "select user_id vid, row_number() over (partition by user_id order by ts, event_id) - 1 idx, value score from events",
    ),
    "ids": (
        """select s_suppkey, concat(substr('LSNM', cast(s_suppkey % 4 + 1 as int), 1), cast(21 + s_suppkey % 10 as string), '_V', cast(s_suppkey % 1000 as string)) video_id,
             cast(s_suppkey * 37 % 10000 as string) keyframe_id from {supplier}""",
        """select s_suppkey, concat(substr('LSNM', (s_suppkey % 4 + 1)::int, 1), (21 + s_suppkey % 10)::varchar, '_V', (s_suppkey % 1000)::varchar) video_id,
             (s_suppkey * 37 % 10000)::varchar keyframe_id from supplier""",
    ),
    "frames": (
        """select cast(label as bigint) vid, cast(row_number() over (partition by label order by vec_id) - 1 as bigint) t,
             transform(embedding, e -> cast(floor((greatest(-1D, least(1D, cast(e as double) * 4)) + 1) * 127.5D) as smallint)) px from {embeddings}""",
        """select label::bigint vid, row_number() over (partition by label order by vec_id) - 1 t,
             list_transform(embedding, lambda e: floor((greatest(-1.0::double, least(1.0::double, e::double * 4)) + 1) * 127.5::double)::int) px from embeddings""",
    ),
    "boxes": (
        """select l_suppkey img, cast(row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, l_shipdate) as bigint) rid,
             l_quantity / 50 cx, l_discount * 10 cy, 0.05D + l_tax w, 0.05D + (l_partkey % 10) / 20D h, l_extendedprice obj from {lineitem}""",
        """select l_suppkey img, row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, l_shipdate) rid,
             l_quantity / 50 cx, l_discount * 10 cy, 0.05::double + l_tax w, 0.05::double + (l_partkey % 10) / 20::double h, l_extendedprice obj from lineitem""",
    ),
    "transcripts": ("select conv_id vid, turn idx, text from {conversations}", "select conv_id vid, turn idx, text from conversations"),
    "audio": (
        """select user_id vid, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as bigint) i,
             cast(round(value * 100) as bigint) - 5000 smp from {events}""",
        "select user_id vid, row_number() over (partition by user_id order by ts, event_id) - 1 i, round(value * 100)::bigint - 5000 smp from events",
    ),
    "emb": (
        "select label vid, cast(row_number() over (partition by label order by vec_id) - 1 as bigint) row, vec_id, embedding vec from {embeddings}",
        "select label vid, row_number() over (partition by label order by vec_id) - 1 as row, vec_id, embedding vec from embeddings",
    ),
    # lines of a frame: base reading without marks and ß, every second line in capitals; the text itself is the vision model's
    "ocr": (
        "select doc_id vid, replace(text, 'ß', 'ss') vlm_text from {documents}",
        "select doc_id vid, replace(text, 'ß', 'ss') vlm_text from documents",
    ),
    "quads": (
        """select l_suppkey img, rid idx, p_line line, p,
             array(named_struct('x', x, 'y', y), named_struct('x', x + 40, 'y', y), named_struct('x', x + 40, 'y', y + 8), named_struct('x', x, 'y', y + 8)) quad
           from (select l_suppkey, cast(row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, l_shipdate) as bigint) rid,
             concat(l_returnflag, cast(l_partkey as string)) p_line, l_discount * 10 p, l_quantity * 8 x, floor(l_extendedprice / 1000) * 1D y from {lineitem})""",
        """select l_suppkey img, rid idx, p_line line, p, x + 20 mx, y + 4 my
           from (select l_suppkey, row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, l_shipdate) rid,
             concat(l_returnflag, l_partkey::varchar) p_line, l_discount * 10 p, l_quantity * 8 x, floor(l_extendedprice / 1000)::double y from lineitem)""",
    ),
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "conversations")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ask(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Spark SQL over the driver's tables, written {table}."""
    return spark.sql(sql, **{t: load(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ask(spark, sf_dir, VIEWS[name][0])


def ctes(*names: str) -> str:
    """`with` list of DuckDB views under their names prefixed f_."""
    return "with recursive " + ", ".join(f"f_{n} as ({VIEWS[n][1]})" for n in names)
