"""Search-log inputs derived from the driver's read-only tables.

S1  sub-day events, 3 clients, noisy case and spaces (from ``events``)
S1C S1 with query = event_type (same user + query meets on several clients)
S2  long date range (lineitem x orders x part)
T2  daily tuples of S2, split into an archived and a live part
DOC documents as (doc_id, query)

All loaders return the fixed ``searches`` schema
``(client_id string, timestamp timestamp, username string, query string)``;
timestamps arrive as timestamp_ntz and are read as UTC instants once, here.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

# Fixed parameters of the fixtures (see FIXTURES.md).
S2_AS_OF = _dt.date(2001, 8, 2)
T2_SPLIT = _dt.date(2001, 1, 1)
S1_AS_OF = _dt.datetime(2024, 1, 31, 0, 5)
S1_HOURS = 744
S1_OFFSET_MIN = 5
S1C_WINDOW_SECONDS = 86_400
TEST_SALT = "test-salt"
TEST_BLACKLIST = "*widget, red ?olt\n[bc]o*"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _noisy(q, selector):
    """Four spellings of the same query: as is, upper, leading and trailing spaces."""
    m = F.pmod(selector, F.lit(4))
    return (F.when(m == 0, q).when(m == 1, F.upper(q))
            .when(m == 2, F.concat(F.lit("  "), q)).otherwise(F.concat(q, F.lit(" "))))


def _as_utc(ts):
    return ts.cast("timestamp")


EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def searches_s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return s1_from_events(table(spark, sf_dir, "events"))


def s1_from_events(ev: DataFrame) -> DataFrame:
    """S1 columns from ``events`` rows (also used on the streaming source)."""
    q = F.concat(F.col("event_type"), F.lit(" "), F.get_json_object("props", "$.k"))
    return ev.select(
        F.concat(F.lit("client-"), F.pmod("event_id", F.lit(3)).cast("string")).alias("client_id"),
        _as_utc(F.col("ts")).alias("timestamp"),
        F.col("user_id").cast("string").alias("username"),
        _noisy(q, F.col("event_id")).alias("query"))


def searches_s1c(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return s1c_from_events(table(spark, sf_dir, "events"))


def s1c_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.concat(F.lit("client-"), F.pmod("event_id", F.lit(3)).cast("string")).alias("client_id"),
        _as_utc(F.col("ts")).alias("timestamp"),
        F.col("user_id").cast("string").alias("username"),
        F.col("event_type").alias("query"))


def searches_s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    # lineitem x orders is a large-large join at scale: hash-partitioning the
    # line items on the join key is the exchange a sort-merge join needs anyway,
    # and it spreads a single unsplittable input file over all cores here.
    li = (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
          .repartition("l_orderkey"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                               "o_orderpriority")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey))
    return j.select(
        F.col("o_orderpriority").alias("client_id"),
        _as_utc(F.col("o_orderdate")).alias("timestamp"),
        F.col("o_custkey").cast("string").alias("username"),
        _noisy(F.col("p_name"), F.col("l_linenumber")).alias("query"))


def documents_as_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.lower(F.trim("text")).alias("query"))


def s1_window() -> tuple[_dt.datetime, _dt.datetime]:
    """(start, end) of the S1 analysis window: end = as_of - offset, start = end - hours."""
    end = S1_AS_OF - _dt.timedelta(minutes=S1_OFFSET_MIN)
    return end - _dt.timedelta(hours=S1_HOURS), end


# DuckDB text of the same fixtures, used by the oracle SQL.
S1_SQL = """(SELECT 'client-' || CAST(event_id % 3 AS VARCHAR) AS client_id, ts AS "timestamp",
       CAST(user_id AS VARCHAR) AS username,
       CASE event_id % 4 WHEN 0 THEN q WHEN 1 THEN upper(q) WHEN 2 THEN '  ' || q ELSE q || ' ' END AS query
FROM (SELECT *, event_type || ' ' || json_extract_string(props, '$.k') AS q FROM events))"""

S1C_SQL = """(SELECT 'client-' || CAST(event_id % 3 AS VARCHAR) AS client_id, ts AS "timestamp",
       CAST(user_id AS VARCHAR) AS username, event_type AS query FROM events)"""

S2_SQL = """(SELECT o_orderpriority AS client_id, o_orderdate AS "timestamp", CAST(o_custkey AS VARCHAR) AS username,
       CASE l_linenumber % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name)
                             WHEN 2 THEN '  ' || p_name ELSE p_name || ' ' END AS query
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

DOC_SQL = "(SELECT doc_id, lower(trim(text)) AS query FROM documents)"
