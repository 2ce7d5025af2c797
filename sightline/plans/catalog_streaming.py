"""Registered streaming jobs: each drains a stream over the ``events`` table
(file source, availableNow trigger) and returns the table it left behind."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import fixtures as FX
from ..sources import scans as SC
from ..sources import sinks as SK
from ..streaming import jobs as SJ
from . import jobs as J
from . import oracle as O
from .catalog import AS_OF, SALT
from .catalog_maintenance import run_dir
from .registry import register

ONCE = {"availableNow": True}


def events_stream(spark, sf):
    FX.configure(spark)
    return SJ.read_raw_stream(spark, sf, FX.EVENTS_SCHEMA, glob="events.parquet", max_files=1)


def _ingest(spark, sf):
    base = run_dir(spark, "stream_ingest")
    q = SJ.start_ingest(FX.s1_from_events(events_stream(spark, sf)), FX.TEST_SALT,
                        f"{base}/log", f"{base}/_checkpoint", ONCE)
    SJ.drain(q)
    return q, f"{base}/log"


@register("stream_ingest", f"""
SELECT client_id, "timestamp", sha256('{SALT}' || username) AS username, query
FROM {O.S1_SQL} s WHERE username IS NOT NULL AND query IS NOT NULL""")
def q_stream_ingest(spark, sf):
    _, path = _ingest(spark, sf)
    back = SC.scan_log(spark, path).select("client_id", "timestamp", "username", "query")
    return back.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("stream_archive", f"""
WITH s AS (SELECT client_id, "timestamp", sha256('{SALT}' || username) AS username, query,
                  strftime("timestamp", '%Y-%m') AS month FROM {O.S1_SQL} s
           WHERE username IS NOT NULL AND query IS NOT NULL)
SELECT *, CASE WHEN month < (SELECT max(month) FROM s) THEN 'archive' ELSE 'log' END AS place FROM s""")
def q_stream_archive(spark, sf):
    """The streamed log archived up to its last month and deleted: every row is
    in one place, and both can be read."""
    _, log = _ingest(spark, sf)
    root = run_dir(spark, "stream_archive")
    last = max(m for m, _, _ in SK.committed_files(spark, log))
    J.archive_job(spark, root, log, last, AS_OF, delete_after=True)
    cols = ["client_id", "timestamp", "username", "query", "month"]
    rows = SC.scan_log(spark, log).select(*cols, F.lit("log").alias("place"))
    if SK.path_exists(spark, f"{root}/archive/searches"):
        rows = rows.unionByName(SC.scan_archive(spark, f"{root}/archive/searches").select(
            *cols, F.lit("archive").alias("place")))
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("stream_metrics", f"""
SELECT CAST(0 AS BIGINT) AS batch_id, COUNT(*) AS input_rows, COUNT(*) AS "rows",
       CAST(SUM(CASE WHEN username IS NULL OR query IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS dropped
FROM {O.S1_SQL} s""")
def q_stream_metrics(spark, sf):
    path = f"{run_dir(spark, 'stream_metrics')}/table"
    listener = SJ.record_metrics(spark, path)
    try:
        q, _ = _ingest(spark, sf)
    finally:
        SJ.stop_metrics(spark, listener)
    return SJ.read_metrics(spark, path).where((F.col("query") == str(q.id)) & (F.col("input_rows") > 0)).select(
        "batch_id", "input_rows", "rows", "dropped")


@register("stream_daily_tuples", f"SELECT * FROM {O.tuples(O.S1_SQL)}")
def q_stream_daily_tuples(spark, sf):
    base = run_dir(spark, "stream_daily_tuples")
    q = SJ.start_daily_tuples(FX.s1_from_events(events_stream(spark, sf)), f"{base}/table",
                              f"{base}/_checkpoint", ONCE)
    SJ.drain(q)
    return SJ.read_daily_tuples(spark, f"{base}/table")


@register("stream_convergence", f"""
WITH ec AS (SELECT username, lower(trim(query)) AS norm_query,
                   CAST(floor(epoch_us("timestamp") / {FX.S1C_WINDOW_SECONDS * 1_000_000}.0) AS BIGINT) AS tb,
                   COUNT(DISTINCT client_id) AS client_count FROM {O.S1C_SQL} s GROUP BY 1, 2, 3)
SELECT client_count, COUNT(*) AS event_count FROM ec GROUP BY 1""")
def q_stream_convergence(spark, sf):
    base = run_dir(spark, "stream_convergence")
    q = SJ.start_event_clients(FX.s1c_from_events(events_stream(spark, sf)), f"{base}/table",
                               f"{base}/_checkpoint", FX.S1C_WINDOW_SECONDS, ONCE)
    SJ.drain(q)
    table = SJ.read_event_clients(spark, f"{base}/table")
    return table.groupBy("client_count").agg(F.count(F.lit(1)).alias("event_count"))
