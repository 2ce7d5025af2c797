"""Structured Streaming jobs.

* ``ingest``          raw events -> pseudonymised, month-partitioned Parquet log
* ``daily_tuples``    keeps the daily tuples current (instead of a nightly refresh)
* ``event_clients``   the convergence event table, kept current
* metrics             rows in / rows dropped per micro-batch via ``observe``

Offsets and state live in the checkpoint folder, so a restarted query resumes
where it stopped (no requeue / backoff logic needed). Aggregating streams run
in update mode into ``foreachBatch``; each batch writes its changed groups to a
folder of its own (a replay overwrites only that) and readers fold the batches
by key. The event-time watermark closes groups and bounds the state kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import schema as S
from ..functions import expr as E
from ..sources import sinks as SK

RAW_EVENTS = "client_id STRING, timestamp TIMESTAMP, username STRING, query STRING"


def read_raw_stream(spark: SparkSession, path: str, schema: str = RAW_EVENTS,
                    glob: str | None = None, max_files: int = 100) -> DataFrame:
    """A file source (Kafka in production: same downstream code)."""
    r = spark.readStream.format("parquet").schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def observe_batches(df: DataFrame, name: str = "ingest") -> DataFrame:
    """Per micro-batch: rows seen and rows without username or query."""
    bad = F.col("username").isNull() | F.col("query").isNull()
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      F.sum(bad.cast("long")).alias("dropped"))


def pseudonymized(df: DataFrame, key: str) -> DataFrame:
    """Salted sha256 user ids; rows without username or query are dropped."""
    return (df.where(F.col("username").isNotNull() & F.col("query").isNotNull())
            .withColumn("username", E.pseudonymize("username", key))
            .withColumn("month", E.month_key("timestamp")))


def start_ingest(events: DataFrame, key: str, sink: str, checkpoint: str,
                 trigger: dict | None = None, dedupe_within: str | None = None):
    """Append the pseudonymised log, partitioned by month (10 s micro-batches
    by default; the source's maxFilesPerTrigger / maxOffsetsPerTrigger caps a
    batch, as the collector's 10 000-row flush did). With ``dedupe_within``
    (e.g. "10 minutes") an event delivered twice within that event-time span
    is written once (state bounded by the watermark).

    Every batch owns a folder of the log (``sinks.write_log_batch``): it counts when
    it is complete, a replay replaces or skips it, and files may be archived and
    deleted without any list of the stream's going wrong. ``scans.scan_log`` reads it."""
    if dedupe_within:
        events = (events.withWatermark("timestamp", dedupe_within)
                  .dropDuplicatesWithinWatermark(["client_id", "timestamp", "username", "query"]))
    out = pseudonymized(observe_batches(events), key)
    name = SK.stream_name(events.sparkSession, checkpoint)
    w = (out.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
         .foreachBatch(lambda batch, n: SK.write_log_batch(batch, sink, name, n)))
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Aggregation state (a day of distinct tuples / a window of events) lives
    in RocksDB on local disk with changelog checkpoints, not in executor heap.
    Must be set before a query first starts (it is recorded in the checkpoint)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
                   "true")


def skip_empty_batches(spark: SparkSession) -> None:
    """No batch without rows after the last one with rows: in update mode it changes no
    group, yet left an empty folder, and a crash then lost that folder's commit and not
    the one of the rows before it. Closed groups leave the state with the next rows.
    Like the state's settings, read when a query starts."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")


DAILY_KEYS = ["date", "username", "query_normalized"]
EVENT_KEYS = ["username", "norm_query", "time_bucket"]
EVENT_CLIENTS = ("username STRING, norm_query STRING, time_bucket BIGINT, client_count BIGINT, "
                 "earliest TIMESTAMP, latest TIMESTAMP, day DATE")


FOLD_EVERY = 360  # batches: an hour of the default trigger


def _write_batch(table: str, schema, keys: list[str], fold_every: int):
    """foreachBatch sink: the changed groups of a batch in the batch's folder;
    every so many batches the folders are folded into one, so a reader never
    lists more than two such spans."""
    def write(batch: DataFrame, batch_id: int) -> None:
        SK.write_batch(batch, table, batch_id)
        if (batch_id + 1) % fold_every == 0:
            SK.compact_batches(batch.sparkSession, table, schema, keys, grace=True)
    return write


def read_daily_tuples(spark: SparkSession, table: str) -> DataFrame:
    return SK.read_batches(spark, table, S.DAILY_TUPLES, DAILY_KEYS)


def read_event_clients(spark: SparkSession, table: str) -> DataFrame:
    return SK.read_batches(spark, table, EVENT_CLIENTS, EVENT_KEYS)


def daily_tuples_stream(searches: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Daily tuples kept current in update mode. Rows arriving later than the
    watermark after their day closed are left to the nightly month-partition
    refresh (``rollup.refresh_rollups``), which recomputes from the raw log."""
    return (searches.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", "1 day").alias("w"), F.col("username"),
                     E.normalize_query("query").alias("query_normalized"))
            .agg(F.count(F.lit(1)).alias("search_count"))
            .select(F.to_date(F.col("w.start")).alias("date"), "username", "query_normalized",
                    "search_count"))


def start_daily_tuples(searches: DataFrame, table: str, checkpoint: str,
                       trigger: dict | None = None, watermark: str = "10 minutes",
                       fold_every: int = FOLD_EVERY):
    use_rocksdb_state(searches.sparkSession)
    skip_empty_batches(searches.sparkSession)
    q = (daily_tuples_stream(searches, watermark).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(_write_batch(table, S.DAILY_TUPLES, DAILY_KEYS, fold_every)))
    return q.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def event_clients_stream(searches: DataFrame, window_seconds: int = 300,
                         watermark: str = "10 minutes") -> DataFrame:
    """Per (user, query, time bucket): number of distinct clients and the first
    and last sighting (distinct counts are not allowed on streams; the set of
    clients per event is bounded by the number of clients)."""
    # an event-time window (not a bare bucket number) keeps the watermark on
    # the key, so closed windows leave the state; windows start at multiples
    # of their length since the epoch, which makes the bucket its number
    bucket = F.unix_timestamp("w.start") / F.lit(window_seconds)
    return (searches.withWatermark("timestamp", watermark)
            .groupBy(F.window("timestamp", f"{window_seconds} seconds").alias("w"),
                     F.col("username"), E.normalize_query("query").alias("norm_query"))
            .agg(F.size(F.collect_set("client_id")).cast("bigint").alias("client_count"),
                 F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))
            .select("username", "norm_query", bucket.cast("bigint").alias("time_bucket"),
                    "client_count", "earliest", "latest", F.to_date("w.start").alias("day")))


def start_event_clients(searches: DataFrame, table: str, checkpoint: str,
                        window_seconds: int = 300, trigger: dict | None = None,
                        watermark: str = "10 minutes", fold_every: int = FOLD_EVERY):
    use_rocksdb_state(searches.sparkSession)
    skip_empty_batches(searches.sparkSession)
    q = (event_clients_stream(searches, window_seconds, watermark).writeStream
         .outputMode("update")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(_write_batch(table, EVENT_CLIENTS, EVENT_KEYS, fold_every)))
    return q.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def drain(query) -> None:
    """Wait for an availableNow / once query to finish, however long its
    backlog takes, and surface its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


BATCH_METRICS = "query STRING, batch_id BIGINT, input_rows BIGINT, rows BIGINT, dropped BIGINT, backlog BIGINT"


class BatchMetrics(StreamingQueryListener):
    """Appends the observed metrics of every micro-batch to a table, for as
    long as it is registered (``recentProgress`` keeps the last 100 only).
    ``backlog`` is the number of rows or files still waiting, where the source
    tells it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        m = (p.observedMetrics or {}).get("ingest")
        waiting = [int(v) for s in p.sources for k, v in (s.metrics or {}).items()
                   if k in ("numFilesOutstanding", "maxOffsetsBehindLatest")]
        row = (str(p.id), p.batchId, p.numInputRows, m and m["rows"], m and m["dropped"],
               sum(waiting) if waiting else None)
        self.spark.createDataFrame([row], BATCH_METRICS).coalesce(1).write.mode("append").parquet(self.path)


def record_metrics(spark: SparkSession, path: str) -> BatchMetrics:
    listener = BatchMetrics(spark, path)
    spark.streams.addListener(listener)
    return listener


def stop_metrics(spark: SparkSession, listener: BatchMetrics) -> None:
    """Unregister after all progress events that are under way have arrived."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BATCH_METRICS).parquet(path)
