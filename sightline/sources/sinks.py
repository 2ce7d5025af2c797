"""Writers: archives, versioned tables, period partitions and exports.

All paths are under a warehouse root on the shared file system (on a
cluster: a folder such as the one named by ``spark.checkpoint.dir``); files
are listed and removed through the Hadoop FileSystem API so the same code runs
on HDFS / object stores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as E
from ..session import ensure_checkpoint_dir


def warehouse_root(spark: SparkSession, name: str = "sightline-warehouse") -> str:
    """A folder next to the session's shared checkpoint folder."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/" + name


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True) if fs.exists(p) else False


def path_size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


# ---------------------------------------------------------------------------
# Versioned tables: <root>/<table>/v=<n>; the newest version with _SUCCESS is
# current. A failed write never becomes current; readers never see half data.
# ---------------------------------------------------------------------------

def _versions(spark: SparkSession, table_path: str) -> list[int]:
    out = []
    for d in list_dirs(spark, table_path):
        if d.startswith("v=") and d[2:].isdigit() and path_exists(
                spark, f"{table_path}/{d}/_SUCCESS"):
            out.append(int(d[2:]))
    return sorted(out)


def current_version(spark: SparkSession, table_path: str) -> str | None:
    v = _versions(spark, table_path)
    return f"{table_path}/v={v[-1]}" if v else None


def read_table(spark: SparkSession, table_path: str, schema=None) -> DataFrame | None:
    cur = current_version(spark, table_path)
    if cur is None:
        return spark.createDataFrame([], schema) if schema is not None else None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(cur)


def write_version(df: DataFrame, table_path: str, partition_by: list[str] | None = None,
                  keep: int = 2) -> str:
    """Write ``df`` as the next version and return its path; old versions
    beyond ``keep`` are removed after the new one is complete."""
    spark = df.sparkSession
    v = _versions(spark, table_path)
    nxt = (max(v) + 1) if v else 1
    path = f"{table_path}/v={nxt}"
    delete_path(spark, path)   # leftovers of a failed attempt at this version
    w = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        # a session in dynamic mode would write no _SUCCESS
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    w.parquet(path)
    for old in v[:-keep + 1] if keep > 1 else v:
        delete_path(spark, f"{table_path}/v={old}")
    return path


# ---------------------------------------------------------------------------
# Period tables: versioned, partitioned by (period_type, period_id)
# ---------------------------------------------------------------------------

def replace_period_partitions(df: DataFrame, path: str, recomputed: DataFrame,
                              order: str | None = None) -> str:
    """Write the next version of a period table and return its path: the rows of
    ``df``, and of every period neither in ``df`` nor recomputed the rows it had.
    A recomputed period without rows is thereby emptied.

    Readers (``read_table``) see the old version whole until the new one is
    whole. The price is that unchanged periods are copied; they are aggregated
    rows. Rows are range-partitioned on (period, ``order``) before the write:
    each task holds a contiguous run of periods, so a period lands in one file
    (or a few, for a period too large for one task, such as all_time),
    instead of every task writing a small file for every period."""
    spark = df.sparkSession
    period = ["period_type", "period_id"]
    keys = period + ([order] if order else [])
    columns = df.columns
    df = snapshot(df, f"{path.rstrip('/')}-next")  # evaluated once: written and compared
    redone = recomputed.select(period).unionByName(df.select(period)).distinct()
    old = read_table(spark, path, df.schema).select(columns)
    rows = old.join(redone, period, "left_anti").select(columns).unionByName(df)
    new = write_version(rows.repartitionByRange(*keys).sortWithinPartitions(*keys), path, partition_by=period)
    delete_path(spark, f"{path.rstrip('/')}-next")
    return new


# ---------------------------------------------------------------------------
# Archives
# ---------------------------------------------------------------------------

def by_month(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a month (and of the further ``keys``) together, for a write
    partitioned by them: about one file per month, and a month too large for one task is
    split by size. Unlike a range partitioning this samples nothing, so what is
    written is computed once, and no task writes to every month."""
    return df.hint("rebalance", *keys, "month")


def archive_raw_month(searches: DataFrame, month: str, root: str) -> tuple[str, int, int]:
    """One month of the raw log as Parquet/snappy in timestamp order.
    Returns (path, rows, bytes); the row count is observed during the write."""
    from .scans import scan_month
    spark = searches.sparkSession
    obs = Observation(f"archive_{month}")
    rows = scan_month(searches, month).select("client_id", "timestamp", "username", "query")
    path = f"{root}/searches/month={month}"
    # observe after the range exchange: the exchange's sampling job must not
    # be the action that reports the metric
    (rows.repartitionByRange("timestamp").sortWithinPartitions("timestamp")
     .observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("compression", "snappy").parquet(path))
    return path, int(obs.get["rows"]), path_size(spark, path)


def archive_daily_tuples(tuples: DataFrame, month: str | None, root: str
                         ) -> tuple[str, int, int]:
    """The daily tuples of one month (or of every month in ``tuples`` when
    ``month`` is None) into the month-partitioned archive; dynamic overwrite
    replaces only the partitions written."""
    spark = tuples.sparkSession
    obs = Observation(f"tuples_{month or 'all'}")
    t = tuples.withColumn("month", E.month_key("date"))
    if month is not None:
        t = t.where(F.col("month") == month)
    path = f"{root}/daily_tuples"
    (by_month(t)
     .observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").option("compression", "snappy").parquet(path))
    out = f"{path}/month={month}" if month else path
    return out, int(obs.get["rows"]), path_size(spark, out)


# ---------------------------------------------------------------------------
# Exports
# ---------------------------------------------------------------------------

def export_queries_json(top: DataFrame, slugs: DataFrame | None, path: str) -> str:
    """JSON lines {rank, query, unique_users, total_searches, slug?} of one list."""
    t = top.select("rank", F.col("query_normalized").alias("query"), "unique_users",
                   "total_searches")
    if slugs is not None:
        t = t.join(slugs.select(F.col("query_normalized").alias("query"), "slug"), "query", "left")
    t.orderBy("rank").write.mode("overwrite").json(path)
    return path


def export_period_lists(top: DataFrame, slugs: DataFrame | None, blacklist: list[str], path: str) -> str:
    """JSON lines of the lists of all periods (``period_type=/period_id=``):
    blacklisted queries are removed first and the rest numbered anew."""
    from ..operators.ranking import rank_within
    keys = ["period_type", "period_id"]
    kept = top.where(~E.is_blacklisted("query_normalized", blacklist))
    t = rank_within(kept.withColumnRenamed("rank", "_old"), keys, [F.col("_old").asc()])
    t = t.select(*keys, "rank", F.col("query_normalized").alias("query"), "unique_users", "total_searches")
    if slugs is not None:
        t = t.join(slugs.select(F.col("query_normalized").alias("query"), "slug"), "query", "left")
    (t.repartitionByRange(*keys, "rank").sortWithinPartitions(*keys, "rank")
     .write.mode("overwrite").partitionBy(*keys).json(path))
    return path


def export_search_index(index: DataFrame, path: str) -> str:
    """One JSON object {q, u, t, s?} per line, users desc; s omitted if null."""
    (index.orderBy(F.col("u").desc(), F.col("t").desc(), F.col("q"))
     .select(F.to_json(F.struct("q", "u", "t", "s")).alias("value"))
     .write.mode("overwrite").text(path))
    return path


# Sort order of the detail tables: a point lookup on the first column skips
# the files and row groups whose range does not hold it.
DETAIL_ORDER = {"queries": ["slug", "rank"], "word_index": ["word", "rank"],
                "query_daily": ["rank", "date"], "query_similar": ["rank", "similar_rank"],
                "grams": ["gram", "rank"], "entries": ["q"], "entry_grams": ["gram", "q"], "suggestions": ["term", "place"]}


def export_detail_tables(root: str, tables: dict[str, DataFrame]) -> dict[str, str]:
    """Write the detail and search tables (the names of ``DETAIL_ORDER``), each
    range-partitioned and sorted on its lookup column."""
    out = {}
    for name, df in tables.items():
        p = f"{root}/{name}"
        keys = DETAIL_ORDER[name]
        (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
         .write.mode("overwrite").parquet(p))
        out[name] = p
    return out


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once to a run-scoped Parquet folder and read it back, so
    every later read is a file scan and the lineage is cut (an executor lost
    later does not recompute the inputs). Delete the folder after the run."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------------------
# Tables fed by micro-batches: one folder per batch, folded by key on read
# ---------------------------------------------------------------------------

def write_batch(new: DataFrame, table: str, batch_id: int) -> None:
    """Write the changed groups of one micro-batch to the batch's own folder.
    A replayed batch overwrites only its own folder; nothing that an earlier
    batch wrote is read, moved or rewritten."""
    new.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")


def _complete(spark: SparkSession, table: str, kind: str) -> list[int]:
    """Numbers of the folders ``kind=<n>`` whose write finished."""
    return sorted(int(d.split("=")[1]) for d in list_dirs(spark, table)
                  if d.startswith(f"{kind}=") and path_exists(spark, f"{table}/{d}/_SUCCESS"))


def read_batches(spark: SparkSession, table: str, schema, keys: list[str]) -> DataFrame:
    """The table as of the last complete batch: per key the row of the latest
    batch (update mode sends the whole group again). A batch folder without
    ``_SUCCESS`` is a write that did not finish; its batch will be replayed.
    A folder ``upto=<n>`` holds batches up to n folded (``compact_batches``)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    base = max(_complete(spark, table, "upto"), default=None)
    after = [n for n in _complete(spark, table, "batch_id") if base is None or n > base]
    parts = [(n, f"{table}/batch_id={n}") for n in after]
    if base is not None:
        parts.append((base, f"{table}/upto={base}"))
    if not parts:
        return spark.createDataFrame([], schema)
    # the folder's number orders the rows; it is the last part of the path
    rows = spark.read.schema(schema).parquet(*[path for _, path in parts])
    number = F.regexp_extract(F.col("_metadata.file_path"), r"(?:batch_id|upto)=(\d+)/[^/]*$", 1).cast("bigint")
    rest = [f.name for f in schema.fields if f.name not in keys]
    latest = (rows.select(*schema.names, number.alias("_n")).groupBy(*keys)
              .agg(F.max_by(F.struct(*rest), "_n").alias("_last")))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c)
                           for c in schema.names])


def compact_batches(spark: SparkSession, table: str, schema, keys: list[str], grace: bool = False) -> None:
    """Fold all complete batches into one folder. Readers use it from the
    moment its write is complete; only then the folders it replaces go, so a
    crash at any step leaves a table that reads the same. With ``grace`` what
    was replaced stays until the next fold, for readers that had begun."""
    batches, folded = _complete(spark, table, "batch_id"), _complete(spark, table, "upto")
    last = max(batches, default=None)
    if last is not None and (not folded or last > folded[-1]):
        read_batches(spark, table, schema, keys).write.mode("overwrite").parquet(f"{table}/upto={last}")
        folded.append(last)
    done = folded[-2:-1] if grace else folded[-1:]
    if done:
        for kind, numbers, bound in (("upto", folded, done[0] - 1 if grace else folded[-1] - 1),
                                     ("batch_id", batches, done[0])):
            for n in numbers:
                if n <= bound:
                    delete_path(spark, f"{table}/{kind}={n}")


# ---------------------------------------------------------------------------
# The raw log: ``month=`` folders that jobs wrote, or ``batch=`` folders with
# months inside that a stream wrote. A batch counts once it is complete.
# ---------------------------------------------------------------------------

def write_log_batch(rows: DataFrame, log: str, stream: str, batch_id: int) -> None:
    """Append one micro-batch of stream ``stream``. A replay replaces what the
    batch left unfinished; a complete batch is never written again, since its
    files may be archived and gone by then."""
    spark, path = rows.sparkSession, f"{log}/batch={stream}-{batch_id:010d}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        (rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("month").parquet(path))


def _log_batches(spark: SparkSession, log: str) -> list[str]:
    return [d for d in list_dirs(spark, log) if d.startswith("batch=") and path_exists(spark, f"{log}/{d}/_SUCCESS")]


def committed_files(spark: SparkSession, log: str) -> list[tuple[str, str, int]]:
    """(month, path, bytes) of the log's files; those of a batch that did not
    finish are not there yet."""
    places = [log, *(f"{log}/{d}" for d in _log_batches(spark, log))]
    return [(d[len("month="):], f, n) for place in places for d in list_dirs(spark, place) if d.startswith("month=")
            for f, n in list_files(spark, f"{place}/{d}")]


def drop_empty_batches(spark: SparkSession, log: str) -> None:
    """Remove batch folders whose files are all gone, but for the last batch of
    each stream, which might be replayed."""
    batches = _log_batches(spark, log)
    last = {d.rsplit("-", 1)[0]: d for d in batches}  # names sort by number
    for d in batches:
        if d not in last.values() and not any(list_files(spark, f"{log}/{d}/{m}") for m in list_dirs(spark, f"{log}/{d}")):
            delete_path(spark, f"{log}/{d}")


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that stays with a checkpoint folder: batch numbers begin anew in
    another one."""
    path = f"{checkpoint.rstrip('/')}/log-name"
    if not path_exists(spark, path):
        import uuid
        fs, p = _fs(spark, path)
        out = fs.create(p)
        out.writeBytes(uuid.uuid4().hex)
        out.close()
    return spark.read.text(path).first()[0]


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files directly in a folder."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().toString(), int(s.getLen())) for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName()[0] not in "._")


def drop_partition(spark: SparkSession, table: str, column: str, value: str) -> bool:
    """Remove one partition folder (e.g. an archived month of the raw log)."""
    return delete_path(spark, f"{table.rstrip('/')}/{column}={value}")
