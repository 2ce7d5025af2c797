"""Table maintenance as DataFrame -> DataFrame steps (the new table version).

Parquet tables have no MERGE; each step computes the next version of a table
from the current one with joins and unions, and the sinks write it to a new
path (see ``sources.sinks``), so a failure half-way leaves the old version
readable and no plan overwrites a path it reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as E
from ..sources.scans import deleted_months

Q = "query_normalized"


def _merged(existing: DataFrame, new: DataFrame, keys: list[str], wins: bool) -> DataFrame:
    """Rows of both sides; of keys on both, the new rows (``wins``) or the old ones.
    A null in a key meets nothing. Each side is computed once: a join against its own
    keys would compute it again, since only the keys are asked for there."""
    rows = (existing.withColumn("_new", F.lit(False))
            .unionByName(new.select(existing.columns).withColumn("_new", F.lit(True))))
    side = F.col("_new") == F.lit(wins)
    rows = rows.withColumn("_met", F.max(side).over(Window.partitionBy(*keys)))
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return rows.where(side | ~F.col("_met") | no_key).select(existing.columns)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert; on key conflict the new row replaces the old one (last wins)."""
    return _merged(existing, new, keys, True)


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert; on key conflict the old row stays (first wins)."""
    return _merged(existing, new, keys, False)


def new_user_query_pairs(searches: DataFrame, as_of, month: str | None = None) -> DataFrame:
    """Distinct (username, normalised query) of the raw log (optionally one
    month), stamped with the run date."""
    s = searches
    if month is not None:
        from ..sources.scans import scan_month
        s = scan_month(s, month)
    return (s.select("username", E.normalize_query("query").alias(Q)).distinct()
            .withColumn("last_seen", F.lit(as_of).cast("date")))


def upsert_user_query_pairs(existing: DataFrame, new_pairs: DataFrame) -> DataFrame:
    """Conflict on (username, query) refreshes last_seen."""
    return upsert(existing, new_pairs, ["username", Q])


def current_user_query_pairs(pair_log: DataFrame) -> DataFrame:
    """The pairs table from its append-only log (one partition per archived
    month): the latest last_seen per (username, query) - the same rows an
    upsert with "conflict refreshes last_seen" leaves, since run dates only
    grow."""
    return pair_log.groupBy("username", Q).agg(F.max("last_seen").alias("last_seen"))


def upsert_period_summary(existing: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(existing, new, ["period_type", "period_id"])


def refresh_query_daily(old: DataFrame, new: DataFrame, known: DataFrame,
                        backfill: DataFrame | None, min_live_date) -> DataFrame:
    """Known queries: rows from the first live date on are replaced; newly
    eligible (backfilled) queries: all their rows are replaced."""
    k = known.select(Q).distinct().withColumn("_known", F.lit(True))
    o = old.join(k, Q, "left")
    drop = F.col("_known").isNotNull()
    if min_live_date is not None:
        drop = drop & (F.col("date") >= F.lit(min_live_date).cast("date"))
    o = o.where(~drop).drop("_known")
    if backfill is not None:
        o = o.join(backfill.select(Q).distinct(), Q, "left_anti")
    return o.select(old.columns).unionByName(new.select(old.columns))


def months_to_archive(searches: DataFrame, ledger: DataFrame, current_month: str) -> DataFrame:
    """Months before the current one that still have live rows and are not
    marked deleted in the ledger (an anti join: a null ledger month cannot
    hide everything as NOT IN would), in month order."""
    key = F.col("month") if "month" in searches.columns else E.month_key("timestamp")
    months = (searches.select(key.alias("month")).distinct()
              .where(F.col("month") < F.lit(current_month)))
    return months.join(deleted_months(ledger), "month", "left_anti").orderBy("month")


def ledger_append(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    return ledger.unionByName(entries.select(ledger.columns))


def ledger_mark_deleted(ledger: DataFrame, month: str) -> DataFrame:
    return ledger.withColumn("deleted", F.when(F.col("month") == month, F.lit(True))
                             .otherwise(F.col("deleted")))


def delete_month(searches: DataFrame, month: str) -> DataFrame:
    """The raw log without one month (written as the next version)."""
    from ..sources.scans import month_range
    start, end = month_range(month)
    ts = F.col("timestamp")
    return searches.where((ts < E.ts_lit(start)) | (ts >= E.ts_lit(end)) | ts.isNull())


def blacklist_delete_pairs(pairs: DataFrame, patterns: list[str]) -> DataFrame:
    return pairs.where(~E.is_blacklisted(Q, patterns))


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Schema evolution: add absent columns of ``schema`` as nulls, in order."""
    have = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols)


def merge_cumulative(current: DataFrame, month_rows: DataFrame, month: str) -> DataFrame:
    """Add a month's additive totals to the one-row cumulative table: count,
    earliest and latest search, per-client counts (a map with one entry per
    client). An empty month changes nothing. Works on an empty table too."""
    m = month_rows.groupBy("client_id").agg(F.count(F.lit(1)).alias("n"),
                                            F.min("timestamp").alias("f"),
                                            F.max("timestamp").alias("l"))
    cur = current.select(F.explode_outer("client_totals").alias("client_id", "n"),
                         F.col("first_search").alias("f"), F.col("last_search").alias("l"),
                         F.col("total_searches").alias("_tot"),
                         F.col("last_archive_month").alias("_lam"))
    cur = cur.select("client_id", F.col("n").cast("bigint").alias("n"), "f", "l", "_tot", "_lam")
    mm = m.select("client_id", "n", "f", "l", F.lit(None).cast("bigint").alias("_tot"),
                  F.lit(None).cast("string").alias("_lam"))
    u = cur.unionByName(mm).withColumn("_m", F.lit(1))
    month_n = m.agg(F.sum("n")).scalar()
    per_client = u.where(F.col("client_id").isNotNull()).groupBy("client_id").agg(
        F.sum("n").alias("n"))
    totals = u.agg(F.min("f").alias("first_search"), F.max("l").alias("last_search"),
                   F.max("_tot").alias("_tot"), F.max("_lam").alias("_lam"))
    clients = per_client.agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("client_id", "n")))).alias("client_totals"))
    has_month = F.coalesce(month_n, F.lit(0)) > 0
    total = F.coalesce(F.col("_tot"), F.lit(0)) + F.coalesce(month_n, F.lit(0))
    return totals.select(
        total.cast("bigint").alias("total_searches"), "first_search", "last_search",
        F.coalesce(clients.scalar(), F.create_map().cast("map<string,bigint>"))
        .alias("client_totals"),
        F.when(has_month, F.lit(month)).otherwise(F.col("_lam")).alias("last_archive_month"))


def month_totals(month_rows: DataFrame) -> DataFrame:
    """Additive totals of one month per client: searches, first, last."""
    return month_rows.groupBy("client_id").agg(F.count(F.lit(1)).alias("n"),
                                               F.min("timestamp").alias("first_search"),
                                               F.max("timestamp").alias("last_search"))


def cumulative_from_month_totals(totals: DataFrame) -> DataFrame:
    """The one-row cumulative table rebuilt from per-month totals (rows of
    (month, client_id, n, first_search, last_search); one row per client and
    month, so the client map is bounded by the number of clients)."""
    per_client = totals.groupBy("client_id").agg(F.sum("n").alias("n"))
    clients = per_client.agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("client_id", "n")))).alias("m")).scalar()
    return totals.agg(F.sum("n").cast("bigint").alias("total_searches"),
                      F.min("first_search").alias("first_search"),
                      F.max("last_search").alias("last_search"),
                      F.max("month").alias("last_archive_month")).select(
        "total_searches", "first_search", "last_search",
        F.coalesce(clients, F.create_map().cast("map<string,bigint>")).alias("client_totals"),
        "last_archive_month")
