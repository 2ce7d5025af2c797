"""Registered jobs: scans, sinks, table maintenance, daily client statistics,
overviews and periods bookkeeping.

Archive / live scenario (all derived from S2 by date, never by id):
archived part = days before 2001-01-01, live part = days from 2000-12-01 on,
so December 2000 is in both; the ledger marks months before 2000-12 deleted
(December 2000 is archived but not deleted, so it must be read from live
only). A sink job writes into a fresh folder of the session's warehouse and
returns the table read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E
from ..operators import detail as DT
from ..operators import maintenance as M
from ..operators import periods as P
from ..operators import rollup as R
from ..operators import stats as ST
from ..sources import fixtures as FX
from ..sources import scans as SC
from ..sources import sinks as SK
from . import oracle as O
from .catalog import AS_OF, BLACKLIST, BLACKLIST_RX, CONV_CTE, CUTOFF, DETAIL_CTE, TOKEN_SPLIT, s2_tuples
from .registry import ORACLE, once_per_session, register

SPLIT = dt.date(2001, 1, 1)           # first live-only day
LIVE_FROM = dt.date(2000, 12, 1)      # live part starts one month earlier
ARCH_MONTH = "1998-03"
T2A = f"(SELECT * FROM {O.T2} a WHERE date < DATE '{SPLIT}')"
T2L = f"(SELECT * FROM {O.T2} l WHERE date >= DATE '{LIVE_FROM}')"
S2A_WHERE = f"CAST(\"timestamp\" AS DATE) < DATE '{SPLIT}'"
S2L_WHERE = f"CAST(\"timestamp\" AS DATE) >= DATE '{LIVE_FROM}'"
M_START, M_END = SC.month_range(ARCH_MONTH)
MONTH_WHERE = (f"\"timestamp\" >= TIMESTAMP '{M_START.isoformat(sep=' ')}' "
               f"AND \"timestamp\" < TIMESTAMP '{M_END.isoformat(sep=' ')}'")


def run_dir(spark, name: str) -> str:
    return f"{SK.warehouse_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _ntz(df, c="timestamp"):
    return df.withColumn(c, F.col(c).cast("timestamp_ntz"))


@once_per_session
def _stored_searches(spark, sf):
    """S2 joined and written once, as the jobs find a log: for queries that read it several times."""
    return SK.snapshot(FX.searches_s2(spark, sf), run_dir(spark, "searches-s2"))


def t2_parts(spark, sf, searches=None):
    t = s2_tuples(spark, sf) if searches is None else R.daily_search_tuples(searches)
    return t, t.where(F.col("date") < F.lit(SPLIT)), t.where(F.col("date") >= F.lit(LIVE_FROM))


def s2_parts(spark, sf, searches=None):
    s = FX.searches_s2(spark, sf) if searches is None else searches
    d = E.event_date("timestamp")
    return s, s.where(d < F.lit(SPLIT)), s.where(d >= F.lit(LIVE_FROM))


def ledger_for(archived_tuples):
    """Ledger rows of the archived months: deleted unless it is December 2000."""
    return (archived_tuples.groupBy(E.month_key("date").alias("month"))
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select("month", F.concat(F.lit("daily_tuples/month="), F.col("month")).alias("file_path"),
                    "record_count", F.lit(0).cast("bigint").alias("file_size"),
                    F.lit(None).cast("timestamp").alias("archived_at"),
                    (F.col("month") < F.lit("2000-12")).alias("deleted")))


# ---------------------------------------------------------------------------
# Scans and archives
# ---------------------------------------------------------------------------

@register("scan_searches", f"""SELECT client_id, "timestamp", username, query FROM {O.S1_SQL} s
WHERE username IS NOT NULL AND query IS NOT NULL""")
def q_scan_searches(spark, sf):
    path = run_dir(spark, "searches")
    (FX.searches_s1(spark, sf).withColumn("month", E.month_key("timestamp"))
     .write.partitionBy("month").parquet(path))
    return _ntz(SC.scan_searches(spark, path).select("client_id", "timestamp", "username", "query"))


@register("scan_month", f"""SELECT client_id, "timestamp", username, query FROM {O.S2_SQL} s
WHERE {MONTH_WHERE}""")
def q_scan_month(spark, sf):
    return _ntz(SC.scan_month(FX.searches_s2(spark, sf), ARCH_MONTH))


@register("archive_raw_month", f"""SELECT client_id, "timestamp", username, query FROM {O.S2_SQL} s
WHERE {MONTH_WHERE}""")
def q_archive_raw_month(spark, sf):
    root = run_dir(spark, "archive")
    path, rows, size = SK.archive_raw_month(FX.searches_s2(spark, sf), ARCH_MONTH, root)
    back = SC.scan_searches(spark, path)
    if back.count() != rows:
        raise RuntimeError("archived row count differs from the source count")
    return _ntz(back)


@register("archive_daily_tuples", f"SELECT * FROM {T2A}")
def q_archive_daily_tuples(spark, sf):
    _, arch, _ = t2_parts(spark, sf)
    root = run_dir(spark, "archive")
    path, _, _ = SK.archive_daily_tuples(arch, None, root)
    return SC.scan_archived_tuples(spark, path)


@register("scan_archived_tuples", f"SELECT * FROM {T2A}")
def q_scan_archived_tuples(spark, sf):
    _, arch, _ = t2_parts(spark, sf)
    root = run_dir(spark, "archive")
    for m in ("1995-01", "1996-06"):   # month-at-a-time archiving, then the rest
        SK.archive_daily_tuples(arch, m, root)
    SK.archive_daily_tuples(arch, None, root)
    return SC.scan_archived_tuples(spark, f"{root}/daily_tuples")


@register("tuples_all", f"SELECT * FROM {O.T2}")
def q_tuples_all(spark, sf):
    _, arch, live = t2_parts(spark, sf)
    return SC.tuples_all(arch, live, ledger_for(arch))


@register("date_range", f"SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM {O.T2} t")
def q_date_range(spark, sf):
    return P.date_range(s2_tuples(spark, sf))


@register("min_live_date", f"SELECT MIN(date) AS min_live_date FROM {T2L}")
def q_min_live_date(spark, sf):
    _, _, live = t2_parts(spark, sf)
    return P.min_live_date(live)


@register("delete_archived_month", f"""SELECT client_id, "timestamp", username, query FROM {O.S2_SQL} s
WHERE NOT ({MONTH_WHERE})""")
def q_delete_archived_month(spark, sf):
    table = run_dir(spark, "searches")
    (FX.searches_s2(spark, sf).withColumn("month", E.month_key("timestamp"))
     .repartitionByRange("month", "timestamp").write.partitionBy("month").parquet(table))
    SK.drop_partition(spark, table, "month", ARCH_MONTH)
    back = SC.scan_searches_by_month(spark, table)
    return _ntz(back.select("client_id", "timestamp", "username", "query"))


@register("delete_month_rewrite", f"""SELECT client_id, "timestamp", username, query FROM {O.S2_SQL} s
WHERE NOT ({MONTH_WHERE})""")
def q_delete_month_rewrite(spark, sf):
    """The same delete on an unpartitioned log: next version without the month."""
    table = run_dir(spark, "searches")
    SK.write_version(FX.searches_s2(spark, sf), table)
    cur = SK.read_table(spark, table, S.SEARCHES)
    SK.write_version(M.delete_month(cur, ARCH_MONTH), table)
    return _ntz(SK.read_table(spark, table, S.SEARCHES))


@register("archive_ledger", f"""SELECT strftime("timestamp", '%Y-%m') AS month, COUNT(*) AS record_count,
       strftime("timestamp", '%Y-%m') <= '2000-12' AS deleted
FROM {O.S2_SQL} s WHERE {S2A_WHERE} GROUP BY 1""")
def q_archive_ledger(spark, sf):
    s, arch, _ = s2_parts(spark, sf)
    empty = spark.createDataFrame([], S.ARCHIVE_LEDGER)
    entries = (arch.groupBy(E.month_key("timestamp").alias("month"))
               .agg(F.count(F.lit(1)).alias("record_count"))
               .select("month", F.lit("").alias("file_path"), "record_count",
                       F.lit(0).cast("bigint").alias("file_size"),
                       F.lit(None).cast("timestamp").alias("archived_at"),
                       (F.col("month") < "2000-12").alias("deleted")))
    led = M.ledger_mark_deleted(M.ledger_append(empty, entries), "2000-12")
    return led.select("month", "record_count", "deleted")


@register("months_to_archive", f"""SELECT DISTINCT strftime("timestamp", '%Y-%m') AS month FROM {O.S2_SQL} s
WHERE strftime("timestamp", '%Y-%m') < '2001-08' AND strftime("timestamp", '%Y-%m') >= '2000-01'""")
def q_months_to_archive(spark, sf):
    s = FX.searches_s2(spark, sf)
    led = (s.select(E.month_key("timestamp").alias("month")).distinct()
           .where(F.col("month") < "2000-01")
           .select("month", F.lit("").alias("file_path"), F.lit(0).cast("bigint").alias("record_count"),
                   F.lit(0).cast("bigint").alias("file_size"),
                   F.lit(None).cast("timestamp").alias("archived_at"), F.lit(True).alias("deleted")))
    return M.months_to_archive(s, led, "2001-08")


@register("month_additive_stats", f"""SELECT COUNT(*) AS searches, MIN("timestamp") AS first_search,
       MAX("timestamp") AS last_search FROM {O.S2_SQL} s WHERE {MONTH_WHERE}""")
def q_month_additive_stats(spark, sf):
    m = SC.scan_month(FX.searches_s2(spark, sf), ARCH_MONTH)
    return _ntz(_ntz(ST.month_additive_stats(m), "first_search"), "last_search")


@register("month_client_counts", f"""SELECT client_id, COUNT(*) AS n FROM {O.S2_SQL} s
WHERE {MONTH_WHERE} GROUP BY 1""")
def q_month_client_counts(spark, sf):
    return ST.month_client_counts(SC.scan_month(FX.searches_s2(spark, sf), ARCH_MONTH))


# ---------------------------------------------------------------------------
# Upserts, replacement, cumulative totals
# ---------------------------------------------------------------------------

@register("upsert_period_summary", f"""
WITH ex AS {O.summary_sql(T2A)}, nw AS {O.summary_sql(T2L)}
SELECT * FROM ex WHERE (period_type, period_id) NOT IN (SELECT (period_type, period_id) FROM nw)
UNION ALL SELECT * FROM nw""")
def q_upsert_period_summary(spark, sf):
    _, arch, live = t2_parts(spark, sf, _stored_searches(spark, sf))
    return M.upsert_period_summary(ST.period_summary(arch), ST.period_summary(live))


@register("replace_period", f"""
WITH ex AS ({O.top_sql(T2A)}), nw AS ({O.top_sql(T2L)}), rc AS {O.periods_sql(T2L)}
SELECT * FROM ex WHERE (period_type, period_id) NOT IN (SELECT (period_type, period_id) FROM rc)
UNION ALL SELECT * FROM nw""")
def q_replace_period(spark, sf):
    _, arch, live = t2_parts(spark, sf)
    path = run_dir(spark, "period_top_queries")
    SK.replace_period_partitions(ST.period_top_queries(arch), path, arch.limit(0).select(
        F.lit("x").alias("period_type"), F.lit("x").alias("period_id")), "rank")
    SK.replace_period_partitions(ST.period_top_queries(live), path, P.generate_periods(live),
                                 "rank")
    back = SK.read_table(spark, path, S.PERIOD_TOP)
    return back.select(*[f.name for f in S.PERIOD_TOP.fields])


@register("upsert_user_query_pairs", f"""
WITH ex AS (SELECT DISTINCT username, lower(trim(query)) AS query_normalized, DATE '{SPLIT}' AS last_seen
            FROM {O.S2_SQL} s WHERE {S2A_WHERE}),
nw AS (SELECT DISTINCT username, lower(trim(query)) AS query_normalized, DATE '{AS_OF}' AS last_seen
       FROM {O.S2_SQL} s WHERE CAST("timestamp" AS DATE) >= DATE '{SPLIT}')
SELECT * FROM ex WHERE (username, query_normalized) NOT IN (SELECT (username, query_normalized) FROM nw)
UNION ALL SELECT * FROM nw""")
def q_upsert_user_query_pairs(spark, sf):
    s, arch, _ = s2_parts(spark, sf)
    live = s.where(E.event_date("timestamp") >= F.lit(SPLIT))
    return M.upsert_user_query_pairs(M.new_user_query_pairs(arch, SPLIT),
                                     M.new_user_query_pairs(live, AS_OF))


@register("insert_if_absent_daily", f"""
WITH ex AS {O.daily_stats_sql(O.S2_SQL, S2A_WHERE)}, nw AS {O.daily_stats_sql(O.S2_SQL, S2L_WHERE)}
SELECT * FROM ex UNION ALL
SELECT * FROM nw WHERE (client_id, date) NOT IN (SELECT (client_id, date) FROM ex)""")
def q_insert_if_absent_daily(spark, sf):
    _, arch, live = s2_parts(spark, sf)
    return M.insert_if_absent(R.daily_client_stats(arch), R.daily_client_stats(live),
                              ["client_id", "date"])


_CUMULATIVE_S2 = f"""
SELECT client_id, COUNT(*) AS n, (SELECT COUNT(*) FROM {O.S2_SQL} s) AS total_searches,
       (SELECT MIN("timestamp") FROM {O.S2_SQL} s) AS first_search,
       (SELECT MAX("timestamp") FROM {O.S2_SQL} s) AS last_search,
       (SELECT MAX(strftime("timestamp", '%Y-%m')) FROM {O.S2_SQL} s) AS last_archive_month
FROM {O.S2_SQL} x GROUP BY client_id"""


def _cumulative_rows(cur):
    return cur.select(F.explode("client_totals").alias("client_id", "n"), "total_searches",
                      F.col("first_search").cast("timestamp_ntz").alias("first_search"),
                      F.col("last_search").cast("timestamp_ntz").alias("last_search"),
                      "last_archive_month")


@register("merge_cumulative", _CUMULATIVE_S2)
def q_merge_cumulative(spark, sf):
    """All months but the last folded in one pass, the last one merged into
    the stored row, then an empty month."""
    s = FX.searches_s2(spark, sf).withColumn("month", E.month_key("timestamp"))
    SK.warehouse_root(spark)              # makes sure a checkpoint folder is set
    last = s.agg(F.max("month")).first()[0]
    per_month = s.where(F.col("month") < last).groupBy("month", "client_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_search"),
        F.max("timestamp").alias("last_search"))
    cur = M.cumulative_from_month_totals(per_month).checkpoint()   # one row
    cur = M.merge_cumulative(cur, s.where(F.col("month") == last).drop("month"), last).checkpoint()
    cur = M.merge_cumulative(cur, s.where("false").drop("month"), "2100-01")
    return _cumulative_rows(cur)


@register("refresh_query_daily", f"""
SELECT query_normalized, date, CAST(SUM(search_count) AS BIGINT) AS search_count,
       COUNT(DISTINCT username) AS unique_users
FROM {O.T2} t WHERE query_normalized IN {O.eligible_sql(O.T2)} GROUP BY 1, 2""")
def q_refresh_query_daily(spark, sf):
    """From a stale table: its live rows are wrong, it holds live days that do
    not exist, and half of the eligible queries are not in it yet."""
    t, arch, _ = t2_parts(spark, sf)
    elig = ST.eligible_queries(t)
    half = F.pmod(F.xxhash64("query_normalized"), F.lit(2)) == 0
    good = ST.query_daily_from(t, elig.where(half))
    live = F.col("date") >= F.lit(SPLIT)
    wrong = good.where(live).select("query_normalized", F.date_add("date", 1).alias("date"),
                                    (F.col("search_count") + 7).alias("search_count"), "unique_users")
    stale = good.where(~live).unionByName(wrong)
    fresh = ST.query_daily_from(t.where(live), elig)
    backfill = ST.query_daily_backfill(arch, t, stale)
    return M.refresh_query_daily(stale, fresh.unionByName(backfill), stale, backfill, SPLIT)


@register("query_daily_backfill", f"""
WITH ex AS (SELECT DISTINCT query_normalized FROM {T2A} x WHERE length(query_normalized) % 2 = 0),
need AS (SELECT * FROM {O.eligible_sql(O.T2)} e WHERE query_normalized NOT IN (SELECT * FROM ex))
SELECT query_normalized, date, CAST(SUM(search_count) AS BIGINT) AS search_count,
       COUNT(DISTINCT username) AS unique_users
FROM {T2A} a WHERE query_normalized IN (SELECT * FROM need) GROUP BY 1, 2""")
def q_query_daily_backfill(spark, sf):
    """The table knows the queries of even length; the others became eligible."""
    t, arch, _ = t2_parts(spark, sf)
    existing = arch.where(F.length("query_normalized") % 2 == 0)
    return ST.query_daily_backfill(arch, t, existing)


@register("blacklist_delete_pairs", f"""
SELECT username, query_normalized, MAX(date) AS last_seen FROM {O.T2} t
WHERE NOT {O.blacklist_sql('query_normalized', BLACKLIST_RX)} GROUP BY 1, 2""")
def q_blacklist_delete_pairs(spark, sf):
    from ..operators import similarity as SM
    return M.blacklist_delete_pairs(SM.user_query_pairs(s2_tuples(spark, sf)), BLACKLIST)


@register("add_missing_columns", f"""
SELECT period_type, period_id, unique_queries, unique_pairs, CAST(NULL AS BIGINT) AS total_searches,
       CAST(NULL AS BIGINT) AS total_users, CAST(NULL AS DATE) AS first_date, CAST(NULL AS DATE) AS last_date
FROM {O.summary_sql(O.T2)} s""")
def q_add_missing_columns(spark, sf):
    old = ST.period_summary(s2_tuples(spark, sf)).select("period_type", "period_id",
                                                         "unique_queries", "unique_pairs")
    return M.add_missing_columns(old, S.PERIOD_SUMMARY)


# ---------------------------------------------------------------------------
# Daily client statistics (archived + live) and overviews
# ---------------------------------------------------------------------------

def s2_union_daily(spark, sf, searches=None):
    _, arch, live = s2_parts(spark, sf, searches)
    return ST.union_daily(R.daily_client_stats(arch), R.daily_client_stats(live))


DAILY_ALL = O.daily_stats_sql(O.S2_SQL)


@register("union_daily", f"SELECT * FROM {DAILY_ALL}")
def q_union_daily(spark, sf):
    return s2_union_daily(spark, sf)


@register("client_totals", f"SELECT client_id, CAST(SUM(search_count) AS BIGINT) AS n FROM {DAILY_ALL} d GROUP BY 1")
def q_client_totals(spark, sf):
    return ST.client_totals(s2_union_daily(spark, sf))


@register("daily_flow", f"""SELECT * FROM {DAILY_ALL} d
WHERE date >= DATE '1998-01-01' AND date <= DATE '1998-12-31'""")
def q_daily_flow(spark, sf):
    return ST.daily_flow(s2_union_daily(spark, sf), dt.date(1998, 1, 1), dt.date(1998, 12, 31))


@register("daily_unique_users", f"SELECT date, MAX(unique_users) AS unique_users FROM {DAILY_ALL} d GROUP BY 1")
def q_daily_unique_users(spark, sf):
    return ST.daily_unique_users(s2_union_daily(spark, sf))


@register("daily_unique_users_exact", f"""SELECT date, COUNT(DISTINCT username) AS unique_users
FROM {O.T2} t GROUP BY 1""")
def q_daily_unique_users_exact(spark, sf):
    return ST.daily_unique_users_exact(s2_tuples(spark, sf))


@register("last24h_per_client", f"""SELECT client_id, COUNT(*) AS n FROM {O.S1_SQL} s
WHERE "timestamp" >= TIMESTAMP '{FX.S1_AS_OF.isoformat(sep=' ')}' - INTERVAL 24 HOUR GROUP BY 1""")
def q_last24h_per_client(spark, sf):
    return ST.last24h_per_client(FX.searches_s1(spark, sf), FX.S1_AS_OF.isoformat(sep=" "))


@register("query_profile", f"""SELECT query_normalized, COUNT(DISTINCT username) AS unique_users,
       CAST(SUM(search_count) AS BIGINT) AS total_searches, MIN(date) AS first_seen, MAX(date) AS last_seen,
       COUNT(DISTINCT date) AS active_days FROM {O.T2} t GROUP BY 1""")
def q_query_profile(spark, sf):
    return ST.query_profile(s2_tuples(spark, sf))


@register("distinct_pairs_two_pass", f"""SELECT query_normalized, COUNT(DISTINCT username) AS unique_users
FROM {O.T2} t GROUP BY 1""")
def q_distinct_pairs_two_pass(spark, sf):
    return ST.distinct_pairs_two_pass(s2_tuples(spark, sf))


@register("approx_distinct", f"""SELECT date, COUNT(DISTINCT username) AS exact_users,
       TRUE AS within_tolerance FROM {O.T2} t GROUP BY 1""")
def q_approx_distinct(spark, sf):
    """The estimate against the exact count of each day: within 5 %, or one
    user on days of a few users."""
    got = ST.approx_distinct(s2_tuples(spark, sf))
    close = F.abs(F.col("approx_users") - F.col("exact_users")) <= F.greatest(
        F.lit(1.0), 0.05 * F.col("exact_users"))
    return got.select("date", "exact_users", close.alias("within_tolerance"))


@register("approx_periods", f"""
WITH t AS (SELECT * FROM {O.T2} t),
p AS (SELECT 'week' AS period_type, strftime(date, '%G-W%V') AS period_id, username, query_normalized FROM t
      UNION ALL SELECT 'month', strftime(date, '%Y-%m'), username, query_normalized FROM t
      UNION ALL SELECT 'all_time', 'all_time', username, query_normalized FROM t)
SELECT period_type, period_id, COUNT(DISTINCT username) AS exact_users, COUNT(DISTINCT query_normalized) AS exact_queries,
       COUNT(DISTINCT (query_normalized, username)) AS exact_pairs, TRUE AS within_tolerance
FROM p GROUP BY 1, 2""")
def q_approx_periods(spark, sf):
    """One written table of daily sketches answers every period; each estimate
    against the exact count: within 3 %, or one in small periods."""
    root = run_dir(spark, "sketches")
    tuples = SK.snapshot(s2_tuples(spark, sf), f"{root}/tuples")  # read for the sketches and for every kind
    path = SK.write_version(ST.distinct_sketches(tuples), f"{root}/daily")
    got = ST.approx_periods(spark.read.parquet(path))
    # each kind and each count apart: together they are nine rows a tuple in one task
    counts = {"exact_users": ["username"], "exact_queries": [ST.Q], "exact_pairs": [ST.Q, "username"]}
    each = [reduce(DataFrame.unionByName, [
        ST.assign_periods(tuples, (kind,)).groupBy(*ST.IK).agg(F.countDistinct(*cols).alias(name))
        for kind in ST.PERIOD_CODES]) for name, cols in counts.items()]
    exact = reduce(lambda a, b: a.join(b, ST.IK), each)
    exact = exact.select(*ST.period_names(), "exact_users", "exact_queries", "exact_pairs")
    close = F.lit(True)
    for c in ("users", "queries", "pairs"):
        close = close & (F.abs(F.col(f"approx_{c}") - F.col(f"exact_{c}")) <= F.greatest(
            F.lit(1.0), 0.03 * F.col(f"exact_{c}")))
    return got.join(exact, ["period_type", "period_id"]).select(
        "period_type", "period_id", "exact_users", "exact_queries", "exact_pairs", close.alias("within_tolerance"))


@register("tuples_of_month", f"SELECT * FROM {O.T2} t WHERE strftime(date, '%Y-%m') IN ('1995-01', '1996-06', '1997-12')")
def q_tuples_of_month(spark, sf):
    """Three months of archive and live tables, both partitioned by month."""
    _, arch, live = t2_parts(spark, sf)
    root = run_dir(spark, "tuples_of_month")
    for name, part in (("archive", arch), ("live", live)):
        SK.archive_daily_tuples(part, None, f"{root}/{name}")
    parts = [SC.scan_archived_tuples(spark, f"{root}/{n}/daily_tuples", with_month=True) for n in ("archive", "live")]
    tuples = SC.tuples_all(*parts, ledger_for(arch), with_month=True)
    return SC.of_months(tuples, ["1995-01", "1996-06", "1997-12"]).drop("month")


CUMULATIVE_SQL = f"""
WITH c AS (
SELECT period_type, period_id, total_searches, total_users, unique_queries AS total_queries,
       unique_pairs AS total_search_pairs,
       round(CASE WHEN total_users > 0 THEN total_searches / total_users ELSE 0 END, 6) AS avg_searches_per_user,
       round(CASE WHEN total_users > 0 THEN unique_pairs / total_users ELSE 0 END, 6) AS avg_unique_queries_per_user,
       CAST(first_date AS TIMESTAMP) AS first_search,
       CASE WHEN CAST(last_date AS TIMESTAMP) + INTERVAL '23:59:59.999999'
                 > TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 1 SECOND
            THEN TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 2 SECOND
            ELSE CAST(last_date AS TIMESTAMP) + INTERVAL '23:59:59.999999' END AS last_search,
       FALSE AS is_estimate
FROM {O.summary_sql(O.T2)} s WHERE period_type = 'all_time'),
r AS (SELECT *, round((epoch_us(last_search) - epoch_us(first_search)) / 1000000.0 / 86400.0, 1) AS d FROM c)
SELECT * EXCLUDE (d), CASE WHEN d = floor(d) THEN CAST(CAST(floor(d) AS BIGINT) AS VARCHAR)
                           ELSE printf('%.1f', d) END AS collection_days FROM r"""


@register("cumulative_overview", CUMULATIVE_SQL)
def q_cumulative_overview(spark, sf):
    return ST.cumulative_overview(ST.period_summary(s2_tuples(spark, sf)), AS_OF.isoformat())


@register("period_overview", f"""
WITH d AS {DAILY_ALL}, p AS {O.periods_sql(O.T2)},
k AS (SELECT 'week' AS period_type, {O.WEEK_ID} AS period_id, * FROM d
      UNION ALL SELECT 'month', {O.MONTH_ID}, * FROM d),
a AS (SELECT period_type, period_id, SUM(search_count) AS d_searches, SUM(unique_users) AS d_users,
             MIN(date) AS first_date, MAX(date) AS last_date FROM k GROUP BY 1, 2),
s AS {O.summary_sql(T2A)},
j AS (SELECT a.*, s.unique_queries AS s_queries, s.unique_pairs AS s_pairs, s.total_searches AS s_searches,
             s.total_users AS s_users, s.period_id IS NOT NULL AS has
      FROM a JOIN p USING (period_type, period_id) LEFT JOIN s USING (period_type, period_id)
      WHERE a.d_searches > 0),
v AS (SELECT *, CASE WHEN has THEN s_searches ELSE d_searches END AS ts,
             CASE WHEN has THEN s_users ELSE d_users END AS tu FROM j),
w AS (SELECT *, CASE WHEN has THEN s_queries WHEN tu > 0 THEN floor(tu * 0.6) ELSE 0 END AS tq,
             CASE WHEN has THEN s_pairs ELSE tu END AS tp FROM v)
SELECT period_type, period_id, CAST(ts AS BIGINT) AS total_searches, CAST(tu AS BIGINT) AS total_users,
       CAST(tq AS BIGINT) AS total_queries, CAST(tp AS BIGINT) AS total_search_pairs,
       round(CASE WHEN tu > 0 THEN ts / tu ELSE 0 END, 6) AS avg_searches_per_user,
       round(CASE WHEN tu > 0 THEN tp / tu ELSE 0 END, 6) AS avg_unique_queries_per_user,
       CAST(first_date AS TIMESTAMP) AS first_search,
       CAST(last_date AS TIMESTAMP) + INTERVAL '23:59:59.999999' AS last_search, NOT has AS is_estimate
FROM w""")
def q_period_overview(spark, sf):
    s = _stored_searches(spark, sf)
    _, arch, _ = t2_parts(spark, sf, s)
    # the tuples' dates are those of the searches
    return ST.period_overview(s2_union_daily(spark, sf, s), ST.period_summary(arch),
                              P.generate_periods(s.select(E.event_date("timestamp").alias("date"))))


# ---------------------------------------------------------------------------
# Periods bookkeeping
# ---------------------------------------------------------------------------

@register("period_client_totals", f"""
WITH d AS {DAILY_ALL},
k AS (SELECT 'week' AS period_type, {O.WEEK_ID} AS period_id, * FROM d
      UNION ALL SELECT 'month', {O.MONTH_ID}, * FROM d)
SELECT period_type, period_id, client_id, CAST(SUM(search_count) AS BIGINT) AS n FROM k GROUP BY 1, 2, 3""")
def q_period_client_totals(spark, sf):
    return ST.period_client_totals(s2_union_daily(spark, sf))


@register("refresh_rollups", f"SELECT * FROM {O.T2}")
def q_refresh_rollups(spark, sf):
    s, _, _ = s2_parts(spark, sf)
    root = run_dir(spark, "rollups")
    t_path, c_path = f"{root}/daily_tuples", f"{root}/daily_client_stats"
    R.refresh_rollups(s.where(E.event_date("timestamp") < F.lit(SPLIT)), t_path, c_path)
    # new input arrives for the months from December 2000 on: those months
    # are recomputed from all of their raw rows, the others stay
    R.refresh_rollups(s.where(E.event_date("timestamp") >= F.lit(LIVE_FROM)), t_path, c_path)
    return spark.read.schema(S.DAILY_TUPLES).parquet(t_path).select(
        *[f.name for f in S.DAILY_TUPLES.fields])


@register("existing_periods", f"SELECT DISTINCT period_type, period_id FROM {O.summary_sql(T2A)} s")
def q_existing_periods(spark, sf):
    _, arch, _ = t2_parts(spark, sf)
    return P.existing_periods(ST.period_summary(arch))


@register("stale_periods", f"""
WITH p AS {O.periods_sql(O.T2)}, ex AS {O.summary_sql(T2A)}
SELECT * FROM p WHERE NOT (period_type <> 'all_time'
  AND end_date < (SELECT MIN(date) FROM {T2L} l)
  AND (period_type, period_id) IN (SELECT (period_type, period_id) FROM ex))""")
def q_stale_periods(spark, sf):
    t, arch, live = t2_parts(spark, sf)
    return P.stale_periods(P.generate_periods(t), ST.period_summary(arch), live)


@register("available_periods", f"""
WITH s AS {O.summary_sql(O.T2)},
x AS (SELECT period_type, period_id,
        CASE WHEN period_type = 'week'
             THEN CAST(date_trunc('week', make_date(CAST(left(period_id, 4) AS INTEGER), 1, 4))
                       + (CAST(right(period_id, 2) AS INTEGER) - 1) * INTERVAL 7 DAY AS DATE)
             ELSE CAST(period_id || '-01' AS DATE) END AS start_date
      FROM s WHERE period_type IN ('week', 'month'))
SELECT period_type, period_id, start_date,
       CASE WHEN period_type = 'week' THEN CAST(start_date + INTERVAL 6 DAY AS DATE)
            ELSE CAST(last_day(start_date) AS DATE) END AS end_date,
       CASE WHEN period_type = 'week' THEN right(period_id, 2) || '/' || left(period_id, 4)
            ELSE strftime(start_date, '%B %Y') END AS label,
       CAST(start_date AS TIMESTAMP) AS start_ts,
       CAST(CASE WHEN period_type = 'week' THEN CAST(start_date + INTERVAL 6 DAY AS DATE)
            ELSE CAST(last_day(start_date) AS DATE) END AS TIMESTAMP) + INTERVAL '23:59:59' AS end_ts
FROM x WHERE CAST(start_date AS TIMESTAMP) <= TIMESTAMP '{CUTOFF} 23:59:59'""")
def q_available_periods(spark, sf):
    return P.available_periods(ST.period_summary(s2_tuples(spark, sf)),
                               f"{CUTOFF.isoformat()} 23:59:59")


# ---------------------------------------------------------------------------
# Exports (written, then read back)
# ---------------------------------------------------------------------------

@register("export_queries_json", DETAIL_CTE + f""",
top AS ({O.top_sql('t', where="WHERE period_type = 'all_time'")})
SELECT rank, top.query_normalized AS query, unique_users, total_searches, sl.slug
FROM top LEFT JOIN sl USING (query_normalized)""")
def q_export_queries_json(spark, sf):
    t = s2_tuples(spark, sf)
    top = ST.period_top_queries(t, kinds=("all_time",))
    slugs = DT.slug_map(ST.query_daily_stats(t), CUTOFF, BLACKLIST)
    path = SK.export_queries_json(top, slugs, run_dir(spark, "queries_all_json"))
    schema = "rank INT, query STRING, unique_users BIGINT, total_searches BIGINT, slug STRING"
    return spark.read.schema(schema).json(path)


@register("export_search_index", DETAIL_CTE + f"""
SELECT st.query_normalized AS q, unique_users AS u, total_searches AS t, sl.slug AS s
FROM st LEFT JOIN sl USING (query_normalized)
WHERE unique_users >= 5 AND NOT {O.blacklist_sql('st.query_normalized', BLACKLIST_RX)}""")
def q_export_search_index(spark, sf):
    t = s2_tuples(spark, sf)
    idx = DT.search_index(ST.all_time_query_stats(t),
                          DT.slug_map(ST.query_daily_stats(t), CUTOFF, BLACKLIST), BLACKLIST)
    path = SK.export_search_index(idx, run_dir(spark, "search_index"))
    return (spark.read.text(path)
            .select(F.from_json("value", "q STRING, u BIGINT, t BIGINT, s STRING").alias("j"))
            .select("j.*"))


@register("export_detail_tables", DETAIL_CTE + f"""
SELECT 'queries' AS table_name, rank, query AS text, unique_users AS a, total_searches AS b, slug AS extra FROM dq
UNION ALL SELECT 'word_index', rank, word, NULL, NULL, NULL FROM (SELECT DISTINCT word, rank FROM (
  SELECT rank, unnest(regexp_split_to_array(lower(query), '{TOKEN_SPLIT}')) AS word FROM dq) x WHERE word <> '') w
UNION ALL SELECT 'query_daily', rank, strftime(date, '%Y-%m-%d'), search_count, qd.unique_users, NULL
  FROM qd JOIN dq ON dq.query = qd.query_normalized WHERE date <= DATE '{CUTOFF}'
UNION ALL SELECT 'query_similar', a.rank, CAST(b.rank AS VARCHAR), shared_users, NULL, NULL
  FROM sim JOIN dq a ON a.query = sim.query JOIN dq b ON b.query = sim.similar_query""")
def q_export_detail_tables(spark, sf):
    """The rows of all four tables as they were written."""
    from .catalog import s2_detail, s2_similar
    t = s2_tuples(spark, sf)
    d = s2_detail(spark, sf)
    tables = {"queries": d, "word_index": DT.word_index(d),
              "query_daily": DT.detail_daily(d, ST.query_daily_stats(t), CUTOFF),
              "query_similar": DT.detail_similar(d, s2_similar(spark, sf))}
    paths = SK.export_detail_tables(run_dir(spark, "detail"), tables)
    read = {name: spark.read.parquet(p) for name, p in paths.items()}
    none = F.lit(None)
    row = lambda df, name, text, a, b, extra: df.select(
        F.lit(name).alias("table_name"), "rank", text.cast("string").alias("text"), a.cast("bigint").alias("a"),
        b.cast("bigint").alias("b"), extra.cast("string").alias("extra"))
    return (row(read["queries"], "queries", F.col("query"), F.col("unique_users"), F.col("total_searches"), F.col("slug"))
            .unionByName(row(read["word_index"], "word_index", F.col("word"), none, none, none))
            .unionByName(row(read["query_daily"], "query_daily", F.col("date"), F.col("search_count"),
                             F.col("unique_users"), none))
            .unionByName(row(read["query_similar"], "query_similar", F.col("similar_rank"), F.col("shared_users"),
                             none, none)))


# ---------------------------------------------------------------------------
# Composed jobs (run twice where they maintain tables: same result)
# ---------------------------------------------------------------------------
from . import jobs as J  # noqa: E402


@once_per_session
def _stored_parts(spark, sf):
    """The archived and the live tuples and the ledger as tables, partitioned by
    month, which is how the jobs find them: written once, each job reads files."""
    root = run_dir(spark, "stored")
    SK.archive_daily_tuples(s2_tuples(spark, sf), None, root)
    t = SC.scan_archived_tuples(spark, f"{root}/daily_tuples", with_month=True)
    arch, live = t.where(F.col("date") < F.lit(SPLIT)), t.where(F.col("date") >= F.lit(LIVE_FROM))
    ledger = SK.write_version(ledger_for(arch), f"{root}/archives")
    return arch, live, SC.tuples_all(arch, live, spark.read.parquet(ledger), with_month=True)


@once_per_session
def _period_stats_twice(spark, sf):
    _, live, tuples = _stored_parts(spark, sf)
    root = run_dir(spark, "nightly")
    for _ in range(2):
        J.period_stats_job(spark, root, tuples, live)
    return root, tuples


@register("period_stats_job", f"SELECT * FROM {O.summary_sql(O.T2)} s")
def q_period_stats_job(spark, sf):
    root, _ = _period_stats_twice(spark, sf)
    return SK.read_table(spark, f"{root}/period_summary_stats", S.PERIOD_SUMMARY)


@register("period_stats_job_top", O.top_sql(O.T2))
def q_period_stats_job_top(spark, sf):
    root, _ = _period_stats_twice(spark, sf)
    return SK.read_table(spark, f"{root}/period_top_queries", S.PERIOD_TOP).select(*S.PERIOD_TOP.names)


@register("period_stats_job_length", ORACLE["query_length_dist"])
def q_period_stats_job_length(spark, sf):
    root, _ = _period_stats_twice(spark, sf)
    return SK.read_table(spark, f"{root}/period_query_length_dist", S.PERIOD_LENGTH).select(
        *S.PERIOD_LENGTH.names)


@register("period_stats_job_daily", f"""
SELECT query_normalized, date, CAST(SUM(search_count) AS BIGINT) AS search_count,
       COUNT(DISTINCT username) AS unique_users
FROM {O.T2} t WHERE query_normalized IN {O.eligible_sql(O.T2)} GROUP BY 1, 2""")
def q_period_stats_job_daily(spark, sf):
    """A first run over the archived part alone, then the refresh and backfill
    that the live part makes necessary."""
    arch, live, tuples = _stored_parts(spark, sf)
    root = run_dir(spark, "nightly_daily")
    J.period_stats_job(spark, root, arch.where(F.col("date") < F.lit(LIVE_FROM)), arch.limit(0))
    J.period_stats_job(spark, root, tuples, live)
    return SK.read_table(spark, f"{root}/query_daily_stats", S.QUERY_DAILY)


@once_per_session
def _published(spark, sf) -> str:
    from ..operators import similarity as SM
    root, tuples = _period_stats_twice(spark, sf)
    daily = spark.read.parquet(SK.write_version(s2_union_daily(spark, sf), f"{root}/daily_client_stats"))
    pairs = SM.user_query_pairs(tuples, AS_OF, "run_date")
    J.publish_job(spark, root, tuples, pairs, daily, AS_OF.isoformat(), BLACKLIST)
    return f"{root}/publish"


@register("publish_job", DETAIL_CTE + "SELECT * FROM dq")
def q_publish_job(spark, sf):
    return spark.read.parquet(f"{_published(spark, sf)}/queries")


@register("publish_job_word_index", ORACLE["word_index"])
def q_publish_job_word_index(spark, sf):
    return spark.read.parquet(f"{_published(spark, sf)}/word_index")


@register("publish_job_query_daily", ORACLE["detail_daily"])
def q_publish_job_query_daily(spark, sf):
    return spark.read.parquet(f"{_published(spark, sf)}/query_daily")


@register("publish_job_search_index", ORACLE["export_search_index"])
def q_publish_job_search_index(spark, sf):
    return (spark.read.text(f"{_published(spark, sf)}/search_index")
            .select(F.from_json("value", "q STRING, u BIGINT, t BIGINT, s STRING").alias("j")).select("j.*"))


@register("publish_job_cumulative_overview", CUMULATIVE_SQL)
def q_publish_job_cumulative_overview(spark, sf):
    return SK.read_table(spark, f"{_published(spark, sf)}/cumulative_overview")


@register("publish_job_query_lists", f"""
WITH t AS ({O.top_sql(O.T2)}),
k AS (SELECT * FROM t WHERE NOT {O.blacklist_sql('query_normalized', BLACKLIST_RX)})
SELECT period_type, period_id, CAST(row_number() OVER (PARTITION BY period_type, period_id ORDER BY rank) AS INTEGER) AS rank,
       query_normalized AS query, unique_users, total_searches FROM k""")
def q_publish_job_query_lists(spark, sf):
    schema = ("rank INT, query STRING, unique_users BIGINT, total_searches BIGINT, period_type STRING, "
              "period_id STRING")
    return spark.read.schema(schema).json(f"{_published(spark, sf)}/query_lists")


@register("publish_job_client_totals", f"SELECT client_id, CAST(SUM(search_count) AS BIGINT) AS n FROM {DAILY_ALL} d GROUP BY 1")
def q_publish_job_client_totals(spark, sf):
    return SK.read_table(spark, f"{_published(spark, sf)}/client_totals")


# every month of the fixture's history lies before this one
ARCHIVE_MONTH = "2100-01"


@once_per_session
def _archived(spark, sf) -> str:
    """The whole raw log archived and deleted; the second run finds nothing."""
    root = run_dir(spark, "archive_job")
    (SK.by_month(FX.searches_s2(spark, sf).withColumn("month", E.month_key("timestamp")))
     .write.partitionBy("month").parquet(f"{root}/searches"))
    for _ in range(2):
        J.archive_job(spark, root, f"{root}/searches", ARCHIVE_MONTH, AS_OF, delete_after=True)
    left = [f for d in SK.list_dirs(spark, f"{root}/searches")
            for f in SK.list_files(spark, f"{root}/searches/{d}")]
    if left:
        raise RuntimeError("archived files still present in the raw log")
    return root


@register("archive_job", f"""SELECT strftime("timestamp", '%Y-%m') AS month, COUNT(*) AS record_count,
       TRUE AS deleted FROM {O.S2_SQL} s GROUP BY 1""")
def q_archive_job(spark, sf):
    led = SK.read_table(spark, f"{_archived(spark, sf)}/archives", S.ARCHIVE_LEDGER)
    return led.select("month", "record_count", "deleted")


@register("archive_job_rows", f"""SELECT client_id, "timestamp", username, query,
       strftime("timestamp", '%Y-%m') AS month FROM {O.S2_SQL} s""")
def q_archive_job_rows(spark, sf):
    rows = SC.scan_archive(spark, f"{_archived(spark, sf)}/archive/searches")
    return rows.drop("run").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("archive_job_tuples", f"SELECT * FROM {O.T2}")
def q_archive_job_tuples(spark, sf):
    return SC.scan_archived_tuples(spark, f"{_archived(spark, sf)}/archive/daily_tuples")


@register("archive_job_client_stats", f"SELECT * FROM {DAILY_ALL}")
def q_archive_job_client_stats(spark, sf):
    stats = spark.read.schema(S.DAILY_CLIENT_STATS).parquet(f"{_archived(spark, sf)}/daily_client_stats")
    return stats.select(*S.DAILY_CLIENT_STATS.names)


@register("archive_job_pairs", f"""SELECT DISTINCT username, lower(trim(query)) AS query_normalized,
       DATE '{AS_OF}' AS last_seen FROM {O.S2_SQL} s""")
def q_archive_job_pairs(spark, sf):
    return M.current_user_query_pairs(spark.read.parquet(f"{_archived(spark, sf)}/user_query_pairs"))


@register("archive_job_cumulative", _CUMULATIVE_S2)
def q_archive_job_cumulative(spark, sf):
    return _cumulative_rows(SK.read_table(spark, f"{_archived(spark, sf)}/stats_cumulative", S.CUMULATIVE))


def _convergence(spark, sf, name):
    from .catalog import _S1_END, _S1_START, _W
    return J.convergence_job(FX.searches_s1c(spark, sf), _S1_START, _S1_END, _W)[name]


def _register_convergence() -> None:
    """One query per report of the job, against the report's own SQL."""
    for report in ("event_client_distribution", "full_convergence", "spread_histogram", "events_per_client",
                   "unique_contribution", "sample_converged"):
        register(f"convergence_job_{report}", ORACLE[report])(
            lambda spark, sf, report=report: _convergence(spark, sf, report))


@register("convergence_job", O.overlap_sql(CONV_CTE))
def q_convergence_job(spark, sf):
    return _convergence(spark, sf, "client_overlap")


_register_convergence()
