"""Search-log statistics over daily tuples.

The core plan (all periods at once, no loop over periods)::

    tuples (date, username, query_normalized, search_count)
      -> by (query, user)                                the one wide shuffle, x1
      -> weeks, months, all_time: each reads that shuffle in tasks of its own
      -> pairs    = groupBy(period, query, user)          no shuffle: same keys
           -> by_query = groupBy(period, query)           partial-aggregated
                -> summary, top list (users >= 5), length distribution
           -> by_user  = distinct (period, user)         -> total_users

Keys include the query *and* the user, so the all_time period (the biggest
group) and a hot query both spread over tasks; every later step is fed by
map-side partial aggregates, never by raw rows of one group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as E
from .maintenance import insert_if_absent
from .periods import PERIOD_KEYS
from .ranking import rank_within

Q = "query_normalized"


# Inside the large aggregations a period is a (type code, number) pair:
# week -> (0, iso_year * 100 + iso_week), month -> (1, year * 100 + month),
# all_time -> (2, 0). Small numeric keys hash and shuffle faster than the
# published text ids, which are formed only on the (small) aggregated rows.
PERIOD_CODES = {"week": 0, "month": 1, "all_time": 2}
IK = ["_pt", "_pk"]


def period_names(pt="_pt", pk="_pk") -> list:
    """(period_type, period_id) text from the internal keys."""
    pt, pk = E.col(pt), E.col(pk)
    year = F.floor(pk / 100).cast("int").cast("string")
    num = F.lpad(F.pmod(pk, F.lit(100)).cast("string"), 2, "0")
    ptype = F.when(pt == 0, F.lit("week")).when(pt == 1, F.lit("month")).otherwise(
        F.lit("all_time"))
    pid = (F.when(pt == 0, F.concat(year, F.lit("-W"), num))
           .when(pt == 1, F.concat(F.lpad(year, 4, "0"), F.lit("-"), num))
           .otherwise(F.lit("all_time")))
    return [ptype.alias("period_type"), pid.alias("period_id")]


def period_internal(period_type="period_type", period_id="period_id") -> list:
    """The internal keys of text period ids (for joins with period lists)."""
    pt, pid = E.col(period_type), E.col(period_id)
    code = (F.when(pt == "week", F.lit(0)).when(pt == "month", F.lit(1))
            .otherwise(F.lit(2))).cast("tinyint")
    year = F.substring(pid, 1, 4).cast("int")
    key = (F.when(pt == "week", year * 100 + F.substring(pid, 7, 2).cast("int"))
           .when(pt == "month", year * 100 + F.substring(pid, 6, 2).cast("int"))
           .otherwise(F.lit(0)))
    return [code.alias("_pt"), key.alias("_pk")]


def assign_periods(tuples: DataFrame, kinds=("week", "month", "all_time")) -> DataFrame:
    """Each tuple belongs to its ISO week, its month and all_time (no range
    join); adds the internal keys ``_pt``, ``_pk``."""
    d = F.col("date")
    keys = {"week": F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d),
            "month": F.year(d) * 100 + F.month(d), "all_time": F.lit(0)}
    if len(kinds) == 1:
        return tuples.select("*", F.lit(PERIOD_CODES[kinds[0]]).cast("tinyint").alias("_pt"),
                             keys[kinds[0]].cast("int").alias("_pk"))
    arr = F.array(*[F.struct(F.lit(PERIOD_CODES[k]).cast("tinyint").alias("_pt"),
                             keys[k].cast("int").alias("_pk")) for k in kinds])
    return tuples.select("*", F.inline(arr))


def period_pairs(tuples: DataFrame, kinds=("week", "month", "all_time")) -> DataFrame:
    """Distinct (period, query, user) with searches and first/last date
    (period as internal keys). Tuples travel once, by query and user; a pair's
    periods are then in one partition, so the threefold rows are never shuffled.
    Weeks, months and all_time read that shuffle in tasks of their own, since a
    task keeps every row of its periods in a hash table."""
    placed = tuples.select("date", "username", Q, "search_count").repartition(Q, "username")
    # the same column for every row, read from the date: all kinds need the same
    # columns of the shuffle, so it is written once and reused
    every = F.coalesce(F.year("date") * 0, F.lit(0))
    of_kind = lambda kind: (placed.select(
        "*", F.lit(PERIOD_CODES[kind]).cast("tinyint").alias("_pt"), every.alias("_pk"))
        if kind == "all_time" else assign_periods(placed, (kind,)))
    parts = [of_kind(kind).groupBy(*IK, Q, "username")
             .agg(F.sum("search_count").alias("searches"),
                  F.min("date").alias("first_date"), F.max("date").alias("last_date")) for kind in kinds]
    return reduce(DataFrame.unionByName, parts)


def month_pairs(tuples: DataFrame) -> DataFrame:
    """Period state: one row per (month, query, user). It is additive over
    months, so months are replaced one by one and ``pairs_from_state`` folds them."""
    return (tuples.groupBy(E.month_key("date").alias("month"), Q, "username")
            .agg(F.sum("search_count").alias("searches"),
                 F.min("date").alias("first_date"), F.max("date").alias("last_date")))


def _month_number():
    return F.substring("month", 1, 4).cast("int") * 100 + F.substring("month", 6, 2).cast("int")


def pairs_from_state(state: DataFrame, months: list[str] | None = None) -> DataFrame:
    """(period, query, user) rows of all_time and of the months named, from the
    month pairs: a month is read as it stands, all_time is one fold over months."""
    rest = [Q, "username", "searches", "first_date", "last_date"]
    every = (state.groupBy(Q, "username")
             .agg(F.sum("searches").alias("searches"), F.min("first_date").alias("first_date"),
                  F.max("last_date").alias("last_date"))
             .select(F.lit(PERIOD_CODES["all_time"]).cast("tinyint").alias("_pt"), F.lit(0).alias("_pk"), *rest))
    if not months:
        return every
    own = state.where(F.col("month").isin(list(months))).select(
        F.lit(PERIOD_CODES["month"]).cast("tinyint").alias("_pt"), _month_number().alias("_pk"), *rest)
    return own.unionByName(every)


def users_from_state(state: DataFrame, months: list[str] | None = None) -> DataFrame:
    """(period, user) rows of all_time and of the months named, not distinct."""
    of = lambda kind, key, rows: rows.select(
        F.lit(PERIOD_CODES[kind]).cast("tinyint").alias("_pt"), key.alias("_pk"), "username")
    every = of("all_time", F.lit(0), state)
    if not months:
        return every
    return of("month", _month_number(), state.where(F.col("month").isin(list(months)))).unionByName(every)


def queries_by_period(pairs: DataFrame) -> DataFrame:
    return (pairs.groupBy(*IK, Q)
            .agg(F.count(F.lit(1)).alias("unique_users"),
                 F.sum("searches").alias("total_searches"),
                 F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")))


def users_by_period(rows: DataFrame) -> DataFrame:
    """Distinct users per period of rows (period, username, ...); weeks, months and
    all_time apart, so that no shuffle holds all of them."""
    parts = [rows.where(F.col("_pt") == F.lit(code).cast("tinyint")).select(*IK, "username").distinct()
             .groupBy(*IK).agg(F.count(F.lit(1)).alias("total_users")) for code in PERIOD_CODES.values()]
    return reduce(DataFrame.unionByName, parts)


def period_summary_from(users: DataFrame, by_query: DataFrame) -> DataFrame:
    per_period = (by_query.groupBy(*IK)
                  .agg(F.count(F.lit(1)).alias("unique_queries"),
                       F.sum("unique_users").alias("unique_pairs"),
                       F.sum("total_searches").alias("total_searches"),
                       F.min("first_date").alias("first_date"),
                       F.max("last_date").alias("last_date")))
    # null-safe keys and a test of an aggregate for undated rows: a test of the keys
    # would be pushed below the shuffle, one for every kind, and part what they share
    named = users.select(F.col("_pt").alias("_ut"), F.col("_pk").alias("_uk"), "total_users")
    same = F.col("_pt").eqNullSafe(F.col("_ut")) & F.col("_pk").eqNullSafe(F.col("_uk"))
    dated = (F.col("_pt") == PERIOD_CODES["all_time"]) | F.col("first_date").isNotNull()
    return (per_period.join(named, same, "inner").where(dated)
            .select(*period_names(), "unique_queries", "unique_pairs", "total_searches",
                    "total_users", "first_date", "last_date"))


def period_summary(tuples: DataFrame) -> DataFrame:
    """Per period: searches, distinct users, queries, (user, query) pairs,
    first and last date. Empty periods have no row."""
    pairs = period_pairs(tuples)
    # True for every row, null counts included, but it reads every column of
    # ``pairs``: both branches keep the same aggregate and its shuffle is
    # computed once and reused (ReusedExchange) instead of the optimizer
    # pruning this branch into a second, different aggregation.
    keep = ((F.col("searches") >= F.lit(-2**63)) | F.col("searches").isNull()
            | F.col("first_date").isNull() | F.col("last_date").isNull())
    return period_summary_from(users_by_period(pairs.where(keep)), queries_by_period(pairs))


def top_order():
    return [F.col("unique_users").desc(), F.col("total_searches").desc(), F.col(Q).asc()]


def top_from(by_query: DataFrame, min_users: int = E.MIN_TOP_USERS) -> DataFrame:
    eligible = by_query.where(F.col("unique_users") >= min_users).select(
        *IK, Q, "unique_users", "total_searches")
    ranked = rank_within(eligible, IK, top_order())
    return ranked.select(*period_names(), Q, "unique_users", "total_searches", "rank")


def period_top_queries(tuples: DataFrame, min_users: int = E.MIN_TOP_USERS,
                       kinds=("week", "month", "all_time")) -> DataFrame:
    """Per period and query: distinct users and searches; users >= min_users;
    rank 1..n by users desc, searches desc, query asc."""
    return top_from(queries_by_period(period_pairs(tuples, kinds)), min_users)


def length_from(by_query: DataFrame, max_words: int = E.MAX_QUERY_WORDS,
                exclude_empty: bool = False) -> DataFrame:
    """Words -> distinct queries per period. The empty query counts as one
    word; ``exclude_empty`` drops it instead (the SQL meaning, where the
    empty word array has no length)."""
    q = by_query.where(F.col(Q) != "") if exclude_empty else by_query
    return (q.select(*IK, E.word_count(Q).alias("query_length"))
            .where(F.col("query_length") <= max_words)
            .groupBy(*IK, "query_length")
            .agg(F.count(F.lit(1)).alias("unique_query_count"))
            .select(*period_names(), "query_length", "unique_query_count"))


def query_length_dist(tuples: DataFrame, max_words: int = E.MAX_QUERY_WORDS,
                      exclude_empty: bool = False) -> DataFrame:
    """Per period: number of words -> number of distinct queries (<= max_words)."""
    by_query = (assign_periods(tuples).select(*IK, Q).distinct())
    return length_from(by_query, max_words, exclude_empty)


# ---------------------------------------------------------------------------
# Per-query series
# ---------------------------------------------------------------------------

def all_time_query_stats(tuples: DataFrame) -> DataFrame:
    """(query, unique_users, total_searches, first_date) over all tuples."""
    per_user = tuples.groupBy(Q, "username").agg(F.sum("search_count").alias("s"),
                                                 F.min("date").alias("d"))
    return per_user.groupBy(Q).agg(F.count(F.lit(1)).alias("unique_users"),
                                   F.sum("s").alias("total_searches"),
                                   F.min("d").alias("first_date"))


def eligible_queries(tuples: DataFrame, min_users: int = E.MIN_DETAIL_USERS) -> DataFrame:
    return all_time_query_stats(tuples).where(F.col("unique_users") >= min_users).select(Q)


def query_daily_from(tuples: DataFrame, eligible: DataFrame) -> DataFrame:
    """Per (query, date): searches and distinct users, for the eligible queries.
    The key table is joined (semi join), never collected into an IN list;
    AQE broadcasts it only when its measured size is under the threshold."""
    return (tuples.join(eligible, Q, "left_semi")
            .groupBy(Q, "date")
            .agg(F.sum("search_count").alias("search_count"),
                 F.countDistinct("username").alias("unique_users")))


def query_daily_stats(tuples: DataFrame, min_users: int = E.MIN_DETAIL_USERS) -> DataFrame:
    return query_daily_from(tuples, eligible_queries(tuples, min_users))


def query_daily_backfill(archived: DataFrame, tuples: DataFrame, existing: DataFrame,
                         min_users: int = E.MIN_DETAIL_USERS) -> DataFrame:
    """Daily rows over the archived tuples for queries that became eligible and
    have no daily rows yet (eligible minus existing, an anti join)."""
    need = eligible_queries(tuples, min_users).join(existing.select(Q).distinct(), Q, "left_anti")
    return query_daily_from(archived, need)


def query_profile(tuples: DataFrame) -> DataFrame:
    """Per query: all-time users and searches, first and last day, active days.

    One scan: users and days of a query come from one aggregation by grouping
    sets (a row per user, a row per day), folded by query."""
    by_user = F.col("_set") == 1  # the day is not in the set
    parts = (tuples.where(F.col(Q).isNotNull())
             .groupingSets([[F.col(Q), F.col("username")], [F.col(Q), F.col("date")]],
                           F.col(Q), F.col("username"), F.col("date"))
             .agg(F.grouping_id().alias("_set"), F.sum("search_count").alias("s")))
    return (parts.groupBy(Q)
            .agg(F.count_if(by_user).alias("unique_users"),
                 F.sum(F.when(by_user, F.col("s"))).alias("total_searches"),
                 F.min("date").alias("first_seen"), F.max("date").alias("last_seen"),
                 F.count_if(~by_user).alias("active_days")))


# ---------------------------------------------------------------------------
# Daily client statistics and overviews
# ---------------------------------------------------------------------------

def union_daily(archived: DataFrame, live: DataFrame) -> DataFrame:
    """Archived and live daily client stats; a (client, date) present in both
    is taken from the archive only (the live rollup may still hold it)."""
    cols = ["client_id", "date", "search_count", "unique_users"]
    return insert_if_absent(archived.select(cols), live, ["client_id", "date"])


def daily_flow(daily: DataFrame, start=None, end=None) -> DataFrame:
    d = daily
    if start is not None:
        d = d.where(F.col("date") >= F.lit(start))
    if end is not None:
        d = d.where(F.col("date") <= F.lit(end))
    return d.select("client_id", "date", "search_count", "unique_users").orderBy("date", "client_id")


def daily_unique_users(daily: DataFrame) -> DataFrame:
    """Per day the largest per-client distinct-user count (the reference's
    documented approximation)."""
    return daily.groupBy("date").agg(F.max("unique_users").alias("unique_users"))


def daily_unique_users_exact(tuples: DataFrame) -> DataFrame:
    return tuples.groupBy("date").agg(F.countDistinct("username").alias("unique_users"))


def client_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy("client_id").agg(F.sum("search_count").alias("n"))


def month_additive_stats(month_rows: DataFrame) -> DataFrame:
    return month_rows.agg(F.count(F.lit(1)).alias("searches"),
                          F.min("timestamp").alias("first_search"),
                          F.max("timestamp").alias("last_search"))


def month_client_counts(month_rows: DataFrame) -> DataFrame:
    return month_rows.groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))


def raw_per_client(searches: DataFrame) -> DataFrame:
    return searches.groupBy("client_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "client_id")


def distinct_clients(searches: DataFrame) -> DataFrame:
    return searches.select("client_id").distinct()


def last24h_per_client(searches: DataFrame, now) -> DataFrame:
    since = F.lit(now).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    return raw_per_client(searches.where(F.col("timestamp") >= since))


def approx_distinct(tuples: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Exact and HyperLogLog++ distinct users / queries per day, with the
    relative error of the estimate."""
    out = tuples.groupBy("date").agg(
        F.countDistinct("username").alias("exact_users"),
        F.approx_count_distinct("username", rsd).alias("approx_users"))
    return out.withColumn("rel_error", F.abs(F.col("approx_users") - F.col("exact_users"))
                          / F.col("exact_users"))


def distinct_sketches(tuples: DataFrame, lg_k: int = 14) -> DataFrame:
    """Per day HyperLogLog sketches of users, queries and (query, user) pairs, of
    fixed size: what is kept to count distinct values of any span of days later
    (relative error about 1.04 / 2^(lg_k / 2))."""
    pair = F.concat_ws("\0", Q, "username")
    return tuples.groupBy("date").agg(*[F.hll_sketch_agg(c, lg_k).alias(n) for n, c in (
        ("users", F.col("username")), ("queries", F.col(Q)), ("pairs", pair))])


def approx_periods(sketches: DataFrame, kinds=("week", "month", "all_time")) -> DataFrame:
    """Distinct users, queries and pairs of every period from the sketches of its
    days: sketches are merged, the tuples are not read again."""
    merged = assign_periods(sketches, kinds).groupBy(*IK).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"approx_{c}") for c in ("users", "queries", "pairs")])
    return merged.select(*period_names(), "approx_users", "approx_queries", "approx_pairs")


def distinct_pairs_two_pass(tuples: DataFrame) -> DataFrame:
    """Distinct (user, query) pairs, then rows per query: two group-bys."""
    return (tuples.select(Q, "username").distinct()
            .groupBy(Q).agg(F.count(F.lit(1)).alias("unique_users")))


def _overview_cols(total_searches, total_users, unique_queries, unique_pairs):
    return [total_searches.cast("bigint").alias("total_searches"),
            total_users.cast("bigint").alias("total_users"),
            unique_queries.cast("bigint").alias("total_queries"),
            unique_pairs.cast("bigint").alias("total_search_pairs"),
            F.round(E.safe_ratio(total_searches, total_users), 6).alias("avg_searches_per_user"),
            F.round(E.safe_ratio(unique_pairs, total_users), 6).alias(
                "avg_unique_queries_per_user")]


def cumulative_overview(summary: DataFrame, as_of) -> DataFrame:
    """All-time row: totals, averages, first / last edge of the data. The
    cutoff is the end of the day before ``as_of`` (midnight - 1 s); a last
    edge past it becomes cutoff - 1 s, as the published page does."""
    s = summary.where((F.col("period_type") == "all_time") & (F.col("period_id") == "all_time"))
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")
    first = F.col("first_date").cast("timestamp_ntz")
    last = (F.col("last_date").cast("timestamp_ntz")
            + F.expr("INTERVAL '23:59:59.999999' HOUR TO SECOND"))
    last = F.when(last > cutoff, cutoff - F.expr("INTERVAL 1 SECOND")).otherwise(last)
    return s.select(
        "period_type", "period_id",
        *_overview_cols(F.col("total_searches"), F.col("total_users"), F.col("unique_queries"),
                        F.col("unique_pairs")),
        first.alias("first_search"), last.alias("last_search"),
        collection_days(first, last).alias("collection_days"),
        F.lit(False).alias("is_estimate"))


def collection_days(first, last):
    """(last - first) in days, rounded to one decimal; integer text when whole."""
    secs = (F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / 1e6
    r = F.round(secs / 86400.0, 1)
    return (F.when(first.isNull() | last.isNull(), F.lit("0"))
            .when(r == F.floor(r), F.floor(r).cast("string"))
            .otherwise(F.format_string("%.1f", r)))


def period_client_totals(daily: DataFrame) -> DataFrame:
    """Searches per (week / month, client) from the daily client statistics."""
    keyed = daily.select("client_id", "search_count", F.inline(F.array(
        F.struct(F.lit("week").alias("period_type"), E.iso_week_key("date").alias("period_id")),
        F.struct(F.lit("month").alias("period_type"), E.month_key("date").alias("period_id")))))
    return keyed.groupBy(*PERIOD_KEYS, "client_id").agg(F.sum("search_count").alias("n"))


def period_overview(daily: DataFrame, summary: DataFrame, periods: DataFrame,
                    cutoff=None) -> DataFrame:
    """Per week / month: totals from daily client stats, replaced by the
    summary row when there is one; without one an estimate (queries =
    int(users * 0.6), pairs = users) flagged by ``is_estimate``. With a
    ``cutoff`` (the last full day) later days do not count, and a period that
    begins after it has no row."""
    if cutoff is not None:
        daily = daily.where(F.col("date") <= F.lit(cutoff).cast("date"))
    p = periods.where(F.col("period_type").isin("week", "month"))
    d = daily.select("date", "search_count", "unique_users")
    # periods of one type never overlap, so each daily row meets one week and
    # one month: an equi-join on the period key, not a range join
    keyed = d.select(F.inline(F.array(
        F.struct(F.lit("week").alias("period_type"), E.iso_week_key("date").alias("period_id"),
                 "date", "search_count", "unique_users"),
        F.struct(F.lit("month").alias("period_type"), E.month_key("date").alias("period_id"),
                 "date", "search_count", "unique_users"))))
    agg = (keyed.groupBy(*PERIOD_KEYS)
           .agg(F.sum("search_count").alias("d_searches"), F.sum("unique_users").alias("d_users"),
                F.min("date").alias("first_date"), F.max("date").alias("last_date")))
    j = (p.join(agg, PERIOD_KEYS, "inner").where(F.col("d_searches") > 0)
         .join(summary.select(*PERIOD_KEYS, F.col("unique_queries").alias("s_queries"),
                              F.col("unique_pairs").alias("s_pairs"),
                              F.col("total_searches").alias("s_searches"),
                              F.col("total_users").alias("s_users"),
                              F.lit(True).alias("_has")), PERIOD_KEYS, "left"))
    has = F.col("_has").isNotNull()
    searches = F.when(has & F.col("s_searches").isNotNull(), F.col("s_searches")).otherwise(
        F.col("d_searches"))
    users = F.when(has & F.col("s_users").isNotNull(), F.col("s_users")).otherwise(F.col("d_users"))
    queries = F.when(has, F.col("s_queries")).otherwise(
        F.when(users > 0, F.floor(users * F.lit(0.6))).otherwise(F.lit(0)))
    pairs = F.when(has, F.col("s_pairs")).otherwise(users)
    return j.select(
        *PERIOD_KEYS, *_overview_cols(searches, users, queries, pairs),
        F.col("first_date").cast("timestamp_ntz").alias("first_search"),
        (F.col("last_date").cast("timestamp_ntz")
         + F.expr("INTERVAL '23:59:59.999999' HOUR TO SECOND")).alias("last_search"),
        (~has).alias("is_estimate"))
