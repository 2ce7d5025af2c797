"""Registered jobs: name -> Spark callable ``(spark, sf_dir) -> DataFrame`` and
name -> independent DuckDB SQL over the driver's tables.

Every job reads the given tables in full (fixtures S1, S1C, S2, T2, DOC of
FIXTURES.md are all derived from them) so its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as E
from ..operators import periods as P
from ..operators import rollup as R
from ..operators import stats as ST
from ..sources import fixtures as FX
from . import oracle as O

from .registry import ORACLE, once_per_session, register


def s2_tuples(spark, sf):
    return R.daily_search_tuples(FX.searches_s2(spark, sf))


BLACKLIST = E.parse_blacklist(FX.TEST_BLACKLIST)
BLACKLIST_RX = E.blacklist_regex(BLACKLIST)
# the salt of the key in fixtures.py, as text
SALT = "CHKANX39xaMXfhe3Qkx9-x6rLQi6O-3rJD3FHVwY3Ig="

# ---------------------------------------------------------------------------
# Rollups
# ---------------------------------------------------------------------------


@register("daily_search_tuples", f"SELECT * FROM {O.T2}")
def q_daily_search_tuples(spark, sf):
    return s2_tuples(spark, sf)


@register("daily_client_stats", f"""
SELECT client_id, CAST("timestamp" AS DATE) AS date, COUNT(*) AS search_count,
       COUNT(DISTINCT username) AS unique_users
FROM {O.S2_SQL} s GROUP BY 1, 2""")
def q_daily_client_stats(spark, sf):
    return R.daily_client_stats(FX.searches_s2(spark, sf))


# ---------------------------------------------------------------------------
# Period statistics
# ---------------------------------------------------------------------------


@register("period_summary", f"""
SELECT period_type, period_id, COUNT(DISTINCT query_normalized) AS unique_queries,
       COUNT(DISTINCT (username, query_normalized)) AS unique_pairs,
       CAST(SUM(search_count) AS BIGINT) AS total_searches,
       COUNT(DISTINCT username) AS total_users, MIN(date) AS first_date, MAX(date) AS last_date
FROM {O.periods_of(O.T2)} p GROUP BY 1, 2""")
def q_period_summary(spark, sf):
    return ST.period_summary(s2_tuples(spark, sf))


@register("period_top_queries", O.top_sql(O.T2))
def q_period_top_queries(spark, sf):
    return ST.period_top_queries(s2_tuples(spark, sf))


@register("query_length_dist", f"""
SELECT period_type, period_id, query_length, COUNT(*) AS unique_query_count FROM (
  SELECT DISTINCT period_type, period_id, query_normalized,
         CAST(len(string_split(query_normalized, ' ')) AS INTEGER) AS query_length
  FROM {O.periods_of(O.T2)} p) q
WHERE query_length <= 100 GROUP BY 1, 2, 3""")
def q_query_length_dist(spark, sf):
    return ST.query_length_dist(s2_tuples(spark, sf))


@register("query_length_dist_docs", f"""
SELECT period_type, period_id, query_length, COUNT(*) AS unique_query_count FROM (
  SELECT DISTINCT 'all_time' AS period_type, 'all_time' AS period_id, query,
         CAST(len(string_split(query, ' ')) AS INTEGER) AS query_length FROM {O.DOC_SQL} d) q
WHERE query_length <= 100 GROUP BY 1, 2, 3""")
def q_query_length_dist_docs(spark, sf):
    docs = FX.documents_as_queries(spark, sf)
    by_query = docs.select(F.lit(ST.PERIOD_CODES["all_time"]).cast("tinyint").alias("_pt"),
                           F.lit(0).alias("_pk"),
                           F.col("query").alias("query_normalized")).distinct()
    return ST.length_from(by_query)


@register("generate_periods", f"""
WITH r AS (SELECT MIN(date) AS mn, MAX(date) AS mx FROM {O.T2} t),
w AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('week', mn) AS DATE), mx, INTERVAL 7 DAY)) AS DATE) AS s FROM r),
m AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', mn) AS DATE), mx, INTERVAL 1 MONTH)) AS DATE) AS s FROM r)
SELECT 'week' AS period_type, CAST(isoyear(s) AS VARCHAR) || '-W' || lpad(CAST(week(s) AS VARCHAR), 2, '0') AS period_id,
       s AS start_date, CAST(s + INTERVAL 6 DAY AS DATE) AS end_date FROM w
UNION ALL SELECT 'month', strftime(s, '%Y-%m'), s, CAST(last_day(s) AS DATE) FROM m
UNION ALL SELECT 'all_time', 'all_time', mn, mx FROM r""")
def q_generate_periods(spark, sf):
    return P.generate_periods(s2_tuples(spark, sf))


@register("query_daily_stats", f"""
SELECT query_normalized, date, CAST(SUM(search_count) AS BIGINT) AS search_count,
       COUNT(DISTINCT username) AS unique_users
FROM {O.T2} t WHERE query_normalized IN {O.eligible_sql(O.T2)}
GROUP BY 1, 2""")
def q_query_daily_stats(spark, sf):
    return ST.query_daily_stats(s2_tuples(spark, sf))


# ---------------------------------------------------------------------------
# Scalar expressions, each applied to a whole table
# ---------------------------------------------------------------------------


@register("normalize_query", f"""
SELECT DISTINCT query, lower(trim(query)) AS query_normalized FROM {O.S1_SQL} s""")
def q_normalize_query(spark, sf):
    s = FX.searches_s1(spark, sf)
    return s.select("query", E.normalize_query("query").alias("query_normalized")).distinct()


@register("word_count", f"""
SELECT doc_id, CAST(len(string_split(query, ' ')) AS INTEGER) AS query_length FROM {O.DOC_SQL} d""")
def q_word_count(spark, sf):
    d = FX.documents_as_queries(spark, sf)
    return d.select("doc_id", E.word_count("query").alias("query_length"))


@register("iso_week_key", f"""
SELECT DISTINCT date, {O.WEEK_ID} AS period_id, CAST(date_trunc('week', date) AS DATE) AS week_start,
       CAST(date_trunc('week', date) + INTERVAL 6 DAY AS DATE) AS week_end,
       CAST(date_trunc('month', date) AS DATE) AS month_start, CAST(last_day(date) AS DATE) AS month_end
FROM {O.T2} t""")
def q_iso_week_key(spark, sf):
    t = s2_tuples(spark, sf).select("date").distinct()
    return t.select("date", E.iso_week_key("date").alias("period_id"),
                    E.week_start("date").alias("week_start"), E.week_end("date").alias("week_end"),
                    E.month_start("date").alias("month_start"), E.month_end("date").alias("month_end"))


@register("time_bucket", f"""
SELECT DISTINCT "timestamp", CAST(floor(epoch_us("timestamp") / 300000000.0) AS BIGINT) AS time_bucket
FROM {O.S1_SQL} s""")
def q_time_bucket(spark, sf):
    s = FX.searches_s1(spark, sf)
    return s.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                    E.time_bucket("timestamp", 300).alias("time_bucket")).distinct()


def _slug_sql(src: str, key: str) -> str:
    return f"""
SELECT {key}, CASE WHEN s2 = '' THEN h ELSE s2 || '-' || h END AS slug FROM (
  SELECT {key}, h, CASE WHEN length(s1) > 80 THEN rtrim(left(s1, 80), '-') ELSE s1 END AS s2 FROM (
    SELECT {key}, trim(regexp_replace(lower(query), '[^a-z0-9]+', '-', 'g'), '-') AS s1,
           left(sha256(query), 8) AS h FROM {src}) a) b"""


@register("slug", _slug_sql(O.DOC_SQL + " d", "doc_id"))
def q_slug(spark, sf):
    d = FX.documents_as_queries(spark, sf)
    return d.select("doc_id", E.slug("query").alias("slug"))


@register("pseudonymize_users", f"""
SELECT DISTINCT username, sha256('{SALT}' || username) AS user_hash FROM {O.S1_SQL} s""")
def q_pseudonymize_users(spark, sf):
    s = FX.searches_s1(spark, sf)
    return s.select("username", E.pseudonymize("username", FX.TEST_SALT).alias("user_hash")).distinct()


@register("blacklist_filter", f"""
SELECT DISTINCT query_normalized FROM {O.T2} t
WHERE NOT {O.blacklist_sql('query_normalized', BLACKLIST_RX)}""")
def q_blacklist_filter(spark, sf):
    t = s2_tuples(spark, sf).select("query_normalized").distinct()
    return t.where(~E.is_blacklisted("query_normalized", BLACKLIST))


TOKEN_SPLIT = r"[\t\n\x{0B}\f\r\x{85}\pZ]+"


@register("tokenize", f"""
SELECT DISTINCT doc_id, word FROM (
  SELECT doc_id, unnest(regexp_split_to_array(lower(query), '{TOKEN_SPLIT}')) AS word
  FROM {O.DOC_SQL} d) x WHERE word <> ''""")
def q_tokenize(spark, sf):
    d = FX.documents_as_queries(spark, sf)
    return d.select("doc_id", F.explode(E.tokenize("query")).alias("word"))


# ---------------------------------------------------------------------------
# Convergence (S1C, whole table, window of one day)
# ---------------------------------------------------------------------------
from ..operators import convergence as CV  # noqa: E402

_S1_START, _S1_END = FX.s1_window()
_W = FX.S1C_WINDOW_SECONDS
_RANGE = (f"\"timestamp\" BETWEEN TIMESTAMP '{_S1_START.isoformat(sep=' ')}' "
          f"AND TIMESTAMP '{_S1_END.isoformat(sep=' ')}'")
def conv_cte(src_sql: str, window: int) -> str:
    return f"""WITH s AS (SELECT * FROM {src_sql} x WHERE {_RANGE}),
se AS (SELECT username, lower(trim(query)) AS norm_query,
              CAST(floor(epoch_us("timestamp") / {window * 1_000_000}.0) AS BIGINT) AS time_bucket,
              client_id, MIN("timestamp") AS first_seen FROM s GROUP BY ALL),
ec AS (SELECT username, norm_query, time_bucket, COUNT(DISTINCT client_id) AS client_count,
              MIN(first_seen) AS earliest, MAX(first_seen) AS latest FROM se GROUP BY ALL),
nc AS (SELECT COUNT(DISTINCT client_id) AS n FROM se)
"""


CONV_CTE = conv_cte(O.S1C_SQL, _W)


def s1c_events(spark, sf):
    return CV.search_events(FX.searches_s1c(spark, sf), _S1_START, _S1_END, _W)


@register("search_events", CONV_CTE + """
SELECT username, norm_query, time_bucket, client_id, first_seen FROM se""")
def q_search_events(spark, sf):
    return s1c_events(spark, sf).withColumn("first_seen", F.col("first_seen").cast("timestamp_ntz"))


@register("event_client_distribution", CONV_CTE + """
SELECT client_count, COUNT(*) AS event_count,
       round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS pct
FROM ec WHERE (SELECT n FROM nc) >= 2 GROUP BY client_count""")
def q_event_client_distribution(spark, sf):
    return CV.event_client_distribution(s1c_events(spark, sf))


@register("full_convergence", CONV_CTE + """
SELECT n AS n_clients, full_events, total_events,
       round(CASE WHEN total_events > 0 THEN full_events * 100.0 / total_events ELSE 0 END, 6) AS rate
FROM (SELECT (SELECT n FROM nc) AS n,
             CAST(SUM(CASE WHEN client_count = (SELECT n FROM nc) THEN 1 ELSE 0 END) AS BIGINT) AS full_events,
             COUNT(*) AS total_events FROM ec) t WHERE n >= 2""")
def q_full_convergence(spark, sf):
    return CV.full_convergence(s1c_events(spark, sf))


@register("spread_histogram", O.spread_sql(CONV_CTE))
def q_spread_histogram(spark, sf):
    return CV.spread_histogram(s1c_events(spark, sf))


@register("events_per_client", CONV_CTE + """
SELECT client_id, COUNT(*) AS unique_events FROM se WHERE (SELECT n FROM nc) >= 2 GROUP BY 1""")
def q_events_per_client(spark, sf):
    return CV.events_per_client(s1c_events(spark, sf))


@register("client_overlap", O.overlap_sql(CONV_CTE))
def q_client_overlap(spark, sf):
    return CV.client_overlap(s1c_events(spark, sf))


@register("unique_contribution", CONV_CTE + """,
tot AS (SELECT client_id, COUNT(*) AS total_events FROM se GROUP BY 1),
uq AS (SELECT se.client_id, COUNT(*) AS unique_events FROM se JOIN ec USING (username, norm_query, time_bucket)
       WHERE ec.client_count = 1 GROUP BY 1)
SELECT tot.client_id, COALESCE(uq.unique_events, 0) AS unique_events, total_events,
       round(COALESCE(uq.unique_events, 0) * 100.0 / total_events, 6) AS pct
FROM tot LEFT JOIN uq USING (client_id) WHERE (SELECT n FROM nc) >= 2""")
def q_unique_contribution(spark, sf):
    return CV.unique_contribution(s1c_events(spark, sf))


@register("sample_converged", CONV_CTE + """
SELECT username, norm_query, time_bucket,
       string_agg(client_id, ' -> ' ORDER BY first_seen, client_id) AS client_order,
       MIN(first_seen) AS earliest, MAX(first_seen) AS latest,
       round((epoch_us(MAX(first_seen)) - epoch_us(MIN(first_seen))) / 1000000.0, 6) AS spread_seconds,
       CASE WHEN length(norm_query) > 50 THEN left(norm_query, 50) || '...' ELSE norm_query END AS query_preview,
       CASE WHEN length(username) > 12 THEN left(username, 12) || '...' ELSE username END AS user_preview
FROM se GROUP BY username, norm_query, time_bucket
HAVING COUNT(DISTINCT client_id) = (SELECT n FROM nc) AND (SELECT n FROM nc) >= 2
ORDER BY earliest DESC, username, norm_query, time_bucket LIMIT 10""")
def q_sample_converged(spark, sf):
    return CV.sample_converged(s1c_events(spark, sf))


@register("distinct_clients", f"""
SELECT DISTINCT client_id FROM {O.S1C_SQL} x WHERE {_RANGE}""")
def q_distinct_clients(spark, sf):
    from ..sources.scans import scan_time_range
    return ST.distinct_clients(scan_time_range(FX.searches_s1c(spark, sf), _S1_START, _S1_END))


@register("raw_per_client", f"""
SELECT client_id, COUNT(*) AS n FROM {O.S1C_SQL} x WHERE {_RANGE} GROUP BY 1""")
def q_raw_per_client(spark, sf):
    from ..sources.scans import scan_time_range
    return ST.raw_per_client(scan_time_range(FX.searches_s1c(spark, sf), _S1_START, _S1_END))


@register("scan_time_range", f"""
SELECT client_id, "timestamp", username, query FROM {O.S1_SQL} x
WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""")
def q_scan_time_range(spark, sf):
    import datetime as dt
    from ..sources.scans import scan_time_range
    s = scan_time_range(FX.searches_s1(spark, sf), dt.datetime(2024, 1, 10),
                        dt.datetime(2024, 1, 12, 12))
    return s.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# ---------------------------------------------------------------------------
# Similarity and detail tables (S2, as_of 2001-08-02)
# ---------------------------------------------------------------------------
import datetime as _dt  # noqa: E402

from ..operators import detail as DT  # noqa: E402
from ..operators import similarity as SM  # noqa: E402

AS_OF = FX.S2_AS_OF
CUTOFF = AS_OF - _dt.timedelta(days=1)
BL_SQL = O.blacklist_sql("query_normalized", BLACKLIST_RX)
SIM_CTE = f"""WITH t AS {O.T2},
elig AS (SELECT query_normalized FROM t GROUP BY 1 HAVING COUNT(DISTINCT username) >= 35),
p AS (SELECT DISTINCT username, query_normalized FROM t
      WHERE query_normalized IN (SELECT query_normalized FROM elig) AND NOT {BL_SQL}),
n AS (SELECT query_normalized AS q, COUNT(*) AS n FROM p GROUP BY 1),
sh AS (SELECT a.query_normalized AS query, b.query_normalized AS similar_query, COUNT(*) AS shared_users
       FROM p a JOIN p b ON a.username = b.username AND a.query_normalized <> b.query_normalized
       GROUP BY 1, 2 HAVING COUNT(*) >= 5),
sc AS (SELECT sh.*, shared_users / sqrt(na.n * nb.n) AS score FROM sh
       JOIN n na ON na.q = sh.query JOIN n nb ON nb.q = sh.similar_query),
sim AS (SELECT query, similar_query, shared_users, round(score, 6) AS score, CAST(rn AS INTEGER) AS rn FROM (
         SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, shared_users DESC, similar_query) AS rn
         FROM sc WHERE score > 0) r WHERE rn <= 20)
"""
DETAIL_CTE = SIM_CTE + f""",
st AS {O.query_stats_sql('t')},
qd AS (SELECT query_normalized, date, CAST(SUM(search_count) AS BIGINT) AS search_count,
              COUNT(DISTINCT username) AS unique_users FROM t
       WHERE query_normalized IN (SELECT query_normalized FROM elig) GROUP BY 1, 2),
sl AS (SELECT DISTINCT query_normalized, {O.slug_expr('query_normalized')} AS slug FROM qd
       WHERE date <= DATE '{CUTOFF.isoformat()}' AND NOT {BL_SQL}),
dq AS (SELECT CAST(row_number() OVER (ORDER BY unique_users DESC, total_searches DESC, query_normalized) AS INTEGER) AS rank,
              st.query_normalized AS query, unique_users, total_searches, sl.slug
       FROM st LEFT JOIN sl USING (query_normalized)
       WHERE unique_users >= 35 AND NOT {O.blacklist_sql('st.query_normalized', BLACKLIST_RX)})
"""


def s2_pairs(spark, sf, mode="run_date"):
    return SM.user_query_pairs(s2_tuples(spark, sf), AS_OF, mode)


def s2_eligible_pairs(spark, sf, mode="run_date", recent=E.RECENT_DAYS):
    t = s2_tuples(spark, sf)
    return SM.eligible_pairs(SM.user_query_pairs(t, AS_OF, mode), ST.eligible_queries(t),
                             AS_OF, recent, BLACKLIST)


def s2_detail(spark, sf):
    stats = ST.all_time_query_stats(s2_tuples(spark, sf))
    return DT.detail_queries(stats, blacklist=BLACKLIST, slug_cutoff=CUTOFF)


def s2_similar(spark, sf):
    return SM.query_similarity(s2_eligible_pairs(spark, sf))


@register("user_query_pairs", f"""
SELECT username, query_normalized, MAX(date) AS last_seen FROM {O.T2} t GROUP BY 1, 2""")
def q_user_query_pairs(spark, sf):
    return s2_pairs(spark, sf, "event_date")


@register("eligible_pairs", SIM_CTE + f"""
SELECT username, query_normalized FROM (
  SELECT username, query_normalized, MAX(date) AS last_seen FROM t GROUP BY 1, 2) x
WHERE query_normalized IN (SELECT query_normalized FROM elig) AND NOT {BL_SQL}
  AND last_seen >= DATE '{AS_OF.isoformat()}' - INTERVAL 90 DAY""")
def q_eligible_pairs(spark, sf):
    return s2_eligible_pairs(spark, sf, "event_date")


@register("cooccurrence", f"""
WITH p AS (SELECT DISTINCT username, query_normalized FROM {O.T2} t)
SELECT a.query_normalized AS query, b.query_normalized AS similar_query, COUNT(*) AS shared_users
FROM p a JOIN p b ON a.username = b.username AND a.query_normalized <> b.query_normalized
GROUP BY 1, 2 HAVING COUNT(*) >= 5""")
def q_cooccurrence(spark, sf):
    return SM.cooccurrence(s2_pairs(spark, sf))


@register("query_similarity", SIM_CTE + "SELECT * FROM sim")
def q_query_similarity(spark, sf):
    return s2_similar(spark, sf)


@register("detail_queries", DETAIL_CTE + "SELECT * FROM dq")
def q_detail_queries(spark, sf):
    return s2_detail(spark, sf)


@register("word_index", DETAIL_CTE + f"""
SELECT DISTINCT word, rank FROM (
  SELECT rank, unnest(regexp_split_to_array(lower(query), '{TOKEN_SPLIT}')) AS word FROM dq) x
WHERE word <> ''""")
def q_word_index(spark, sf):
    return DT.word_index(s2_detail(spark, sf))


@register("detail_daily", DETAIL_CTE + f"""
SELECT rank, date, search_count, qd.unique_users FROM qd JOIN dq ON dq.query = qd.query_normalized
WHERE date <= DATE '{CUTOFF.isoformat()}'""")
def q_detail_daily(spark, sf):
    t = s2_tuples(spark, sf)
    return DT.detail_daily(s2_detail(spark, sf), ST.query_daily_stats(t), CUTOFF)


@register("detail_similar", DETAIL_CTE + """
SELECT a.rank, b.rank AS similar_rank, score, shared_users FROM sim
JOIN dq a ON a.query = sim.query JOIN dq b ON b.query = sim.similar_query""")
def q_detail_similar(spark, sf):
    return DT.detail_similar(s2_detail(spark, sf), s2_similar(spark, sf))


@register("slug_dimension", DETAIL_CTE + "SELECT query_normalized, slug FROM sl")
def q_slug_dimension(spark, sf):
    t = s2_tuples(spark, sf)
    return DT.slug_map(ST.query_daily_stats(t), CUTOFF, BLACKLIST)


@once_per_session
def _detail_paths(spark, sf):
    """The detail tables as the publish step writes them: point lookups read
    these, sorted on the lookup column, instead of building the list anew."""
    import uuid

    from ..sources import sinks as SK
    root = f"{SK.warehouse_root(spark)}/lookup-{uuid.uuid4().hex}"
    t = SK.snapshot(s2_tuples(spark, sf), f"{root}/_tuples")  # read by all three tables
    stats = ST.all_time_query_stats(t)
    d = DT.detail_queries(stats, blacklist=BLACKLIST, slug_cutoff=CUTOFF)
    pairs = SM.eligible_pairs(SM.user_query_pairs(t, AS_OF, "run_date"), ST.eligible_queries(t), AS_OF,
                              E.RECENT_DAYS, BLACKLIST)
    out = SK.export_detail_tables(root, {
        "queries": d, "query_daily": DT.detail_daily(d, ST.query_daily_stats(t), CUTOFF),
        "query_similar": DT.detail_similar(d, SM.query_similarity(pairs))})
    SK.delete_path(spark, f"{root}/_tuples")
    return out


def s2_detail_table(spark, sf, name):
    return spark.read.parquet(_detail_paths(spark, sf)[name])


@register("query_by_slug", DETAIL_CTE + """
SELECT * FROM dq WHERE slug = (SELECT slug FROM dq WHERE rank = 1)""")
def q_query_by_slug(spark, sf):
    d = s2_detail_table(spark, sf, "queries")
    return DT.query_by_slug(d, d.where(F.col("rank") == 1).select("slug").scalar())


@register("daily_by_rank", DETAIL_CTE + f"""
SELECT rank, date, search_count, qd.unique_users FROM qd JOIN dq ON dq.query = qd.query_normalized
WHERE date <= DATE '{CUTOFF.isoformat()}' AND rank = 1""")
def q_daily_by_rank(spark, sf):
    return DT.daily_by_rank(s2_detail_table(spark, sf, "query_daily"), 1)


@register("similar_detail", DETAIL_CTE + """,
ds AS (SELECT a.rank, b.rank AS similar_rank, score, shared_users FROM sim
       JOIN dq a ON a.query = sim.query JOIN dq b ON b.query = sim.similar_query)
SELECT ds.similar_rank, ds.rank, ds.score, ds.shared_users, dq.query AS similar_query, dq.slug AS similar_slug
FROM ds JOIN dq ON dq.rank = ds.similar_rank WHERE ds.rank = 1
ORDER BY score DESC, shared_users DESC, similar_rank LIMIT 10""")
def q_similar_detail(spark, sf):
    return DT.similar_detail(s2_detail_table(spark, sf, "queries"),
                             s2_detail_table(spark, sf, "query_similar"), 1)


@register("top25_chart", f"""
SELECT query_normalized, unique_users, total_searches, rank,
       (SELECT COUNT(*) FROM ({O.top_sql(O.T2, where="WHERE period_type = 'all_time'")}) c) AS total_count
FROM ({O.top_sql(O.T2, where="WHERE period_type = 'all_time'")}) x
ORDER BY rank LIMIT 25""")
def q_top25_chart(spark, sf):
    top = ST.period_top_queries(s2_tuples(spark, sf), kinds=("all_time",))
    return DT.top_chart(top.drop("period_type", "period_id"), 25)


@register("table_search", DETAIL_CTE + """
SELECT *, (SELECT COUNT(*) FROM dq WHERE contains(lower(query), 'small')) AS match_count
FROM dq WHERE contains(lower(query), 'small') ORDER BY rank LIMIT 200""")
def q_table_search(spark, sf):
    return DT.table_search(s2_detail(spark, sf), "small")


@register("table_search_all", DETAIL_CTE + """
SELECT *, (SELECT COUNT(*) FROM dq) AS match_count FROM dq ORDER BY rank LIMIT 100""")
def q_table_search_all(spark, sf):
    return DT.table_search(s2_detail(spark, sf), None)


@register("search_index", DETAIL_CTE + f"""
SELECT st.query_normalized AS q, unique_users AS u, total_searches AS t, sl.slug AS s
FROM st LEFT JOIN sl USING (query_normalized)
WHERE unique_users >= 5 AND NOT {O.blacklist_sql('st.query_normalized', BLACKLIST_RX)}""")
def q_search_index(spark, sf):
    stats = ST.all_time_query_stats(s2_tuples(spark, sf))
    return DT.search_index(stats, blacklist=BLACKLIST, slug_cutoff=CUTOFF)


@register("suggest_search", DETAIL_CTE + f""",
ix AS (SELECT st.query_normalized AS q, unique_users AS u, total_searches AS t, sl.slug AS s
       FROM st LEFT JOIN sl USING (query_normalized)
WHERE unique_users >= 5 AND NOT {O.blacklist_sql('st.query_normalized', BLACKLIST_RX)})
SELECT * FROM ix WHERE contains(lower(q), 'small') ORDER BY u DESC, t DESC, q LIMIT 12""")
def q_suggest_search(spark, sf):
    return DT.suggest_search(q_search_index(spark, sf), "small")


@once_per_session
def _search_paths(spark, sf):
    """Search tables, written once: the ranked list with its trigrams, the search
    box index with its trigrams and the suggestions for short terms."""
    import uuid

    from ..sources import sinks as SK
    root = f"{SK.warehouse_root(spark)}/search-{uuid.uuid4().hex}"
    # one row per query, counted once: the list, the index and their postings come from it
    stats = SK.snapshot(ST.all_time_query_stats(s2_tuples(spark, sf)), f"{root}/stats")
    d = DT.detail_queries(stats, blacklist=BLACKLIST, slug_cutoff=CUTOFF)
    ix = DT.search_index(stats, blacklist=BLACKLIST, slug_cutoff=CUTOFF)
    return SK.export_detail_tables(root, {
        "queries": d, "grams": DT.gram_postings(d, "query", "rank"), "entries": ix,
        "entry_grams": DT.gram_postings(ix, "q", "q"), "suggestions": DT.suggestions(ix)})


def s2_search_table(spark, sf, name):
    return spark.read.parquet(_search_paths(spark, sf)[name])


@register("table_search_indexed", ORACLE["table_search"])
def q_table_search_indexed(spark, sf):
    return DT.table_search_indexed(*(s2_search_table(spark, sf, t) for t in ("queries", "grams")), "small")


def _suggest(spark, sf, term):
    return DT.suggest_search_indexed(*(s2_search_table(spark, sf, t) for t in ("entries", "suggestions", "entry_grams")),
                                     term)


@register("suggest_search_indexed", ORACLE["suggest_search"])
def q_suggest_search_indexed(spark, sf):
    return _suggest(spark, sf, "small")


@register("suggest_search_short", ORACLE["suggest_search"].replace("'small'", "'sm'"))
def q_suggest_search_short(spark, sf):
    return _suggest(spark, sf, "sm")


@register("recent_searches", f"""
SELECT client_id, "timestamp", query FROM {O.S1_SQL} s ORDER BY "timestamp" DESC, client_id, query LIMIT 10""")
def q_recent_searches(spark, sf):
    r = DT.recent_searches(FX.searches_s1(spark, sf))
    return r.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


S1_CUTOFF = FX.S1_AS_OF.date() - _dt.timedelta(days=1)


@register("search_index_s1", f"""
WITH t AS {O.tuples(O.S1_SQL)}, st AS {O.query_stats_sql('t')},
fd AS (SELECT query_normalized, MIN(date) AS first_date FROM t GROUP BY 1)
SELECT st.query_normalized AS q, unique_users AS u, total_searches AS t,
       CASE WHEN unique_users >= 35 AND first_date <= DATE '{S1_CUTOFF}'
            THEN {O.slug_expr('st.query_normalized')} END AS s
FROM st JOIN fd USING (query_normalized)
WHERE unique_users >= 5 AND NOT {O.blacklist_sql('st.query_normalized', BLACKLIST_RX)}""")
def q_search_index_s1(spark, sf):
    """The search box index over the sub-day log S1 (where many queries have
    fewer than 5 users and drop out of the all-time list)."""
    stats = ST.all_time_query_stats(R.daily_search_tuples(FX.searches_s1(spark, sf)))
    return DT.search_index(stats, blacklist=BLACKLIST, slug_cutoff=S1_CUTOFF)


@register("table_search_docs", f"""
WITH d AS {O.DOC_SQL}
SELECT doc_id AS rank, left(query, 80) AS query_preview,
       (SELECT COUNT(*) FROM d WHERE contains(query, 'license')) AS match_count
FROM d WHERE contains(query, 'license') ORDER BY doc_id LIMIT 200""")
def q_table_search_docs(spark, sf):
    """Substring search over whole document texts (every text is searched in
    full; only the returned preview is cut), first 200 matches by doc id."""
    d = FX.documents_as_queries(spark, sf).withColumnRenamed("doc_id", "rank")
    return (DT.table_search(d, "license", query_col="query")
            .select("rank", F.substring("query", 1, 80).alias("query_preview"), "match_count"))



# ---------------------------------------------------------------------------
# Sub-day variants on S1: 5-minute event window, 2024 ISO weeks
# ---------------------------------------------------------------------------
S1_CONV = conv_cte(O.S1_SQL, 300)


def s1_events(spark, sf):
    return CV.search_events(FX.searches_s1(spark, sf), _S1_START, _S1_END, 300)


@register("event_client_distribution_s1", S1_CONV + """
SELECT client_count, COUNT(*) AS event_count,
       round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS pct
FROM ec WHERE (SELECT n FROM nc) >= 2 GROUP BY client_count""")
def q_event_client_distribution_s1(spark, sf):
    return CV.event_client_distribution(s1_events(spark, sf))


# in the S1 log the clients meet within weeks, not within minutes
S1_MONTH = conv_cte(O.S1_SQL, 30 * 86400)


@register("spread_histogram_s1", O.spread_sql(S1_MONTH))
def q_spread_histogram_s1(spark, sf):
    return CV.spread_histogram(CV.search_events(FX.searches_s1(spark, sf), _S1_START, _S1_END, 30 * 86400))


@register("unique_contribution_s1", S1_CONV + """,
tot AS (SELECT client_id, COUNT(*) AS total_events FROM se GROUP BY 1),
uq AS (SELECT se.client_id, COUNT(*) AS unique_events FROM se JOIN ec USING (username, norm_query, time_bucket)
       WHERE ec.client_count = 1 GROUP BY 1)
SELECT tot.client_id, COALESCE(uq.unique_events, 0) AS unique_events, total_events,
       round(COALESCE(uq.unique_events, 0) * 100.0 / total_events, 6) AS pct
FROM tot LEFT JOIN uq USING (client_id) WHERE (SELECT n FROM nc) >= 2""")
def q_unique_contribution_s1(spark, sf):
    return CV.unique_contribution(s1_events(spark, sf))


S1_TUPLES = O.tuples(O.S1_SQL)


@register("period_summary_s1", f"SELECT * FROM {O.summary_sql(S1_TUPLES)} s")
def q_period_summary_s1(spark, sf):
    return ST.period_summary(R.daily_search_tuples(FX.searches_s1(spark, sf)))


@register("period_top_queries_s1", O.top_sql(S1_TUPLES))
def q_period_top_queries_s1(spark, sf):
    return ST.period_top_queries(R.daily_search_tuples(FX.searches_s1(spark, sf)))


S1C_HOUR = conv_cte(O.S1C_SQL, 3600)


@register("spread_histogram_hour", O.spread_sql(S1C_HOUR))
def q_spread_histogram_hour(spark, sf):
    ev = CV.search_events(FX.searches_s1c(spark, sf), _S1_START, _S1_END, 3600)
    return CV.spread_histogram(ev)


@register("client_overlap_hour", O.overlap_sql(S1C_HOUR))
def q_client_overlap_hour(spark, sf):
    ev = CV.search_events(FX.searches_s1c(spark, sf), _S1_START, _S1_END, 3600)
    return CV.client_overlap(ev)
