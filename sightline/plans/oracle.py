"""DuckDB text of the fixtures and of reusable steps, for the oracle SQL.

The oracle is written independently of the Spark code: plain SQL over the
driver's tables, with COUNT(DISTINCT ...) where Spark uses two group-bys.
"""

from __future__ import annotations

from ..functions.expr import SPREAD_BUCKETS, SPREAD_LAST

from ..sources.fixtures import DOC_SQL, S1_SQL, S1C_SQL, S2_SQL  # noqa: F401

WEEK_ID = ("CAST(isoyear(date) AS VARCHAR) || '-W' || lpad(CAST(week(date) AS VARCHAR), 2, '0')")
MONTH_ID = "strftime(date, '%Y-%m')"


def tuples(searches_sql: str) -> str:
    return f"""(SELECT CAST("timestamp" AS DATE) AS date, username,
        lower(trim(query)) AS query_normalized, COUNT(*) AS search_count
        FROM {searches_sql} s GROUP BY ALL)"""


T2 = tuples(S2_SQL)


def periods_of(t: str) -> str:
    """Every tuple tagged with its week, its month and all_time."""
    return f"""(SELECT 'week' AS period_type, {WEEK_ID} AS period_id, * FROM {t} x
      UNION ALL SELECT 'month', {MONTH_ID}, * FROM {t} y
      UNION ALL SELECT 'all_time', 'all_time', * FROM {t} z)"""


def top_sql(t: str, min_users: int = 5, where: str = "") -> str:
    return f"""SELECT period_type, period_id, query_normalized,
        COUNT(DISTINCT username) AS unique_users,
        CAST(SUM(search_count) AS BIGINT) AS total_searches,
        CAST(row_number() OVER (PARTITION BY period_type, period_id
             ORDER BY COUNT(DISTINCT username) DESC, SUM(search_count) DESC,
                      query_normalized) AS INTEGER) AS rank
      FROM {periods_of(t)} p {where}
      GROUP BY period_type, period_id, query_normalized
      HAVING COUNT(DISTINCT username) >= {min_users}"""


def eligible_sql(t: str, min_users: int = 35) -> str:
    return f"""(SELECT query_normalized FROM {t} e GROUP BY query_normalized
      HAVING COUNT(DISTINCT username) >= {min_users})"""


def blacklist_sql(col: str, regex: str | None) -> str:
    """DuckDB predicate: TRUE when the column matches the blacklist regex."""
    if regex is None:
        return "FALSE"
    return f"regexp_matches(lower({col}), '{regex.replace(chr(39), chr(39) * 2)}')"


def slug_expr(c: str) -> str:
    """DuckDB expression of the slug of column ``c``."""
    x = f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-')"
    cut = f"(CASE WHEN length({x}) > 80 THEN rtrim(left({x}, 80), '-') ELSE {x} END)"
    h = f"left(sha256({c}), 8)"
    return f"(CASE WHEN {cut} = '' THEN {h} ELSE {cut} || '-' || {h} END)"


def query_stats_sql(t: str) -> str:
    return f"""(SELECT query_normalized, COUNT(DISTINCT username) AS unique_users,
        CAST(SUM(search_count) AS BIGINT) AS total_searches FROM {t} qs GROUP BY 1)"""


def summary_sql(t: str) -> str:
    return f"""(SELECT period_type, period_id, COUNT(DISTINCT query_normalized) AS unique_queries,
       COUNT(DISTINCT (username, query_normalized)) AS unique_pairs,
       CAST(SUM(search_count) AS BIGINT) AS total_searches,
       COUNT(DISTINCT username) AS total_users, MIN(date) AS first_date, MAX(date) AS last_date
FROM {periods_of(t)} p GROUP BY 1, 2)"""


def periods_sql(t: str) -> str:
    return f"""(WITH r AS (SELECT MIN(date) AS mn, MAX(date) AS mx FROM {t} t),
w AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('week', mn) AS DATE), mx, INTERVAL 7 DAY)) AS DATE) AS s FROM r),
m AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', mn) AS DATE), mx, INTERVAL 1 MONTH)) AS DATE) AS s FROM r)
SELECT 'week' AS period_type, CAST(isoyear(s) AS VARCHAR) || '-W' || lpad(CAST(week(s) AS VARCHAR), 2, '0') AS period_id,
       s AS start_date, CAST(s + INTERVAL 6 DAY AS DATE) AS end_date FROM w
UNION ALL SELECT 'month', strftime(s, '%Y-%m'), s, CAST(last_day(s) AS DATE) FROM m
UNION ALL SELECT 'all_time', 'all_time', mn, mx FROM r)"""


def daily_stats_sql(searches_sql: str, where: str = "TRUE") -> str:
    return f"""(SELECT client_id, CAST("timestamp" AS DATE) AS date, COUNT(*) AS search_count,
       COUNT(DISTINCT username) AS unique_users FROM {searches_sql} ds WHERE {where} GROUP BY 1, 2)"""


def spread_sql(cte: str) -> str:
    """Histogram of spreads: the events join a table of bounds (fixed values)."""
    rows = [(0, *SPREAD_BUCKETS[0])]
    rows += [(SPREAD_BUCKETS[i - 1][0], *SPREAD_BUCKETS[i]) for i in range(1, len(SPREAD_BUCKETS))]
    rows.append((SPREAD_BUCKETS[-1][0], "1e18", *SPREAD_LAST))
    bounds = ", ".join(f"({lo}, {hi}, '{label}', {order})" for lo, hi, label, order in rows)
    return cte + f""", bounds(lo, hi, time_spread, sort_order) AS (VALUES {bounds})
SELECT time_spread, sort_order, COUNT(*) AS event_count, round(AVG(client_count), 6) AS avg_clients
FROM ec JOIN bounds ON (epoch_us(latest) - epoch_us(earliest)) / 1000000.0 >= lo
                   AND (epoch_us(latest) - epoch_us(earliest)) / 1000000.0 < hi
WHERE client_count >= 2 AND (SELECT n FROM nc) >= 2 GROUP BY 1, 2"""


def overlap_sql(cte: str) -> str:
    """Shared events of every two clients."""
    return cte + """,
cnt AS (SELECT client_id, COUNT(*) AS n FROM se GROUP BY 1),
sh AS (SELECT a.client_id AS client_a, b.client_id AS client_b, COUNT(*) AS shared
       FROM se a JOIN se b ON a.username = b.username AND a.norm_query = b.norm_query
        AND a.time_bucket = b.time_bucket AND a.client_id < b.client_id GROUP BY 1, 2),
p AS (SELECT a.client_id AS client_a, b.client_id AS client_b, a.n AS count_a, b.n AS count_b,
             COALESCE(sh.shared, 0) AS shared
      FROM cnt a JOIN cnt b ON a.client_id < b.client_id
      LEFT JOIN sh ON sh.client_a = a.client_id AND sh.client_b = b.client_id)
SELECT client_a, client_b, count_a, count_b, shared,
       round(shared * 100.0 / count_a, 6) AS pct_a_in_b, round(shared * 100.0 / count_b, 6) AS pct_b_in_a,
       round(shared * 100.0 / count_a, 6) >= 95 AS a_subset, round(shared * 100.0 / count_b, 6) >= 95 AS b_subset
FROM p"""
