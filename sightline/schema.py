"""Declared schemas of every table the jobs read or write.

Counts are bigint everywhere (the reference uses 32-bit integers in places);
ranks are int, as produced by ``row_number``.
"""

from pyspark.sql import types as T

S, L, I, D, TS, DT, B = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                         T.TimestampType(), T.DateType(), T.BooleanType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SEARCHES = _struct(("client_id", S), ("timestamp", TS), ("username", S), ("query", S))
DAILY_TUPLES = _struct(("date", DT), ("username", S), ("query_normalized", S),
                       ("search_count", L))
DAILY_CLIENT_STATS = _struct(("client_id", S), ("date", DT), ("search_count", L),
                             ("unique_users", L))
USER_QUERY_PAIRS = _struct(("username", S), ("query_normalized", S), ("last_seen", DT))
ARCHIVE_LEDGER = _struct(("month", S), ("file_path", S), ("record_count", L),
                         ("file_size", L), ("archived_at", TS), ("deleted", B))
CUMULATIVE = _struct(("total_searches", L), ("first_search", TS), ("last_search", TS),
                     ("client_totals", T.MapType(S, L)), ("last_archive_month", S))
PERIODS = _struct(("period_type", S), ("period_id", S), ("start_date", DT), ("end_date", DT))
PERIOD_SUMMARY = _struct(("period_type", S), ("period_id", S), ("unique_queries", L),
                         ("unique_pairs", L), ("total_searches", L), ("total_users", L),
                         ("first_date", DT), ("last_date", DT))
PERIOD_TOP = _struct(("period_type", S), ("period_id", S), ("query_normalized", S),
                     ("unique_users", L), ("total_searches", L), ("rank", I))
PERIOD_LENGTH = _struct(("period_type", S), ("period_id", S), ("query_length", I),
                        ("unique_query_count", L))
QUERY_DAILY = _struct(("query_normalized", S), ("date", DT), ("search_count", L),
                      ("unique_users", L))
DETAIL_QUERIES = _struct(("rank", I), ("query", S), ("unique_users", L),
                         ("total_searches", L), ("slug", S))
WORD_INDEX = _struct(("word", S), ("rank", I))
DETAIL_DAILY = _struct(("rank", I), ("date", DT), ("search_count", L), ("unique_users", L))
DETAIL_SIMILAR = _struct(("rank", I), ("similar_rank", I), ("score", D), ("shared_users", L))
