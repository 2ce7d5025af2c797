"""Detail tables of the query pages, top-k reports and searches.

Ranks are integer keys for the per-query tables; the rank lookup is an inner
join (the ranked table is as large as the detail list, so AQE decides at run
time whether it fits a broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from .ranking import rank_within

Q = "query_normalized"


def inline_slug(cutoff, min_users: int = E.MIN_DETAIL_USERS):
    """Slug column computed in place from (unique_users, first_date): a query
    has daily rows up to the cutoff exactly when it is eligible and was first
    seen on or before the cutoff (no join with a slug table needed)."""
    ok = (F.col("unique_users") >= min_users) & (
        F.col("first_date") <= F.lit(cutoff).cast("date"))
    return F.when(ok, E.slug(Q))


def detail_queries(query_stats: DataFrame, slugs: DataFrame | None = None,
                   min_users: int = E.MIN_DETAIL_USERS,
                   blacklist: list[str] | None = None, slug_cutoff=None) -> DataFrame:
    """All-time queries with >= min_users users, blacklist out, ranked 1..n by
    users desc, searches desc, query asc; slug where the query has one (from
    a slug table, or in place with ``slug_cutoff``)."""
    q = query_stats.where(F.col("unique_users") >= min_users)
    if blacklist:
        q = q.where(~E.is_blacklisted(Q, blacklist))
    if slug_cutoff is not None:
        q = q.withColumn("slug", inline_slug(slug_cutoff, min_users))
    else:
        q = q.withColumn("slug", F.lit(None).cast("string"))
    ranked = rank_within(q.select(Q, "unique_users", "total_searches", "slug"), [],
                         [F.col("unique_users").desc(), F.col("total_searches").desc(),
                          F.col(Q).asc()])
    if slugs is not None:
        ranked = ranked.drop("slug").join(slugs.select(Q, "slug"), Q, "left")
    return ranked.select("rank", F.col(Q).alias("query"), "unique_users", "total_searches",
                         "slug")


def slug_map(query_daily: DataFrame, cutoff=None, blacklist: list[str] | None = None
             ) -> DataFrame:
    """Slug per query that has daily rows (to the cutoff), blacklist out."""
    d = query_daily
    if cutoff is not None:
        d = d.where(F.col("date") <= F.lit(cutoff).cast("date"))
    q = d.select(Q).distinct()
    if blacklist:
        q = q.where(~E.is_blacklisted(Q, blacklist))
    return q.select(Q, E.slug(Q).alias("slug"))



def word_index(detail: DataFrame) -> DataFrame:
    """Distinct (word, rank) over the words of each ranked query."""
    return (detail.select(F.explode(E.tokenize("query")).alias("word"), "rank").distinct())


def detail_daily(detail: DataFrame, query_daily: DataFrame, cutoff=None) -> DataFrame:
    d = query_daily
    if cutoff is not None:
        d = d.where(F.col("date") <= F.lit(cutoff).cast("date"))
    ranks = detail.select(F.col("query").alias(Q), "rank")
    return d.join(ranks, Q).select("rank", "date", "search_count", "unique_users")


def detail_similar(detail: DataFrame, similar: DataFrame) -> DataFrame:
    """Similarity edges keyed by ranks; an edge whose either end has no rank
    is dropped."""
    r = detail.select("query", "rank")
    rs = detail.select(F.col("query").alias("similar_query"), F.col("rank").alias("similar_rank"))
    return (similar.join(r, "query").join(rs, "similar_query")
            .select("rank", "similar_rank", "score", "shared_users"))


def query_by_slug(detail: DataFrame, slug) -> DataFrame:
    return detail.where(F.col("slug") == slug).orderBy("rank").limit(1)


def daily_by_rank(daily: DataFrame, rank) -> DataFrame:
    return daily.where(F.col("rank") == rank).orderBy("date")


def similar_detail(detail: DataFrame, similar_ranked: DataFrame, rank, limit: int = 10
                   ) -> DataFrame:
    """The best ``limit`` similar queries of one rank, with their names."""
    names = detail.select(F.col("rank").alias("similar_rank"), F.col("query").alias("similar_query"),
                          F.col("slug").alias("similar_slug"))
    return (similar_ranked.where(F.col("rank") == rank).join(names, "similar_rank")
            .orderBy(F.col("score").desc(), F.col("shared_users").desc(), F.col("similar_rank"))
            .limit(limit))


def top_chart(top: DataFrame, n: int = 25) -> DataFrame:
    """First n rows by rank and the total number of rows of the list."""
    total = top.agg(F.count(F.lit(1))).scalar()
    return top.orderBy("rank").limit(n).withColumn("total_count", total)


def table_search(ranked: DataFrame, term: str | None, limit_all: int = 100,
                 limit_match: int = 200, query_col: str = "query") -> DataFrame:
    """Case-insensitive substring search in rank order: first ``limit_match``
    matches (or first ``limit_all`` rows with no term) and the match count."""
    m = ranked
    limit = limit_all
    term = (term or "").lower().strip()
    if term:
        m = ranked.where(F.contains(F.lower(F.col(query_col)), F.lit(term)))
        limit = limit_match
    count = m.agg(F.count(F.lit(1))).scalar()
    return m.orderBy("rank").limit(limit).withColumn("match_count", count)


def search_index(query_stats: DataFrame, slugs: DataFrame | None = None,
                 blacklist: list[str] | None = None, slug_cutoff=None,
                 min_users: int = E.MIN_TOP_USERS) -> DataFrame:
    """The all-time top list (queries with >= min_users users) as (q, u, t, s)
    for the search box, users desc."""
    q = query_stats.where(F.col("unique_users") >= min_users)
    if blacklist:
        q = q.where(~E.is_blacklisted(Q, blacklist))
    if slug_cutoff is not None:
        q = q.withColumn("slug", inline_slug(slug_cutoff))
    elif slugs is not None:
        q = q.join(slugs.select(Q, "slug"), Q, "left")
    else:
        q = q.withColumn("slug", F.lit(None).cast("string"))
    return q.select(F.col(Q).alias("q"), F.col("unique_users").alias("u"),
                    F.col("total_searches").alias("t"), F.col("slug").alias("s"))


def suggest_search(index: DataFrame, term: str, n: int = 12) -> DataFrame:
    """First n index entries containing the term, by users desc."""
    return (index.where(F.contains(F.lower("q"), F.lit(term.lower())))
            .orderBy(F.col("u").desc(), F.col("t").desc(), F.col("q")).limit(n))


GRAM = 3


def _grams(text, sizes):
    """Distinct substrings of the given sizes of the lower-cased text."""
    low = F.lower(text)
    none = F.array().cast("array<string>")

    def of_size(k):
        starts = F.sequence(F.lit(1), F.char_length(low) - k + 1)
        return F.coalesce(F.when(F.char_length(low) >= k, F.transform(starts, lambda i: F.substring(low, i, F.lit(k)))), none)

    return F.array_distinct(F.concat(*(of_size(k) for k in sizes)))


def gram_postings(table: DataFrame, text_col: str, key_col: str) -> DataFrame:
    """(gram, key) for the distinct trigrams of every text. Written sorted by gram,
    a look-up reads the row groups of its own grams only."""
    return table.select(F.explode(_grams(F.col(text_col), [GRAM])).alias("gram"), F.col(key_col)).distinct()


def _candidates(postings: DataFrame, key_col: str, term: str) -> DataFrame:
    """Keys whose text holds all trigrams of the term (the term itself or not)."""
    grams = sorted({term[i:i + GRAM] for i in range(len(term) - GRAM + 1)})
    return (postings.where(F.col("gram").isin(grams)).groupBy(key_col).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") == len(grams)).select(key_col))


def table_search_indexed(ranked: DataFrame, postings: DataFrame, term: str | None, **limits) -> DataFrame:
    """``table_search`` by way of the trigram postings of (query, rank); a term of
    fewer than three characters has no trigram and searches the table."""
    low = (term or "").lower().strip()
    if len(low) >= GRAM:
        ranked = ranked.join(_candidates(postings, "rank", low), "rank", "left_semi")
    return table_search(ranked, term, **limits)


def suggestions(index: DataFrame, n: int = 12) -> DataFrame:
    """For every substring of one to three characters, the ``n`` index entries that
    ``suggest_search`` would give, with their place (from 1)."""
    best = Window.partitionBy("term").orderBy(F.col("u").desc(), F.col("t").desc(), F.col("q"))
    return (index.select(F.explode(_grams(F.col("q"), range(1, GRAM + 1))).alias("term"), "q", "u", "t", "s")
            .withColumn("place", F.row_number().over(best)).where(F.col("place") <= n))


def suggest_search_indexed(index: DataFrame, short: DataFrame, postings: DataFrame, term: str, n: int = 12
                           ) -> DataFrame:
    """``suggest_search`` from tables: a term of up to three characters is read from
    ``suggestions`` (made for at least ``n``), a longer one through the trigram postings
    of (q, q). An empty term matches every entry, as there."""
    low = term.lower()
    if not low:
        return suggest_search(index, term, n)
    if len(low) <= GRAM:
        return (short.where((F.col("term") == low) & (F.col("place") <= n)).orderBy("place")
                .select("q", "u", "t", "s"))
    return suggest_search(index.join(_candidates(postings, "q", low), "q", "left_semi"), term, n)


def recent_searches(searches: DataFrame, n: int = 10) -> DataFrame:
    return (searches.select("client_id", "timestamp", "query")
            .orderBy(F.col("timestamp").desc(), "client_id", "query").limit(n))
