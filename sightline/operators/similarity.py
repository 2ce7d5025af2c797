"""User-query pairs and the "users also searched" similarity graph.

cosine(a, b) = shared_users(a, b) / sqrt(users(a) * users(b)) on the binary
query x user matrix, kept when shared >= 5 and score > 0, best 20 per query.

Plan: shared counts come from a self-join of the eligible (user, query) pairs
on the user with a.query < b.query (each pair once), aggregated map-side right
after the join. A user's queries form d * (d - 1) / 2 pairs, which is the work
of the sparse product itself; to keep one heavy user from landing in one task,
each user's rows are split into ``ceil(d / chunk)`` salt buckets on the left
side and the right side is repeated per bucket, so a user with d queries is
spread over d / chunk tasks. The top 20 per query is a ``row_number`` filter,
planned as a partial (map-side) and final WindowGroupLimit, so a query with
very many candidates never sends them all to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from ..session import materialize

Q = "query_normalized"


def user_query_pairs(tuples: DataFrame, as_of=None, last_seen: str = "event_date") -> DataFrame:
    """Distinct (username, query) with last_seen: the latest event date
    (default) or the run date ``as_of`` (the reference's meaning)."""
    if last_seen == "run_date":
        return (tuples.select("username", Q).distinct()
                .withColumn("last_seen", F.lit(as_of).cast("date")))
    return tuples.groupBy("username", Q).agg(F.max("date").alias("last_seen"))


def eligible_pairs(pairs: DataFrame, eligible: DataFrame, as_of=None,
                   recent_days: int | None = E.RECENT_DAYS,
                   blacklist: list[str] | None = None) -> DataFrame:
    """Pairs of eligible queries (a key table, semi-joined), not blacklisted,
    seen within ``recent_days`` before ``as_of``."""
    p = pairs.join(eligible.select(Q).distinct(), Q, "left_semi")
    if blacklist:
        p = p.where(~E.is_blacklisted(Q, blacklist))
    if recent_days is not None and as_of is not None:
        p = p.where(F.col("last_seen") >= F.date_sub(F.lit(as_of).cast("date"), recent_days))
    return p.select("username", Q)


def cooccurrence(pairs: DataFrame, min_shared: int = E.SIMILAR_MIN_SHARED,
                 chunk: int = 2000, mirror: bool = True, distinct_input: bool = False) -> DataFrame:
    """Shared users per query pair (>= min_shared), both directions.

    A pair can share ``min_shared`` users only if each of its queries has that
    many, so rarer queries leave before the join (exact). The (user, query)
    input is read several times: it is de-duplicated and materialised once
    unless the caller did so."""
    p = pairs.select("username", Q)
    if not distinct_input:
        p = materialize(p.distinct())
    if min_shared > 1:
        often = p.groupBy(Q).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_shared)
        p = materialize(p.join(often.select(Q), Q, "left_semi"))
    # a user with d > chunk queries has blocks 0..d/chunk; every two blocks
    # meet in a group of their own, so no group holds more than 2 * chunk rows
    heavy = (p.groupBy("username").agg(F.count(F.lit(1)).alias("_d"))
             .where(F.col("_d") > chunk))
    p = p.join(heavy, "username", "left")
    blocks = F.coalesce(F.ceil(F.col("_d") / F.lit(chunk)), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64(Q), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(
        F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j")))
    rows = p.select("username", Q, mine.alias("_mine"), F.explode(meets).alias("_meet"))
    side = lambda q, m: rows.select(
        "username", F.col("_meet.i").alias("_i"), F.col("_meet.j").alias("_j"), F.col(Q).alias(q),
        F.col("_mine").alias(m))
    shared = (side("qa", "_ma").join(side("qb", "_mb"), ["username", "_i", "_j"])
              # two rows of one block meet in that block's own group only
              .where((F.col("qa") < F.col("qb")) & ((F.col("_i") == F.col("_j")) | (F.col("_ma") != F.col("_mb"))))
              .groupBy("qa", "qb").agg(F.count(F.lit(1)).alias("shared_users"))
              .where(F.col("shared_users") >= min_shared))
    out = shared.select(F.col("qa").alias("query"), F.col("qb").alias("similar_query"),
                        "shared_users")
    if mirror:
        out = out.unionByName(shared.select(F.col("qb").alias("query"),
                                            F.col("qa").alias("similar_query"), "shared_users"))
    return out


def query_similarity(pairs: DataFrame, top_n: int = E.SIMILAR_TOP_N,
                     min_shared: int = E.SIMILAR_MIN_SHARED, chunk: int = 2000) -> DataFrame:
    """Best ``top_n`` similar queries per query by cosine score."""
    p = materialize(pairs.select("username", Q).distinct())
    n = p.groupBy(Q).agg(F.count(F.lit(1)).alias("n"))
    edges = cooccurrence(p, min_shared, chunk, distinct_input=True)
    na = n.select(F.col(Q).alias("query"), F.col("n").alias("n_a"))
    nb = n.select(F.col(Q).alias("similar_query"), F.col("n").alias("n_b"))
    scored = (edges.join(na, "query").join(nb, "similar_query")
              .withColumn("score", F.col("shared_users") / F.sqrt(F.col("n_a") * F.col("n_b")))
              .where(F.col("score") > 0))
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("shared_users").desc(),
                                            F.col("similar_query").asc())
    return (scored.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top_n)
            .select("query", "similar_query", "shared_users",
                    F.round("score", 6).alias("score"), "rn"))
