"""Invariants of the period statistics and the similarity graph (S2, sf0.001)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sightline.operators import ranking, similarity as SM, stats as ST
from sightline.plans import catalog as C
from sightline.sources import scans as SC


@pytest.fixture(scope="module")
def tuples(spark, sf_small):
    return C.s2_tuples(spark, sf_small).cache()


def test_sums_over_periods_equal_all_time(tuples):
    s = {(r.period_type, r.period_id): r for r in ST.period_summary(tuples).collect()}
    total = s[("all_time", "all_time")].total_searches
    for kind in ("week", "month"):
        assert sum(r.total_searches for k, r in s.items() if k[0] == kind) == total
    for r in s.values():
        assert r.unique_pairs >= r.unique_queries and r.unique_pairs >= r.total_users
        assert r.first_date <= r.last_date


def test_ranks_consecutive(tuples):
    top = ST.period_top_queries(tuples, min_users=2)
    bad = (top.groupBy("period_type", "period_id")
           .agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                F.countDistinct("rank").alias("d"))
           .where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))))
    assert bad.count() == 0
    assert top.where(F.col("unique_users") < 2).count() == 0


def test_rank_within_equals_row_number(spark, tuples):
    by_query = ST.queries_by_period(ST.period_pairs(tuples))
    order = ST.top_order()
    got = ranking.rank_within(by_query, ST.IK, order)
    w = Window.partitionBy(*ST.IK).orderBy(*order)
    want = by_query.withColumn("rank", F.row_number().over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_cooccurrence_symmetric_and_salting_exact(tuples):
    pairs = SM.user_query_pairs(tuples)
    plain = SM.cooccurrence(pairs, min_shared=1, chunk=10**9)
    salted = SM.cooccurrence(pairs, min_shared=1, chunk=2)   # every user is "heavy"
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    shuffled = SM.cooccurrence(pairs, min_shared=1, chunk=2)
    assert plain.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(plain).count() == 0
    mirrored = plain.select(F.col("similar_query").alias("query"),
                            F.col("query").alias("similar_query"), "shared_users")
    assert plain.exceptAll(mirrored).count() == 0
    assert plain.where(F.col("query") == F.col("similar_query")).count() == 0


def test_similarity_bounds(tuples):
    sim = SM.query_similarity(SM.user_query_pairs(tuples), top_n=3, min_shared=2)
    assert sim.where((F.col("score") <= 0) | (F.col("score") > 1)).count() == 0
    assert sim.groupBy("query").count().where(F.col("count") > 3).count() == 0
    assert sim.where(F.col("shared_users") < 2).count() == 0


def test_split_invariance(spark, sf_small):
    """Archived / live split at any date, with the ledger, gives the same
    statistics as no split (double counting traps)."""
    t = C.s2_tuples(spark, sf_small)
    base = ST.period_summary(t)
    for split in (dt.date(1996, 7, 1), dt.date(1999, 12, 1)):
        overlap_from = dt.date(split.year - (split.month == 1), (split.month - 2) % 12 + 1, 1)
        arch = t.where(F.col("date") < F.lit(split))
        live = t.where(F.col("date") >= F.lit(overlap_from))
        ledger = (arch.select(F.date_format("date", "yyyy-MM").alias("month")).distinct()
                  .withColumn("deleted", F.col("month") < F.lit(overlap_from.strftime("%Y-%m"))))
        got = ST.period_summary(SC.tuples_all(arch, live, ledger))
        assert got.exceptAll(base).count() == 0 and base.exceptAll(got).count() == 0


def test_approx_distinct_within_tolerance(tuples):
    worst = ST.approx_distinct(tuples).agg(F.max("rel_error")).first()[0]
    assert worst <= 0.05


def test_length_dist_empty_query_rule(spark):
    from sightline import schema as S
    rows = [(dt.date(2024, 1, 2), "u", "", 1), (dt.date(2024, 1, 2), "u", "a  b", 1)]
    t = spark.createDataFrame(rows, S.DAILY_TUPLES)
    keep = {(r.query_length, r.unique_query_count) for r in
            ST.query_length_dist(t).where(F.col("period_type") == "all_time").collect()}
    drop = {(r.query_length, r.unique_query_count) for r in
            ST.query_length_dist(t, exclude_empty=True).where(
                F.col("period_type") == "all_time").collect()}
    assert keep == {(1, 1), (3, 1)} and drop == {(3, 1)}


def test_one_very_heavy_user_is_split_and_exact(spark):
    """One user holds most pairs: blocks meet two by two, results as by hand."""
    from itertools import combinations

    rows = [("heavy", f"q{k:03d}") for k in range(120)]
    rows += [(f"u{u}", f"q{k:03d}") for u in range(6) for k in range(u, 120, 7)]
    rows += [("heavy", f"rare{k}") for k in range(50)]          # below min_shared: pruned
    pairs = spark.createDataFrame(rows, "username string, query_normalized string")
    got = {(r.query, r.similar_query): r.shared_users
           for r in SM.cooccurrence(pairs, min_shared=2, chunk=15, mirror=False).collect()}
    users = {}
    for u, q in rows:
        users.setdefault(q, set()).add(u)
    want = {(a, b): len(users[a] & users[b]) for a, b in combinations(sorted(users), 2)
            if len(users[a] & users[b]) >= 2}
    assert got == want and len(want) > 500


def test_client_range_and_has_rows(spark):
    import datetime as dt

    from sightline import schema as S
    from sightline.sources import scans as SC
    rows = [("c1", dt.datetime(2024, 1, 1, h), "u", "q") for h in range(5)] + [
        ("c2", dt.datetime(2024, 1, 1, 2), "u", "q")]
    df = spark.createDataFrame(rows, S.SEARCHES)
    got = SC.scan_client_range(df, "c1", "2024-01-01 01:00:00", "2024-01-01 03:00:00")
    assert sorted(r.timestamp.hour for r in got.collect()) == [1, 2, 3]      # both ends belong
    assert SC.has_rows(got) and not SC.has_rows(got.where("client_id = 'c2'"))
