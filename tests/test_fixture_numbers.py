"""The sizes measured independently in FIXTURES.md (sf0.001) come out of the jobs."""

from pyspark.sql import functions as F

from sightline.operators import convergence as CV, rollup as R, similarity as SM, stats as ST
from sightline.plans import catalog as C
from sightline.sources import fixtures as FX


def test_s2_numbers(spark, sf_small):
    t = C.s2_tuples(spark, sf_small)
    assert FX.searches_s2(spark, sf_small).count() == 6000
    assert t.count() == 5767
    assert SM.user_query_pairs(t).count() == 4004
    top = ST.period_top_queries(t)
    counts = {r.period_type: r["count"] for r in top.groupBy("period_type").count().collect()}
    assert counts.get("week", 0) == 0 and counts["month"] == 83 and counts["all_time"] == 62
    assert ST.eligible_queries(t).count() == 50
    assert SM.cooccurrence(SM.user_query_pairs(t)).count() == 3704


def test_s1_numbers(spark, sf_small):
    s1 = FX.searches_s1(spark, sf_small)
    assert s1.count() == 1000
    assert s1.select("username").distinct().count() == 15
    t = R.daily_search_tuples(s1)
    assert t.count() == 996
    assert SM.user_query_pairs(t).count() == 939
    assert t.select("query_normalized").distinct().count() == 440


def test_s1c_and_doc_numbers(spark, sf_small):
    start, end = FX.s1_window()
    ev = CV.search_events(FX.searches_s1c(spark, sf_small), start, end, FX.S1C_WINDOW_SECONDS)
    dist = {r.client_count: r.event_count for r in CV.event_client_distribution(ev).collect()}
    assert dist == {1: 665, 2: 119, 3: 8}
    docs = FX.documents_as_queries(spark, sf_small)
    assert docs.count() == 200
    from sightline.functions import expr as E
    assert docs.where(E.word_count("query") <= 100).count() == 29
