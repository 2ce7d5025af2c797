"""Physical plan checks: tuples shuffled once before they are exploded, reused
tuples exchange, WindowGroupLimit for the top 20, pushed filters, no Python nodes."""

import datetime as dt

from sightline import schema as S
from sightline.operators import similarity as SM, stats as ST
from sightline.plans import catalog as C
from sightline.plans import registry
from sightline.sources import fixtures as FX, scans as SC, sinks as SK


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_reuses_pairs_exchange(spark, sf_small):
    spark.catalog.clearCache()
    df = ST.period_summary(C.s2_tuples(spark, sf_small))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # the tuples are shuffled once, before their periods; the user branch reuses that exchange
    assert "ReusedExchange" in final
    assert sum("Exchange hashpartitioning(query_normalized" in x and "username" in x and "Reused" not in x
               for x in final.splitlines()) == 1
    assert not [x for x in final.splitlines() if "Exchange hashpartitioning(_pt" in x
                and "query_normalized" in x and "username" in x]


def test_query_profile_scans_once(spark, sf_small):
    p = plan(ST.query_profile(spark.read.schema(S.DAILY_TUPLES).parquet(_tuples_folder(spark, sf_small))))
    assert p.count("FileScan parquet") == 1 and "Expand" in p


def _tuples_folder(spark, sf):
    root = SK.warehouse_root(spark) + "/test-profile-tuples"
    C.s2_tuples(spark, sf).write.mode("overwrite").parquet(root)
    return root


def test_similarity_uses_window_group_limit(spark, sf_small):
    sim = SM.query_similarity(SM.user_query_pairs(C.s2_tuples(spark, sf_small)))
    assert "WindowGroupLimit" in sim._jdf.queryExecution().optimizedPlan().toString() or \
        "WindowGroupLimit" in plan(sim)


def test_time_range_pushed_to_scan(spark, sf_small):
    s = SC.scan_time_range(FX.searches_s1(spark, sf_small), dt.datetime(2024, 1, 2),
                           dt.datetime(2024, 1, 3))
    p = plan(s)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_no_python_udf_in_registered_jobs(spark, sf_small):
    registry.load_all()
    skip = {n for n in registry.QUERIES if n.startswith("stream_") or n.endswith("_job")
            or n.startswith(("archive_", "export_", "scan_", "delete_", "replace_", "merge_"))}
    for name, fn in registry.QUERIES.items():
        if name in skip:
            continue
        p = plan(fn(spark, sf_small))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                     "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in p, (name, node)


def test_one_month_reads_one_month(spark):
    import datetime as dt

    from sightline import schema as S
    from sightline.sources import scans as SC
    from sightline.sources import sinks as SK
    root = SK.warehouse_root(spark) + "/test-month-pruning"
    SK.delete_path(spark, root)
    rows = [(dt.date(2024, m, 3), f"u{m}", "q", m) for m in range(1, 7)]
    tuples = spark.createDataFrame(rows, S.DAILY_TUPLES)
    for name, part in (("archive", "month(date) < 4"), ("live", "month(date) >= 3")):
        SK.archive_daily_tuples(tuples.where(part), None, f"{root}/{name}")
    ledger = spark.createDataFrame([(f"2024-0{m}", "", 1, 1, None, True) for m in (1, 2, 3)], S.ARCHIVE_LEDGER)
    a, b = (SC.scan_archived_tuples(spark, f"{root}/{n}/daily_tuples", with_month=True) for n in ("archive", "live"))
    every = SC.tuples_all(a, b, ledger, with_month=True)
    assert sorted(r["search_count"] for r in every.collect()) == [1, 2, 3, 4, 5, 6]
    one = SC.of_months(every, ["2024-03"])
    assert [r["search_count"] for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) >= 2 and all("PartitionFilters: [" in x and "month#" in x.split("PartitionFilters: [")[1].split("]")[0]
                                   for x in scans)
    assert SC.scan_archived_tuples(spark, f"{root}/none").count() == 0


def test_searches_read_the_grams_of_their_term(spark):
    """Indexed searches give the rows of the plain ones, and their scan is filtered by gram."""
    from sightline.operators import detail as DT
    texts = ["Small blue", "small", "malls", "sma all", "", None, "ÄÖÜ straße", "aaaa", "x", "mall small", "100% _a"]
    root = SK.warehouse_root(spark) + "/test-search"
    ranked = spark.createDataFrame([(i + 1, t, 40 - i % 3) for i, t in enumerate(texts)], "rank int, query string, u bigint")
    index = ranked.select(ranked["query"].alias("q"), "u", (ranked["rank"] * 2).cast("bigint").alias("t"),
                          ranked["query"].alias("s"))
    paths = SK.export_detail_tables(root, {
        "grams": DT.gram_postings(ranked, "query", "rank"), "entry_grams": DT.gram_postings(index, "q", "q"),
        "suggestions": DT.suggestions(index, 3)})
    grams, entry_grams, short = (spark.read.parquet(paths[n]) for n in ("grams", "entry_grams", "suggestions"))
    for term in ("small", "SMALL ", "mall", "aa", "aaa", "äöü", "straße", "% _", "none", "", "m", None):
        want = DT.table_search(ranked, term, limit_match=3).collect()
        assert DT.table_search_indexed(ranked, grams, term, limit_match=3).collect() == want, term
        if term is not None:
            want = [(r["q"], r["u"], r["t"], r["s"]) for r in DT.suggest_search(index, term, 3).collect()]
            got = DT.suggest_search_indexed(index, short, entry_grams, term, 3).collect()
            assert [(r["q"], r["u"], r["t"], r["s"]) for r in got] == want, term
    assert DT.gram_postings(ranked.where("false"), "query", "rank").count() == 0
    p = plan(DT.table_search_indexed(ranked, grams, "small"))
    assert any("FileScan parquet" in x and "PushedFilters: [" in x and "In(gram" in x for x in p.splitlines())
    assert "EqualTo(term,sm)" in plan(DT.suggest_search_indexed(index, short, entry_grams, "sm"))


def test_kinds_of_periods_are_counted_apart(spark, sf_small):
    """Weeks, months and all_time are hashed in tasks of their own (no threefold
    rows in one task), and none of their tests reaches below the shared shuffle."""
    df = ST.period_summary(C.s2_tuples(spark, sf_small))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "Generate" not in final and "Union" in final
    assert sum("FileScan parquet [l_orderkey" in x for x in final.splitlines()) == 1


def test_undated_tuples_count_for_all_time_only(spark):
    rows = [(dt.date(2024, 1, 3), "a", "x", 2), (None, "b", "x", 5)]
    got = {r.period_id: (r.total_users, r.total_searches) for r in
           ST.period_summary(spark.createDataFrame(rows, S.DAILY_TUPLES)).collect()}
    assert got == {"2024-W01": (1, 2), "2024-01": (1, 2), "all_time": (2, 7)}


def test_partition_size_is_set_unless_the_session_names_one(spark):
    from sightline.session import configure
    other = spark.newSession()
    for key in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        other.conf.unset(key)
        assert configure(other).conf.get(key) == "16m"
        other.conf.set(key, "32m")
        assert configure(other).conf.get(key) == "32m"


def test_stored_tuples_are_read_not_joined_anew(spark, sf_small):
    from sightline.plans import catalog_maintenance as CM
    _, live, tuples = CM._stored_parts(spark, sf_small)
    for df in (live, tuples):
        assert "l_orderkey" not in plan(df) and "month=" in df.inputFiles()[0]


def test_exact_counts_of_periods_do_not_multiply_rows(spark, sf_small):
    registry.load_all()
    df = registry.QUERIES["approx_periods"](spark, sf_small)
    assert "Expand" not in plan(df)
    assert df.where("not within_tolerance").isEmpty() and not df.isEmpty()


def test_upsert_computes_each_side_once(spark):
    """Period summaries are expensive: no second plan of either side for its keys."""
    from sightline.operators import maintenance as M
    rows = lambda n: spark.range(n).selectExpr("id % 7 k").groupBy("k").count()
    for merge in (M.upsert, M.insert_if_absent):
        assert plan(merge(rows(50), rows(60), ["k"])).count("Range (") == 2


def test_overview_and_upsert_join_the_log_once(spark, sf_small):
    registry.load_all()
    for name in ("upsert_period_summary", "period_overview"):
        assert "l_orderkey" not in plan(registry.QUERIES[name](spark, sf_small))
