"""Conflict rules, emptied periods, ledger precedence, overviews (hand-made rows)."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from sightline import schema as S
from sightline.operators import convergence as CV, maintenance as M, periods as P, stats as ST
from sightline.sources import scans as SC, sinks as SK

D = dt.date


def test_upsert_last_wins_insert_first_stays(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v long")
    assert sorted(map(tuple, M.upsert(old, new, ["k"]).collect())) == [("a", 1), ("b", 20), ("c", 30)]
    assert sorted(map(tuple, M.insert_if_absent(old, new, ["k"]).collect())) == [
        ("a", 1), ("b", 2), ("c", 30)]


def test_emptied_period_partition_is_removed(spark):
    root = SK.warehouse_root(spark) + "/test-emptied"
    SK.delete_path(spark, root)
    first = spark.createDataFrame([("week", "2024-W01", "q", 5, 5, 1), ("week", "2024-W02", "q", 6, 6, 1)],
                                  S.PERIOD_TOP)
    SK.replace_period_partitions(first, root, first.select("period_type", "period_id"))
    again = spark.createDataFrame([("week", "2024-W01", "q", 7, 7, 1)], S.PERIOD_TOP)
    recomputed = spark.createDataFrame([("week", "2024-W01"), ("week", "2024-W02")],
                                       "period_type string, period_id string")
    SK.replace_period_partitions(again, root, recomputed)
    back = SK.read_table(spark, root, S.PERIOD_TOP).collect()
    assert [(r.period_id, r.unique_users) for r in back] == [("2024-W01", 7)]


def test_month_archived_not_deleted_counted_once(spark):
    rows = [(D(2024, 1, 5), "u", "q", 1), (D(2024, 2, 5), "u", "q", 2)]
    t = spark.createDataFrame(rows, S.DAILY_TUPLES)
    ledger = spark.createDataFrame([("2024-01", True), ("2024-02", False)], "month string, deleted boolean")
    # the archive holds both months, the live table still holds February
    got = SC.tuples_all(t, t.where(F.col("date") >= F.lit(D(2024, 2, 1))), ledger)
    assert sorted(r.search_count for r in got.collect()) == [1, 2]


def test_null_member_pair_dropped_with_report(spark):
    df = spark.createDataFrame([("c", None, "u", "q"), ("c", None, None, "q"), ("c", None, "u", None)],
                               "client_id string, timestamp timestamp, username string, query string")
    obs = Observation("drop")
    kept = SC.drop_incomplete(df, obs)
    assert kept.count() == 1 and obs.get["dropped_rows"] == 2
    # struct-distinct counts the row with a null member, countDistinct(a, b) does not
    r = df.agg(F.count_distinct(F.struct("username", "query")).alias("s"),
               F.count_distinct("username", "query").alias("c")).first()
    assert (r.s, r.c) == (3, 1)


def test_no_summary_row_is_estimate(spark):
    daily = spark.createDataFrame([("c1", D(2024, 1, 2), 10, 4), ("c2", D(2024, 1, 3), 5, 3)],
                                  S.DAILY_CLIENT_STATS)
    summary = spark.createDataFrame([], S.PERIOD_SUMMARY)
    periods = P.generate_periods(daily)
    rows = {r.period_id: r for r in ST.period_overview(daily, summary, periods).collect()}
    m = rows["2024-01"]
    assert m.is_estimate and m.total_users == 7 and m.total_queries == 4 and m.total_search_pairs == 7


def test_zero_overlap_clients(spark):
    ev = spark.createDataFrame(
        [("u1", "a", 1, "c1"), ("u2", "b", 1, "c2")],
        "username string, norm_query string, time_bucket long, client_id string"
    ).withColumn("first_seen", F.current_timestamp())
    r = CV.client_overlap(ev).collect()
    assert len(r) == 1 and r[0].shared == 0 and r[0].pct_a_in_b == 0.0 and not r[0].a_subset


def test_merge_cumulative_empty_month_and_empty_table(spark):
    cur = spark.createDataFrame([], S.CUMULATIVE)
    rows = spark.createDataFrame(
        [("c1", dt.datetime(2024, 1, 2), "u", "q"), ("c2", dt.datetime(2024, 1, 9), "u", "q")],
        S.SEARCHES)
    one = M.merge_cumulative(cur, rows, "2024-01").first()
    assert one.total_searches == 2 and one.client_totals == {"c1": 1, "c2": 1}
    again = M.merge_cumulative(spark.createDataFrame([one], S.CUMULATIVE), rows.limit(0), "2024-02").first()
    assert again.total_searches == 2 and again.last_archive_month == "2024-01"


def test_versioned_table_keeps_old_version_readable(spark):
    table = SK.warehouse_root(spark) + "/test-versions"
    SK.delete_path(spark, table)
    a = spark.createDataFrame([(1,)], "x int")
    SK.write_version(a, table)
    SK.write_version(a.union(a), table)
    assert SK.read_table(spark, table).count() == 2
    # an unfinished version (no _SUCCESS) is never current
    spark.createDataFrame([(9,)], "x int").write.parquet(f"{table}/v=99")
    SK.delete_path(spark, f"{table}/v=99/_SUCCESS")
    assert SK.read_table(spark, table).count() == 2


def test_jdbc_option_mapping():
    opts = SC.jdbc_options("postgresql://user:pw@db.example:6543/research", "searches",
                           partition_column="id", lower=1, upper=1000, num_partitions=16)
    assert opts["url"] == "jdbc:postgresql://db.example:6543/research"
    assert (opts["user"], opts["password"], opts["fetchsize"]) == ("user", "pw", "500000")
    assert (opts["partitionColumn"], opts["numPartitions"]) == ("id", "16")
    assert SC.jdbc_options("postgresql://u@h/d", "t")["url"] == "jdbc:postgresql://h:5432/d"


def test_batch_table_folds_replays_and_compacts(spark):
    table = SK.warehouse_root(spark) + "/test-batches"
    SK.delete_path(spark, table)
    schema = "k string, v long"
    read = lambda: sorted(map(tuple, SK.read_batches(spark, table, schema, ["k"]).collect()))
    assert read() == []
    rows = [[("a", 1), ("b", 1)], [("a", 5), ("c", 1)], [("b", 9)]]
    for n, r in enumerate(rows):
        SK.write_batch(spark.createDataFrame(r, schema), table, n)
    assert read() == [("a", 5), ("b", 9), ("c", 1)]
    # a crash in the middle of a replay: the batch's folder is gone or incomplete
    SK.delete_path(spark, f"{table}/batch_id=2/_SUCCESS")
    assert read() == [("a", 5), ("b", 1), ("c", 1)]
    SK.write_batch(spark.createDataFrame(rows[2], schema), table, 2)
    assert read() == [("a", 5), ("b", 9), ("c", 1)]
    SK.compact_batches(spark, table, schema, ["k"])
    assert SK.list_dirs(spark, table) == ["upto=2"] and read() == [("a", 5), ("b", 9), ("c", 1)]
    SK.write_batch(spark.createDataFrame([("a", 7)], schema), table, 10)
    SK.compact_batches(spark, table, schema, ["k"])
    SK.compact_batches(spark, table, schema, ["k"])
    assert SK.list_dirs(spark, table) == ["upto=10"] and read() == [("a", 7), ("b", 9), ("c", 1)]


def test_pair_log_view_equals_upserts(spark):
    schema = "username string, query_normalized string, last_seen date"
    m1 = spark.createDataFrame([("u", "a", D(2024, 2, 1)), ("u", "b", D(2024, 2, 1))], schema)
    m2 = spark.createDataFrame([("u", "a", D(2024, 3, 1)), ("v", "a", D(2024, 3, 1))], schema)
    via_upsert = M.upsert_user_query_pairs(M.upsert_user_query_pairs(m1.limit(0), m1), m2)
    via_log = M.current_user_query_pairs(m1.unionByName(m2))
    assert sorted(map(tuple, via_upsert.collect())) == sorted(map(tuple, via_log.collect()))


def _log(spark, root, rows, mode="append"):
    from sightline.functions import expr as E
    (spark.createDataFrame(rows, S.SEARCHES).withColumn("month", E.month_key("timestamp"))
     .write.mode(mode).partitionBy("month").parquet(f"{root}/searches"))


LOG = [("c1", dt.datetime(2024, 1, 3, 10), "u1", "Pink Floyd"),
       ("c2", dt.datetime(2024, 1, 3, 11), "u2", "pink floyd "),
       ("c1", dt.datetime(2024, 1, 4, 11), None, "no user"),
       ("c1", dt.datetime(2024, 2, 9, 12), "u1", "Abba"),
       ("c1", dt.datetime(2024, 3, 1, 12), "u3", "live month")]
LATE = [("c1", dt.datetime(2024, 1, 9, 9), "u9", "late"), ("c2", dt.datetime(2024, 1, 3, 12), "u1", "pink floyd")]


def _run_archive(spark, root, delete=True):
    from sightline.plans import jobs as J
    return J.archive_job(spark, root, f"{root}/searches", "2024-03", D(2024, 3, 2), delete_after=delete)


def _everything(spark, root):
    """All rows of the product: archive plus log."""
    live = spark.read.schema(S.SEARCHES).parquet(f"{root}/searches").select(*S.SEARCHES.names)
    arch = SC.scan_archive(spark, f"{root}/archive/searches").drop("run", "month")
    return sorted((tuple(r) for r in live.unionByName(arch).collect()), key=str)


def _check_archive(spark, root, rows):
    old = [r for r in rows if r[1] < dt.datetime(2024, 3, 1)]
    assert _everything(spark, root) == sorted(rows, key=str)
    arch = SC.scan_archive(spark, f"{root}/archive/searches")
    assert arch.count() == len(old)
    led = {r.month: (r.record_count, r.deleted)
           for r in SK.read_table(spark, f"{root}/archives", S.ARCHIVE_LEDGER).collect()}
    assert led == {m: (sum(f"{r[1]:%Y-%m}" == m for r in old), True) for m in ("2024-01", "2024-02")}
    full = [r for r in old if r[2] and r[3]]
    cum = SK.read_table(spark, f"{root}/stats_cumulative", S.CUMULATIVE).first()
    assert cum.total_searches == len(full)
    assert cum.client_totals == {c: sum(r[0] == c for r in full) for c in ("c1", "c2")}
    pairs = M.current_user_query_pairs(spark.read.parquet(f"{root}/user_query_pairs"))
    assert {(r.username, r.query_normalized) for r in pairs.collect()} == {
        (r[2], r[3].strip().lower()) for r in full}
    tuples = SC.scan_archived_tuples(spark, f"{root}/archive/daily_tuples")
    assert tuples.agg(F.sum("search_count")).first()[0] == len(full)
    stats = spark.read.schema(S.DAILY_CLIENT_STATS).parquet(f"{root}/daily_client_stats")
    assert stats.agg(F.sum("search_count")).first()[0] == len(full)


def test_archive_job_keeps_null_and_late_rows(spark):
    root = SK.warehouse_root(spark) + "/test-archive-late"
    SK.delete_path(spark, root)
    _log(spark, root, LOG)
    first = _run_archive(spark, root)
    assert {r["month"]: (r["rows"], r["incomplete"]) for r in first} == {"2024-01": (3, 1), "2024-02": (1, 0)}
    assert _run_archive(spark, root) == []
    _check_archive(spark, root, LOG)
    # rows reach January after it was archived and deleted
    _log(spark, root, LATE)
    assert _everything(spark, root) == sorted(LOG + LATE, key=str)
    assert [r["month"] for r in _run_archive(spark, root)] == ["2024-01"]
    _check_archive(spark, root, LOG + LATE)


def test_archive_job_in_flight_rows_and_late_deletion(spark, monkeypatch):
    """Rows that arrive between the archive write and the deletion stay."""
    from sightline.plans import jobs as J
    root = SK.warehouse_root(spark) + "/test-archive-flight"
    SK.delete_path(spark, root)
    _log(spark, root, LOG)
    plain = J._refresh_from_archive

    def while_it_runs(*a):
        _log(spark, root, LATE)
        return plain(*a)

    monkeypatch.setattr(J, "_refresh_from_archive", while_it_runs)
    _run_archive(spark, root)
    monkeypatch.setattr(J, "_refresh_from_archive", plain)
    assert _everything(spark, root) == sorted(LOG + LATE, key=str)
    _run_archive(spark, root, delete=False)
    _run_archive(spark, root)
    _check_archive(spark, root, LOG + LATE)


def test_archive_job_survives_a_crash_at_every_step(spark, monkeypatch):
    """The job dies before its n-th write or deletion, for every n; started
    again it ends as if it had never died."""
    root = SK.warehouse_root(spark) + "/test-archive-crash"
    real = {n: getattr(SK, n) for n in ("write_version", "archive_daily_tuples", "delete_path")}
    n = 0
    while True:
        for name, f in real.items():
            monkeypatch.setattr(SK, name, f)
        SK.delete_path(spark, root)
        _log(spark, root, LOG)
        _run_archive(spark, root)
        _log(spark, root, LATE)
        left = [n]

        def dying(f):
            def call(*a, **k):
                if not left[0]:
                    raise KeyboardInterrupt
                left[0] -= 1
                return f(*a, **k)
            return call

        for name, f in real.items():
            monkeypatch.setattr(SK, name, dying(f))
        try:
            _run_archive(spark, root)
            done = True
        except KeyboardInterrupt:
            done = False
        for name, f in real.items():
            monkeypatch.setattr(SK, name, f)
        assert _everything(spark, root).__len__() >= len(LOG + LATE)      # nothing is gone
        assert set(_everything(spark, root)) == set(LOG + LATE)
        _run_archive(spark, root)
        _check_archive(spark, root, LOG + LATE)
        if done:
            break
        n += 3
    assert n > 6


def test_one_day_is_written_by_several_tasks(spark):
    root = SK.warehouse_root(spark) + "/test-one-day"
    SK.delete_path(spark, root)
    t = spark.range(40_000).select(F.lit(D(2024, 1, 1)).alias("date"), F.col("id").cast("string").alias("username"),
                                   F.lit("q").alias("query_normalized"), F.lit(1).cast("long").alias("search_count"))
    SK.archive_daily_tuples(t, "2024-01", root)
    assert len(SK.list_files(spark, f"{root}/daily_tuples/month=2024-01")) > 1


def test_writers_leave_the_session_settings(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    was = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        root = SK.warehouse_root(spark) + "/test-settings"
        SK.delete_path(spark, root)
        _log(spark, root, LOG)
        _run_archive(spark, root)
        _log(spark, root, LATE)
        _run_archive(spark, root)
        _check_archive(spark, root, LOG + LATE)
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, was)


def test_detail_tables_are_sorted_for_lookups(spark):
    root = SK.warehouse_root(spark) + "/test-detail-order"
    SK.delete_path(spark, root)
    df = spark.range(50_000).select((F.col("id") % 5000).cast("int").alias("rank"), F.lit(D(2024, 1, 1)).alias("date"),
                                    F.col("id").alias("search_count"), F.col("id").alias("unique_users"))
    path = SK.export_detail_tables(root, {"query_daily": df.repartition(8)})["query_daily"]
    per_file = (spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"))
                .orderBy("lo").collect())
    assert len(per_file) > 1 and all(x.hi <= y.lo for x, y in zip(per_file, per_file[1:]))


def test_period_stats_job_tables_equal_direct_computation(spark, sf_small):
    from sightline.plans import catalog as C, jobs as J
    t = C.s2_tuples(spark, sf_small)
    split = D(1998, 1, 1)
    arch, live = t.where(F.col("date") < F.lit(split)), t.where(F.col("date") >= F.lit(split))
    ledger = (arch.select(F.date_format("date", "yyyy-MM").alias("month")).distinct()
              .withColumn("deleted", F.lit(True)))
    tuples = SC.tuples_all(arch, live, ledger)
    root = SK.warehouse_root(spark) + "/test-period-job"
    SK.delete_path(spark, root)
    for _ in range(2):
        J.period_stats_job(spark, root, tuples, live)
    top = SK.read_table(spark, f"{root}/period_top_queries", S.PERIOD_TOP).select(
        *[f.name for f in S.PERIOD_TOP.fields])
    want_top = ST.period_top_queries(t)
    assert top.exceptAll(want_top).count() == 0 and want_top.exceptAll(top).count() == 0
    length = SK.read_table(spark, f"{root}/period_query_length_dist", S.PERIOD_LENGTH).select(
        *[f.name for f in S.PERIOD_LENGTH.fields])
    want_len = ST.query_length_dist(t)
    assert length.exceptAll(want_len).count() == 0 and want_len.exceptAll(length).count() == 0
    daily = SK.read_table(spark, f"{root}/query_daily_stats", S.QUERY_DAILY)
    want_daily = ST.query_daily_stats(t)
    assert daily.exceptAll(want_daily).count() == 0 and want_daily.exceptAll(daily).count() == 0


def _state_log(spark, root, rows):
    """Daily tuples by month, as the archive keeps them, read with their month."""
    SK.delete_path(spark, root)
    SK.archive_daily_tuples(spark.createDataFrame(rows, S.DAILY_TUPLES), None, root)
    return SC.scan_archived_tuples(spark, f"{root}/daily_tuples", with_month=True)


def _same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_new_month_reads_one_month(spark, monkeypatch):
    from sightline.plans import jobs as J
    base = SK.warehouse_root(spark) + "/test-period-state"
    SK.delete_path(spark, base)
    rows = [(D(2024, m, d), f"u{u}", q, 1) for m in (1, 2, 3) for d in (3, 20, 28) for u in range(6) for q in "ab"]
    old = _state_log(spark, base + "/log1", rows)
    J.period_stats_job(spark, base + "/nightly", old, old.limit(0).drop("month"), detail_users=2)
    more = rows + [(D(2024, 4, d), f"u{u}", q, 2) for d in (10, 12) for u in range(7) for q in "bc"]
    new = _state_log(spark, base + "/log2", more)
    asked = []
    real = SC.of_months
    monkeypatch.setattr(SC, "of_months", lambda t, months: asked.append(sorted(months)) or real(t, months))
    live = new.where("month = '2024-04'").drop("month")
    J.period_stats_job(spark, base + "/nightly", new, live, detail_users=2)
    assert [m for m in asked if m] == [["2024-04"]]
    every = spark.createDataFrame(more, S.DAILY_TUPLES)
    assert _same(ST.period_summary(every), SK.read_table(spark, base + "/nightly/period_summary_stats"))
    assert _same(ST.period_top_queries(every), SK.read_table(spark, base + "/nightly/period_top_queries", S.PERIOD_TOP))
    assert _same(ST.query_daily_stats(every, 2), SK.read_table(spark, base + "/nightly/query_daily_stats"))


def test_late_month_is_computed_anew(spark):
    from sightline.plans import jobs as J
    base = SK.warehouse_root(spark) + "/test-period-late"
    SK.delete_path(spark, base)
    rows = [(D(2024, m, 15), f"u{u}", "a", 1) for m in (1, 2, 3) for u in range(6)]
    live = spark.createDataFrame(rows, S.DAILY_TUPLES).where("month(date) = 3")
    J.period_stats_job(spark, base, spark.createDataFrame(rows, S.DAILY_TUPLES), live)
    rows += [(D(2024, 1, 31), "late", "a", 5), (D(2023, 12, 30), "early", "b", 5)]
    late = spark.createDataFrame(rows, S.DAILY_TUPLES)
    J.period_stats_job(spark, base, late, live, rebuild_daily=True, late_months=["2024-01", "2023-12"])
    assert _same(ST.period_summary(late), SK.read_table(spark, base + "/period_summary_stats"))
    assert _same(ST.period_top_queries(late), SK.read_table(spark, base + "/period_top_queries", S.PERIOD_TOP))


def test_period_job_of_nothing(spark):
    from sightline.plans import jobs as J
    base = SK.warehouse_root(spark) + "/test-period-none"
    SK.delete_path(spark, base)
    none = spark.createDataFrame([], S.DAILY_TUPLES)
    J.period_stats_job(spark, base, none, none)
    assert SK.read_table(spark, base + "/period_summary_stats").count() == 0


def test_reader_of_a_period_table_sees_whole_versions(spark, monkeypatch):
    root = SK.warehouse_root(spark) + "/test-period-versions"
    SK.delete_path(spark, root)
    row = lambda week, n: ("week", week, "q", n, n, 1)
    first = spark.createDataFrame([row("2024-W01", 5), row("2024-W02", 6)], S.PERIOD_TOP)
    keys = first.select("period_type", "period_id")
    SK.replace_period_partitions(first, root, keys)
    before = SK.read_table(spark, root, S.PERIOD_TOP)
    # a write killed before it is complete
    SK.write_version(first.limit(1), root, ["period_type", "period_id"])
    SK.delete_path(spark, f"{root}/v=2/_SUCCESS")
    assert SK.read_table(spark, root, S.PERIOD_TOP).count() == 2
    SK.replace_period_partitions(spark.createDataFrame([row("2024-W02", 9)], S.PERIOD_TOP), root, keys.limit(0))
    assert sorted(r.unique_users for r in before.collect()) == [5, 6]
    assert sorted(r.unique_users for r in SK.read_table(spark, root, S.PERIOD_TOP).collect()) == [5, 9]


def test_query_profile_counts(spark):
    t = spark.createDataFrame([(D(2024, 1, 1), "u", "q", 1), (D(2024, 1, 1), "v", "q", 2), (D(2024, 1, 3), "u", "q", 4),
                               (D(2024, 1, 3), None, "q", 1), (D(2024, 1, 3), "u", None, 4)], S.DAILY_TUPLES)
    got = ST.query_profile(t)
    assert [tuple(r) for r in got.collect()] == [("q", 3, 8, D(2024, 1, 1), D(2024, 1, 3), 2)]


def test_cluster_conf_sizes_partitions():
    from sightline.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(10 * 1024 ** 2, 64)["spark.sql.shuffle.partitions"]) == 192


def test_scan_searches_drops_and_reports_incomplete_rows(spark):
    path = SK.warehouse_root(spark) + "/test-scan-nulls"
    SK.delete_path(spark, path)
    spark.createDataFrame([("c", dt.datetime(2024, 1, 1), "u", "q"),
                           ("c", dt.datetime(2024, 1, 1), None, "q"),
                           ("c", dt.datetime(2024, 1, 1), "u", None)], S.SEARCHES).write.parquet(path)
    obs = Observation("scan")
    df = SC.scan_searches(spark, path, obs)
    assert df.count() == 1 and obs.get["dropped_rows"] == 2


def test_available_period_labels_and_bounds(spark):
    summary = spark.createDataFrame(
        [("week", "2026-W03", 1, 1, 1, 1, None, None), ("month", "2026-01", 1, 1, 1, 1, None, None),
         ("week", "2020-W53", 1, 1, 1, 1, None, None), ("week", "2027-W01", 1, 1, 1, 1, None, None),
         ("all_time", "all_time", 1, 1, 1, 1, None, None)], S.PERIOD_SUMMARY)
    rows = {r.period_id: r for r in P.available_periods(summary, "2026-12-31 23:59:59").collect()}
    assert set(rows) == {"2026-W03", "2026-01", "2020-W53"}      # 2027-W01 starts after max
    w = rows["2026-W03"]
    assert (w.label, w.start_date, w.end_date) == ("03/2026", D(2026, 1, 12), D(2026, 1, 18))
    assert w.end_ts == dt.datetime(2026, 1, 18, 23, 59, 59)
    m = rows["2026-01"]
    assert (m.label, m.start_date, m.end_date) == ("January 2026", D(2026, 1, 1), D(2026, 1, 31))
    assert rows["2020-W53"].start_date == D(2020, 12, 28)
    assert dt.date.fromisocalendar(2020, 53, 1) == D(2020, 12, 28)


def test_months_to_archive_null_ledger_month(spark):
    searches = spark.createDataFrame(
        [("c", dt.datetime(2024, m, 5), "u", "q") for m in (1, 2, 3, 4)], S.SEARCHES)
    ledger = spark.createDataFrame([("2024-01", None, 1, 1, None, True),
                                    (None, None, 1, 1, None, True),
                                    ("2024-02", None, 1, 1, None, False)], S.ARCHIVE_LEDGER)
    got = [r.month for r in M.months_to_archive(searches, ledger, "2024-04").collect()]
    assert got == ["2024-02", "2024-03"]     # NOT IN with a null would return nothing


def test_stale_periods_without_live_data_keeps_all(spark):
    t = spark.createDataFrame([(D(2024, 1, 2), "u", "q", 1), (D(2024, 3, 2), "u", "q", 1)],
                              S.DAILY_TUPLES)
    periods = P.generate_periods(t)
    existing = ST.period_summary(t)
    none_live = t.limit(0)
    assert P.stale_periods(periods, existing, none_live).count() == periods.count()
    live = t.where(F.col("date") >= F.lit(D(2024, 3, 1)))
    kept = {(r.period_type, r.period_id) for r in P.stale_periods(periods, existing, live).collect()}
    assert ("month", "2024-01") not in kept and ("month", "2024-02") in kept   # Feb has no summary
    assert ("all_time", "all_time") in kept and ("month", "2024-03") in kept


def test_merges_keep_null_keys_and_repeats(spark):
    """A null key meets nothing; repeated rows of a key stay or go together."""
    old = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("a", "x", 3), ("b", "y", 4)], "k string, j string, v long")
    new = spark.createDataFrame([("a", None, 5), ("a", "x", 6), ("c", "z", 7), ("c", "z", 8)], "k string, j string, v long")
    values = lambda df: sorted(r.v for r in df.collect())
    assert values(M.upsert(old, new, ["k", "j"])) == [1, 4, 5, 6, 7, 8]
    assert values(M.insert_if_absent(old, new, ["k", "j"])) == [1, 2, 3, 4, 5, 7, 8]


def test_archive_writes_few_files_a_month(spark):
    """Files follow the months, not the tasks."""
    root = SK.warehouse_root(spark) + "/test-archive-files"
    SK.delete_path(spark, root)
    rows = [(f"c{i % 3}", dt.datetime(2024, 1 + i % 2, 1 + i % 28, i % 24), f"u{i % 50}", f"q {i % 70}") for i in range(600)]
    _log(spark, root, rows)
    _run_archive(spark, root)
    for table in ("user_query_pairs/run=1", "archive/searches/run=1", "archive/daily_tuples", "daily_client_stats"):
        months = [d for d in SK.list_dirs(spark, f"{root}/{table}") if d.startswith("month=")]
        assert len(months) == 2
        assert all(len(SK.list_files(spark, f"{root}/{table}/{m}")) == 1 for m in months), table
    pairs = M.current_user_query_pairs(spark.read.parquet(f"{root}/user_query_pairs"))
    assert pairs.count() == len({(r[2], r[3]) for r in rows})
