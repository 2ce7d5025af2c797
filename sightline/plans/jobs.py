"""Composed jobs over the warehouse tables (the nightly work of the product).

* ``period_stats_job``  tuples -> periods -> skip finished -> summary, top
                        list, length distribution (one shared ``pairs``) ->
                        per-query daily series
* ``publish_job``       eligible pairs -> similarity -> detail tables, search
                        index, per-period overviews
* ``archive_job``       raw files -> archive, tuples archive, daily client
                        stats, ledger; optionally pairs, cumulative totals,
                        and the deletion of the files archived
* ``convergence_job``   all convergence reports over one scan

Every table is written as a new version (or with dynamic partition overwrite
for the period tables), so running a job twice leaves the same tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E
from ..operators import convergence as CV
from ..operators import detail as DT
from ..operators import maintenance as M
from ..operators import periods as P
from ..operators import rollup as R
from ..operators import similarity as SM
from ..operators import stats as ST
from ..sources import scans as SC
from ..sources import sinks as SK


def _t(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def period_stats_job(spark: SparkSession, root: str, tuples: DataFrame, live: DataFrame,
                     min_users: int = E.MIN_TOP_USERS, detail_users: int = E.MIN_DETAIL_USERS,
                     daily_only: bool = False, rebuild_daily: bool = False,
                     late_months: list[str] | tuple = ()) -> dict[str, str]:
    """Refresh period summary / top / length tables and the per-query daily
    series from ``tuples`` (= ``tuples_all``; with its ``month`` column, months
    that are not touched are not read).

    State: ``pairs_by_month``, the (month, query, user) pairs. Months of stale
    periods are computed anew, others stand; month and all_time statistics come
    from it, weeks from the tuples of their months. ``late_months`` are months
    whose archived tuples have changed since: they count as stale.

    The series is refreshed in place: rows from the first live date on are
    computed anew, and queries that have become eligible get their whole
    history. ``rebuild_daily`` computes all of it (after late rows reached the
    archive)."""
    out = {}
    existing = SK.read_table(spark, _t(root, "period_summary_stats"), S.PERIOD_SUMMARY)
    todo = _periods_to_do(tuples, existing, live, late_months)
    months = _months_of(todo, _state_months(spark, root))
    run = uuid.uuid4().hex[:12]
    snap, folded = (_t(root, f"_snapshot/{name}-{run}") for name in ("tuples", "by-query"))
    touched = SK.snapshot(_in_months(tuples, months).select(*S.DAILY_TUPLES.names), snap)
    try:
        state = _refresh_state(spark, root, touched, months)
        keys = spark.createDataFrame([(r.period_type, r.period_id) for r in todo],
                                     "period_type STRING, period_id STRING")
        whole = [r.period_id for r in todo if r.period_type == "month"]
        # periods to compute: one row per week, a bounded broadcast
        todo_keys = F.broadcast(keys.select(*ST.period_internal()))
        pairs = ST.pairs_from_state(state, [] if daily_only else whole)
        if not daily_only:
            weeks = ST.period_pairs(touched, ("week",)).join(todo_keys, ST.IK, "left_semi")
            pairs = weeks.unionByName(pairs)
        # pairs are folded as they come and never kept; users come from the snapshot and the state
        by_query = SK.snapshot(ST.queries_by_period(pairs), folded)
        if not daily_only:
            users = ST.assign_periods(touched.select("date", "username"), ("week",)).join(
                todo_keys, ST.IK, "left_semi").select(*ST.IK, "username")
            users = ST.users_by_period(users.unionByName(ST.users_from_state(state, whole)))
            _period_tables(spark, root, existing, keys, users, by_query, min_users, out)
        eligible = by_query.where((F.col("_pt") == ST.PERIOD_CODES["all_time"])
                                  & (F.col("unique_users") >= detail_users)).select("query_normalized")
        out["query_daily_stats"] = SK.write_version(
            _daily_series(spark, root, tuples, touched, live, eligible, rebuild_daily),
            _t(root, "query_daily_stats"))
    finally:
        SK.delete_path(spark, snap)
        SK.delete_path(spark, folded)
    return out


def _periods_to_do(tuples, existing, live, late) -> list:
    """Stale periods, one row each (a bounded list: weeks and months of the
    history). Dates up to the last summary are known from it, so only tuples from
    then on, and of late months, are looked at. A period inside the span of the
    last summary, over before the first live date and without a row, was empty
    then and stays so unless a late month touches it."""
    known = existing.where("period_type = 'all_time' and first_date is not null")
    first, last = known.agg(F.min("first_date"), F.max("last_date")).first()
    dates = tuples.select("date")
    if last is not None:
        recent = F.col("date") >= F.lit(last.replace(day=1))
        if "month" in tuples.columns:
            recent = F.col("month") >= f"{last:%Y-%m}"
        dates = (tuples.where(recent).select("date")
                 .unionByName(_in_months(tuples, list(late)).select("date"))
                 .unionByName(known.select(F.explode(F.array("first_date", "last_date")).alias("date"))))
    is_late = F.lit(False)
    for start, end in map(SC.month_range, late):
        is_late |= (F.col("start_date") < F.lit(end.date())) & (F.col("end_date") >= F.lit(start.date()))
    periods = P.generate_periods(dates)
    stale = P.stale_periods(periods, existing, live)
    if last is not None:
        live_from = P.min_live_date(live).first()[0]
        if live_from is not None:
            stale = stale.where(~((F.col("period_type") != "all_time") & (F.col("start_date") >= F.lit(first))
                                  & (F.col("end_date") <= F.lit(last)) & (F.col("end_date") < F.lit(live_from))))
    return stale.unionByName(periods.where(is_late)).distinct().collect()


def _state_months(spark, root) -> set[str]:
    return {d[6:] for d in SK.list_dirs(spark, _t(root, "pairs_by_month")) if d.startswith("month=")}


def _months_of(periods: list, held: set[str]) -> list[str]:
    """Months that stale weeks and months touch, and months without state."""
    months, every = set(), set()
    for r in periods:
        day, mine = r.start_date.replace(day=1), every if r.period_type == "all_time" else months
        while day <= r.end_date:
            mine.add(f"{day:%Y-%m}")
            day = SC.month_range(f"{day:%Y-%m}")[1].date()
    return sorted(months | (every - held))


def _in_months(tuples: DataFrame, months: list[str]) -> DataFrame:
    if "month" in tuples.columns:
        return SC.of_months(tuples, months)
    if not months:
        return tuples.where(F.lit(False))
    span = F.col("date").between(F.lit(SC.month_range(min(months))[0].date()),
                                 F.last_day(F.lit(SC.month_range(max(months))[0].date())))
    return tuples.where(span & E.month_key("date").isin(months))


STATE = ("query_normalized STRING, username STRING, searches BIGINT, first_date DATE, last_date DATE, "
         "month STRING")


def _refresh_state(spark, root, touched, months) -> DataFrame:
    """Month pairs of the months named computed anew. Only this job reads the
    state; a run killed here leaves its periods stale, so the next one redoes them."""
    path = _t(root, "pairs_by_month")
    (ST.month_pairs(touched).repartitionByRange("month", "query_normalized", "username")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
    full = {r[0] for r in touched.select(E.month_key("date")).distinct().collect()}
    for m in months:
        if m not in full:
            SK.delete_path(spark, f"{path}/month={m}")
    return spark.read.schema(STATE).parquet(path)


def _daily_series(spark, root, tuples, touched, live, eligible, rebuild) -> DataFrame:
    old = SK.read_table(spark, _t(root, "query_daily_stats"), S.QUERY_DAILY)
    since = P.min_live_date(live).first()[0]
    if rebuild or since is None or old.isEmpty():
        return ST.query_daily_from(tuples, eligible)
    recent = F.col("date") >= F.lit(since).cast("date")
    fresh = ST.query_daily_from(touched.where(recent), eligible)
    need = eligible.join(old.select("query_normalized").distinct(), "query_normalized", "left_anti")
    backfill = fresh.limit(0) if need.isEmpty() else ST.query_daily_from(tuples.where(~recent), need)
    return M.refresh_query_daily(old, fresh.unionByName(backfill), old, backfill, since)


def _period_tables(spark, root, existing, keys, users, by_query, min_users, out) -> None:
    for name, df, order in (
            ("period_top_queries", ST.top_from(by_query, min_users), "rank"),
            ("period_query_length_dist", ST.length_from(by_query), "query_length")):
        out[name] = SK.replace_period_partitions(df, _t(root, name), keys, order)
    # last: a period counts as done by its summary
    summary = ST.period_summary_from(users, by_query)
    out["period_summary_stats"] = SK.write_version(
        M.upsert_period_summary(existing, summary), _t(root, "period_summary_stats"))


def publish_job(spark: SparkSession, root: str, tuples: DataFrame, pairs: DataFrame,
                daily_stats: DataFrame, as_of, blacklist: list[str] | None = None,
                recent_days: int | None = E.RECENT_DAYS) -> dict[str, str]:
    """Similarity graph, detail tables, query lists, search index, client
    totals and overviews. The pairs table is cleaned of blacklisted queries
    first (its latest pair per user and query, written as a new version)."""
    import datetime as dt
    cutoff = (dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=1))
    qd = SK.read_table(spark, _t(root, "query_daily_stats"), S.QUERY_DAILY)
    eligible = qd.select("query_normalized").distinct()
    if blacklist:
        eligible = eligible.where(~E.is_blacklisted("query_normalized", blacklist))
    pairs = M.blacklist_delete_pairs(M.current_user_query_pairs(pairs), blacklist or [])
    pairs_path = SK.write_version(pairs, _t(root, "current_user_query_pairs"))
    pairs = spark.read.schema(pairs.schema).parquet(pairs_path)
    sim = SM.query_similarity(SM.eligible_pairs(pairs, eligible, as_of, recent_days, blacklist))
    stats = ST.all_time_query_stats(tuples)
    slugs = DT.slug_map(qd, cutoff, blacklist)
    detail = DT.detail_queries(stats, slugs, blacklist=blacklist)
    pub = _t(root, "publish")
    out = SK.export_detail_tables(pub, {
        "queries": detail, "word_index": DT.word_index(detail),
        "query_daily": DT.detail_daily(detail, qd, cutoff),
        "query_similar": DT.detail_similar(detail, sim),
        "grams": DT.gram_postings(detail, "query", "rank")})
    out["search_index"] = SK.export_search_index(DT.search_index(stats, slugs, blacklist),
                                                 f"{pub}/search_index")
    summary = SK.read_table(spark, _t(root, "period_summary_stats"), S.PERIOD_SUMMARY)
    out["cumulative_overview"] = SK.write_version(ST.cumulative_overview(summary, as_of),
                                                  f"{pub}/cumulative_overview")
    out["period_overview"] = SK.write_version(
        ST.period_overview(daily_stats, summary, P.generate_periods(tuples), cutoff),
        f"{pub}/period_overview")
    top = SK.read_table(spark, _t(root, "period_top_queries"), S.PERIOD_TOP)
    out["query_lists"] = SK.export_period_lists(top, slugs, blacklist or [], f"{pub}/query_lists")
    out["current_user_query_pairs"] = pairs_path
    out["client_totals"] = SK.write_version(ST.client_totals(daily_stats), f"{pub}/client_totals")
    out["period_client_totals"] = SK.write_version(ST.period_client_totals(daily_stats),
                                                   f"{pub}/period_client_totals")
    return out


ARCHIVED_FILES = "month STRING, file STRING, bytes BIGINT, run BIGINT, deleted BOOLEAN"


def archive_job(spark: SparkSession, root: str, searches_path: str, current_month: str,
                as_of, delete_after: bool = False) -> list[dict]:
    """Archive the finished months of the raw log, all of them in one pass.

    ``searches_path`` is the raw log as the ingest stream leaves it (``batch=``
    folders with months inside) or partitioned by ``month``. Only committed files
    count: what a killed batch left behind is not there yet, and nothing keeps a
    list of files that a deletion would make wrong. The unit of work is the *file*: ``archived_files``
    lists every raw file whose rows are in the archive, and only files on that
    list are ever deleted. So a row that reaches a month late, even a month
    archived and deleted long ago, or while this job runs, is in a file of its
    own: it stays in the log until a later run adds it to the archive.

    A run: list the raw files that are not archived yet; write their rows,
    *all* of them, as archive run ``n`` (``archive/searches/run=<n>/month=``);
    check the number of rows; note the files; recompute the derived tables of
    the months touched from the archive; then delete noted files and mark
    them. Every step either overwrites what belongs to run ``n`` alone or
    recomputes from the archive, so a run that died anywhere is started again:
    before the files are noted its run number is used again, afterwards only
    the derived tables and the deletion are left.

    Rows without a username or query are archived like all others and counted
    in the report; the statistics leave them out.
    """
    raw = _t(root, "archive/searches")
    files_path = _t(root, "archived_files")
    noted = SK.read_table(spark, files_path, ARCHIVED_FILES)
    # names of files that are archived but still there (as many as Spark lists)
    done = {r.file for r in noted.where(~F.col("deleted")).select("file").toLocalIterator()}
    run = (noted.agg(F.max("run")).first()[0] or 0) + 1
    new = sorted(x for x in SK.committed_files(spark, searches_path) if x[0] < current_month and x[1] not in done)
    if new:
        rows = SC.read_log_files(spark, searches_path, [f for _, f, _ in new])
        seen = Observation(f"archive_run_{run}")
        out = f"{raw}/run={run}"
        (SK.by_month(rows).sortWithinPartitions("month", "timestamp")
         .observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").partitionBy("month").option("compression", "snappy").parquet(out))
        held = spark.read.schema(S.SEARCHES).parquet(out).count()
        if held != seen.get["rows"]:
            raise RuntimeError(f"archive run {run} holds {held} rows, expected {seen.get['rows']}")
        entries = spark.createDataFrame([(m, f, n, run, False) for m, f, n in new], ARCHIVED_FILES)
        SK.write_version(noted.unionByName(entries), files_path)
        noted = SK.read_table(spark, files_path, ARCHIVED_FILES)
    else:
        run -= 1
    if not run:
        return []
    archived = SC.scan_archive(spark, raw).where(F.col("run") <= run)
    report = _refresh_from_archive(spark, root, raw, archived, noted)
    if delete_after:
        _delete_archived(spark, root, archived, noted, as_of)
        SK.drop_empty_batches(spark, searches_path)
    return [{**r, "deleted": delete_after} for r in report]


def _refresh_from_archive(spark, root, raw, archived, noted) -> list[dict]:
    """Daily tables and ledger of the months whose number of archived rows is
    not the ledger's. The ledger is written last: until then a month counts
    as changed. A month once marked deleted stays so (it is read from the
    archive, which has the late rows too)."""
    ledger_path = _t(root, "archives")
    ledger = SK.read_table(spark, ledger_path, S.ARCHIVE_LEDGER)
    sizes = noted.groupBy("month").agg(F.sum("bytes").alias("file_size"))
    before = ledger.select("month", F.col("record_count").alias("_before"), F.col("deleted").alias("_deleted"))
    # rows alone are counted from the files' footers; columns are read for touched months only
    counts = (archived.groupBy("month").agg(F.count(F.lit(1)).alias("record_count"))
              .join(sizes, "month").join(before, "month", "left")
              .where(~F.col("record_count").eqNullSafe(F.col("_before"))).orderBy("month"))
    touched = counts.collect()  # at most one row per month of history
    if not touched:
        return []
    mine = archived.where(F.col("month").isin([r.month for r in touched]))
    bad = mine.where(F.col("username").isNull() | F.col("query").isNull())
    incomplete = dict(bad.groupBy("month").count().collect())  # at most one row per month
    rows = SC.drop_incomplete(mine)
    SK.archive_daily_tuples(R.daily_search_tuples(rows), None, _t(root, "archive"))
    stats = R.daily_client_stats(rows).withColumn("month", E.month_key("date"))
    _overwrite_months(stats, _t(root, "daily_client_stats"))
    entries = spark.createDataFrame(
        [(r.month, f"{raw}/run=*/month={r.month}", r.record_count, r.file_size, None, bool(r._deleted))
         for r in touched], S.ARCHIVE_LEDGER)
    SK.write_version(M.upsert(ledger, entries, ["month"]), ledger_path)
    return [{"month": r.month, "rows": r.record_count, "incomplete": incomplete.get(r.month, 0), "bytes": r.file_size}
            for r in touched]


def _delete_archived(spark, root, archived, noted, as_of) -> None:
    """User-query pairs and totals of what is to go, then the ledger's mark,
    then the files: exactly those noted as archived."""
    pending = noted.where(~F.col("deleted"))
    parts = pending.select("run", "month").distinct().collect()  # runs x months that still have files
    if not parts:
        return
    runs, months = sorted({r.run for r in parts}), sorted({r.month for r in parts})
    rows = SC.drop_incomplete(archived)
    # by (run, month): a step that is repeated replaces its own rows only
    pairs = (rows.where(F.col("run").isin(runs))
             .select("username", E.normalize_query("query").alias("query_normalized"), "run", "month").distinct()
             .withColumn("last_seen", F.lit(as_of).cast("date")))
    (SK.by_month(pairs.select("username", "query_normalized", "last_seen", "run", "month"), "run")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "month").parquet(_t(root, "user_query_pairs")))
    totals = (rows.where(F.col("month").isin(months)).groupBy("month", "client_id")
              .agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_search"),
                   F.max("timestamp").alias("last_search")))
    _overwrite_months(totals, _t(root, "month_totals"))
    SK.write_version(M.cumulative_from_month_totals(spark.read.parquet(_t(root, "month_totals"))),
                     _t(root, "stats_cumulative"))
    ledger = SK.read_table(spark, _t(root, "archives"), S.ARCHIVE_LEDGER)
    mark = F.col("deleted") | F.col("month").isin(months)
    SK.write_version(ledger.withColumn("deleted", mark), _t(root, "archives"))
    for r in pending.select("file").toLocalIterator():
        SK.delete_path(spark, r.file)
    SK.write_version(noted.withColumn("deleted", F.lit(True)), _t(root, "archived_files"))


def _overwrite_months(df: DataFrame, path: str) -> None:
    (SK.by_month(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(path))


def convergence_job(searches: DataFrame, start, end, window_seconds: int = 300
                    ) -> dict[str, DataFrame]:
    return CV.convergence_report(searches, start, end, window_seconds)
