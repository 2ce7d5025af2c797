"""Streams over several micro-batches equal the batch jobs after draining.

The day files are picked up in file order, not day order, so the tests use a
watermark wide enough that no row counts as late (late rows are dropped by
design and left to the nightly refresh)."""

import uuid

from pyspark.sql import functions as F

from sightline import schema as S
from sightline.operators import convergence as CV, rollup as R
from sightline.sources import scans as SC
from sightline.sources import fixtures as FX, sinks as SK
from sightline.streaming import jobs as SJ

ONCE = {"availableNow": True}
WIDE = "100000 hours"


def _day_files(spark, sf_small):
    """The events table split into one folder of files per day (derived)."""
    src = SK.warehouse_root(spark) + f"/test-stream-src-{uuid.uuid4().hex[:8]}"
    ev = FX.table(spark, sf_small, "events")
    (ev.withColumn("day", F.to_date("ts")).repartition("day")
     .write.partitionBy("day").parquet(src))
    return src


def _stream(spark, src):
    schema = FX.EVENTS_SCHEMA + ", day DATE"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("basePath", src).parquet(src).drop("day"))


def test_daily_tuples_stream_many_batches(spark, sf_small):
    src = _day_files(spark, sf_small)
    base = SK.warehouse_root(spark) + f"/test-stream-{uuid.uuid4().hex[:8]}"
    q = SJ.start_daily_tuples(FX.s1_from_events(_stream(spark, src)), f"{base}/t",
                              f"{base}/_ck", ONCE, watermark=WIDE)
    SJ.drain(q)
    assert len([p for p in q.recentProgress if p.numInputRows]) > 5
    got = SJ.read_daily_tuples(spark, f"{base}/t")
    want = R.daily_search_tuples(FX.searches_s1(spark, sf_small))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_event_clients_stream_many_batches(spark, sf_small):
    src = _day_files(spark, sf_small)
    base = SK.warehouse_root(spark) + f"/test-stream-{uuid.uuid4().hex[:8]}"
    q = SJ.start_event_clients(FX.s1c_from_events(_stream(spark, src)), f"{base}/t",
                               f"{base}/_ck", 300, ONCE, watermark=WIDE)
    SJ.drain(q)
    got = (SJ.read_event_clients(spark, f"{base}/t").groupBy("client_count")
           .agg(F.count(F.lit(1)).alias("n")))
    ev = CV.search_events(FX.searches_s1c(spark, sf_small), "2000-01-01 00:00:00",
                          "2100-01-01 00:00:00", 300)
    want = CV.event_clients(ev).groupBy("client_count").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ingest_dedupes_redelivered_events(spark, sf_small):
    src = SK.warehouse_root(spark) + f"/test-stream-dup-{uuid.uuid4().hex[:8]}"
    ev = FX.table(spark, sf_small, "events")
    ev.write.parquet(f"{src}/a")
    ev.write.parquet(f"{src}/b")        # the same events delivered again
    stream = (spark.readStream.schema(FX.EVENTS_SCHEMA).option("recursiveFileLookup", "true")
              .parquet(src))
    base = SK.warehouse_root(spark) + f"/test-ingest-{uuid.uuid4().hex[:8]}"
    q = SJ.start_ingest(FX.s1_from_events(stream), "test-salt", f"{base}/log", f"{base}/_ck",
                        ONCE, dedupe_within=WIDE)
    SJ.drain(q)
    assert SC.scan_log(spark, f"{base}/log").count() == ev.count()


def test_event_clients_state_is_dropped_behind_the_watermark(spark):
    """Batches ten days apart with a 10-minute watermark: closed windows leave
    the state and the table keeps all of them."""
    import datetime as dt
    base = SK.warehouse_root(spark) + f"/test-evict-{uuid.uuid4().hex[:8]}"
    schema = "client_id string, timestamp timestamp, username string, query string"
    for k in range(6):
        rows = [(f"c{i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(days=10 * k, minutes=i), f"u{i}", "q")
                for i in range(20)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    metrics = SJ.record_metrics(spark, f"{base}/metrics")
    q = SJ.start_event_clients(stream, f"{base}/t", f"{base}/_ck", 300, ONCE)
    SJ.drain(q)
    SJ.stop_metrics(spark, metrics)
    state = [s for p in q.recentProgress for s in p.stateOperators]
    assert sum(s.numRowsRemoved for s in state) >= 80 and state[-1].numRowsTotal <= 40
    assert SJ.read_event_clients(spark, f"{base}/t").count() == 120
    rows = SJ.read_metrics(spark, f"{base}/metrics").where(F.col("query") == str(q.id))
    assert rows.agg(F.sum("input_rows")).first()[0] == 120


def test_daily_tuples_replay_after_a_crash(spark, sf_small):
    """The last batch's folder is half written and its commit lost: a restart
    replays it and the table is whole."""
    src = _day_files(spark, sf_small)
    base = SK.warehouse_root(spark) + f"/test-replay-{uuid.uuid4().hex[:8]}"
    start = lambda: SJ.start_daily_tuples(FX.s1_from_events(_stream(spark, src)), f"{base}/t",
                                          f"{base}/_ck", ONCE, watermark=WIDE)
    SJ.drain(start())
    last = max(int(d.split("=")[1]) for d in SK.list_dirs(spark, f"{base}/t"))
    SK.delete_path(spark, f"{base}/t/batch_id={last}")
    SK.delete_path(spark, f"{base}/_ck/commits/{last}")
    want = R.daily_search_tuples(FX.searches_s1(spark, sf_small))
    before = SJ.read_daily_tuples(spark, f"{base}/t")
    assert before.agg(F.sum("search_count")).first()[0] < want.agg(F.sum("search_count")).first()[0]
    SJ.drain(start())
    got = SJ.read_daily_tuples(spark, f"{base}/t")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _searches(spark, path, days):
    import datetime as dt
    schema = "client_id string, timestamp timestamp, username string, query string"
    for d in days:
        rows = [(f"c{i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(days=d, minutes=i), f"u{i}", f"q{i % 4}") for i in range(20)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_no_empty_batch_follows_the_last_rows(spark):
    """Files in the order of time: the watermark moves with the last one, and still
    the last folder is the one of its rows."""
    base = SK.warehouse_root(spark) + f"/test-last-{uuid.uuid4().hex[:8]}"
    q = SJ.start_daily_tuples(_searches(spark, f"{base}/src", [0, 1, 2]), f"{base}/t", f"{base}/_ck", ONCE)
    SJ.drain(q)
    assert len(SK.list_dirs(spark, f"{base}/t")) == 3
    assert SJ.read_daily_tuples(spark, f"{base}/t").agg(F.sum("search_count")).first()[0] == 60


def test_streamed_log_is_archived_once_and_stays_readable(spark):
    """Unfinished batches do not count, a replayed batch is not archived twice,
    and the log can be read after the deletion."""
    import datetime as dt
    from sightline.plans import jobs as J
    base = SK.warehouse_root(spark) + f"/test-log-{uuid.uuid4().hex[:8]}"
    start = lambda: SJ.start_ingest(_searches(spark, f"{base}/src", []), "salt", f"{base}/log", f"{base}/_ck", ONCE)
    _searches(spark, f"{base}/src", [0, 10, 40])
    SJ.drain(start())
    batches = SK.list_dirs(spark, f"{base}/log")
    assert len(batches) == 3 and SC.scan_log(spark, f"{base}/log").count() == 60
    # a batch that was killed before it was complete
    rows = SC.scan_log(spark, f"{base}/log")
    rows.write.option("partitionOverwriteMode", "static").partitionBy("month").parquet(f"{base}/log/batch=killed-0000000000")
    SK.delete_path(spark, f"{base}/log/batch=killed-0000000000/_SUCCESS")
    assert SC.scan_log(spark, f"{base}/log").count() == 60
    archive = lambda month: J.archive_job(spark, base, f"{base}/log", month, dt.date(2024, 3, 1), delete_after=True)
    assert [(r["month"], r["rows"]) for r in archive("2024-02")] == [("2024-01", 40)]
    assert {r.month for r in SC.scan_log(spark, f"{base}/log").select("month").distinct().collect()} == {"2024-02"}
    # the last batch's commit is lost: its files are there, the replay leaves them alone
    last = max(int(d.rsplit("-", 1)[1]) for d in batches)
    SK.delete_path(spark, f"{base}/_ck/commits/{last}")
    _searches(spark, f"{base}/src", [41])
    SJ.drain(start())
    assert archive("2024-02") == []
    assert [(r["month"], r["rows"]) for r in archive("2024-03")] == [("2024-02", 40)]
    assert SC.scan_log(spark, f"{base}/log").count() == 0
    stored = SC.scan_archive(spark, f"{base}/archive/searches")
    assert stored.count() == 80 and stored.select("timestamp", "username").distinct().count() == 80
    left = [d for d in SK.list_dirs(spark, f"{base}/log") if "killed" not in d]
    assert len(left) == 1  # only the last batch, which might be replayed


def test_another_checkpoint_writes_batches_of_its_own(spark):
    base = SK.warehouse_root(spark) + f"/test-log2-{uuid.uuid4().hex[:8]}"
    _searches(spark, f"{base}/src", [0])
    for k in range(2):
        SJ.drain(SJ.start_ingest(_searches(spark, f"{base}/src", []), "salt", f"{base}/log", f"{base}/_ck{k}", ONCE))
    assert SC.scan_log(spark, f"{base}/log").count() == 40
    assert SC.scan_log(spark, f"{base}/nothing").count() == 0


def test_stream_folds_its_batches(spark, monkeypatch):
    base = SK.warehouse_root(spark) + f"/test-fold-{uuid.uuid4().hex[:8]}"
    _searches(spark, f"{base}/src", [0, 1, 2, 3, 4, 5, 6])
    start = lambda: SJ.start_daily_tuples(_searches(spark, f"{base}/src", []), f"{base}/t", f"{base}/_ck", ONCE,
                                          watermark=WIDE, fold_every=2)
    real, calls = SK.delete_path, []

    def dies(spark, path):
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("killed")
        return real(spark, path)

    monkeypatch.setattr(SK, "delete_path", dies)  # in the middle of the second fold
    try:
        SJ.drain(start())
    except Exception:
        pass
    assert calls
    monkeypatch.setattr(SK, "delete_path", real)
    assert SJ.read_daily_tuples(spark, f"{base}/t").agg(F.sum("search_count")).first()[0] <= 140
    SJ.drain(start())
    assert SJ.read_daily_tuples(spark, f"{base}/t").agg(F.sum("search_count")).first()[0] == 140
    kinds = [d.split("=")[0] for d in SK.list_dirs(spark, f"{base}/t")]
    assert kinds.count("upto") <= 2 and kinds.count("batch_id") <= 4
