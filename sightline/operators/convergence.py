"""Cross-client convergence of search events.

An *event* is (username, normalised query, time bucket). ``search_events``
keeps one row per (event, client) with the first time that client saw it; all
reports derive from it or from ``event_clients`` (one row per event). A row of
either holds at most one entry per client, so per-event arrays are bounded by
the number of collecting clients. With fewer than 2 clients in the range,
every report is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from ..session import materialize
from ..sources.scans import scan_time_range

EVENT = ["username", "norm_query", "time_bucket"]


def search_events(searches: DataFrame, start, end, window_seconds: int = 300) -> DataFrame:
    """(event, client) -> first_seen over start <= timestamp <= end."""
    s = scan_time_range(searches, start, end)
    return (s.groupBy(F.col("username"), E.normalize_query("query").alias("norm_query"),
                      E.time_bucket("timestamp", window_seconds).alias("time_bucket"),
                      F.col("client_id"))
            .agg(F.min("timestamp").alias("first_seen")))


def n_clients(events: DataFrame) -> Column:
    """Number of distinct clients in the range, as a scalar subquery."""
    return events.select("client_id").distinct().agg(F.count(F.lit(1))).scalar()


def _enough_clients(df: DataFrame, events: DataFrame) -> DataFrame:
    return df.where(n_clients(events) >= 2)


def event_clients(events: DataFrame, with_order: bool = False) -> DataFrame:
    """One row per event: number of clients, first and last sighting (and the
    clients ordered by first sighting when asked)."""
    aggs = [F.count(F.lit(1)).alias("client_count"), F.min("first_seen").alias("earliest"),
            F.max("first_seen").alias("latest")]
    if with_order:
        aggs.append(F.array_sort(F.collect_list(F.struct("first_seen", "client_id")))
                    .alias("_seen"))
    return events.groupBy(*EVENT).agg(*aggs)


def event_client_distribution(events: DataFrame) -> DataFrame:
    """Events by number of clients that saw them, with the share in percent
    (the grand total is a window over a table of at most #clients rows)."""
    h = (event_clients(events).groupBy("client_count")
         .agg(F.count(F.lit(1)).alias("event_count")))
    total = F.sum("event_count").over(Window.partitionBy())
    out = h.select("client_count", "event_count",
                   F.round(E.safe_ratio(F.col("event_count") * 100, total), 6).alias("pct"))
    return _enough_clients(out, events)


def full_convergence(events: DataFrame) -> DataFrame:
    """Events seen on all clients, out of all events, and the rate in percent."""
    n = n_clients(events)
    ec = event_clients(events)
    out = ec.agg(F.sum(F.when(F.col("client_count") == n, 1).otherwise(0)).cast("bigint")
                 .alias("full_events"), F.count(F.lit(1)).alias("total_events"))
    out = out.select(n.alias("n_clients"), "full_events", "total_events",
                     F.round(E.safe_ratio(F.col("full_events") * 100, F.col("total_events")), 6)
                     .alias("rate"))
    return out.where(F.col("n_clients") >= 2)


def spread_histogram(events: DataFrame) -> DataFrame:
    """Events seen on >= 2 clients by time from first to last sighting."""
    ec = event_clients(events).where(F.col("client_count") >= 2)
    spread = E.seconds_between("earliest", "latest")
    out = (ec.select(E.spread_label(spread).alias("time_spread"),
                     E.spread_order(spread).alias("sort_order"), "client_count")
           .groupBy("time_spread", "sort_order")
           .agg(F.count(F.lit(1)).alias("event_count"),
                F.round(F.avg("client_count"), 6).alias("avg_clients")))
    return _enough_clients(out, events)


def events_per_client(events: DataFrame) -> DataFrame:
    out = events.groupBy("client_id").agg(F.count(F.lit(1)).alias("unique_events"))
    return _enough_clients(out, events)


def _pairs_of(arr: str) -> Column:
    """All (a, b) with a before b in a sorted array column, as structs."""
    return F.expr(
        f"flatten(transform({arr}, (a, i) -> transform(slice({arr}, i + 2, size({arr})), "
        f"b -> named_struct('client_a', a, 'client_b', b))))")


def client_overlap(events: DataFrame) -> DataFrame:
    """Per client pair a < b: events of each, shared events, coverage both ways.

    Shared events are counted per event from its (bounded) client set, so no
    join on the event key is needed; pairs without any shared event come from
    the per-client table (one row per client) and get shared = 0.
    """
    shared = (events.groupBy(*EVENT).agg(F.array_sort(F.collect_set("client_id")).alias("cs"))
              .where(F.size("cs") >= 2)
              .select(F.inline(_pairs_of("cs")))
              .groupBy("client_a", "client_b").agg(F.count(F.lit(1)).alias("shared")))
    counts = events.groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    all_pairs = (counts.agg(F.array_sort(F.collect_list("client_id")).alias("cs"))
                 .select(F.inline(_pairs_of("cs"))))
    ca = counts.select(F.col("client_id").alias("client_a"), F.col("n").alias("count_a"))
    cb = counts.select(F.col("client_id").alias("client_b"), F.col("n").alias("count_b"))
    j = (all_pairs.join(ca, "client_a").join(cb, "client_b")
         .join(shared, ["client_a", "client_b"], "left")
         .withColumn("shared", F.coalesce("shared", F.lit(0)).cast("bigint")))
    pa = F.round(E.safe_ratio(F.col("shared") * 100, F.col("count_a")), 6)
    pb = F.round(E.safe_ratio(F.col("shared") * 100, F.col("count_b")), 6)
    return j.select("client_a", "client_b", "count_a", "count_b", "shared",
                    pa.alias("pct_a_in_b"), pb.alias("pct_b_in_a"),
                    (pa >= E.SUBSET_PCT).alias("a_subset"), (pb >= E.SUBSET_PCT).alias("b_subset"))


def unique_contribution(events: DataFrame) -> DataFrame:
    """Events seen only on one client, per client, and their share of its total."""
    only = (events.groupBy(*EVENT).agg(F.count(F.lit(1)).alias("cc"),
                                       F.max("client_id").alias("client_id"))
            .where(F.col("cc") == 1)
            .groupBy("client_id").agg(F.count(F.lit(1)).alias("unique_events")))
    totals = events.groupBy("client_id").agg(F.count(F.lit(1)).alias("total_events"))
    out = (totals.join(only, "client_id", "left")
           .select("client_id", F.coalesce("unique_events", F.lit(0)).cast("bigint")
                   .alias("unique_events"), "total_events"))
    out = out.withColumn("pct", F.round(E.safe_ratio(F.col("unique_events") * 100,
                                                     F.col("total_events")), 6))
    return _enough_clients(out, events)


def sample_converged(events: DataFrame, limit: int = 10) -> DataFrame:
    """Latest events seen on all clients: clients in order of first sighting."""
    n = n_clients(events)
    ec = event_clients(events, with_order=True).where(F.col("client_count") == n)
    order = F.array_join(F.transform("_seen", lambda x: x["client_id"]), " -> ")
    out = (ec.select(*EVENT, order.alias("client_order"),
                     F.col("earliest").cast("timestamp_ntz").alias("earliest"),
                     F.col("latest").cast("timestamp_ntz").alias("latest"),
                     F.round(E.seconds_between("earliest", "latest"), 6).alias("spread_seconds"),
                     E.preview("norm_query", E.PREVIEW_QUERY).alias("query_preview"),
                     E.preview("username", E.PREVIEW_USER).alias("user_preview"))
           .orderBy(F.col("earliest").desc(), *[F.col(c) for c in EVENT])
           .limit(limit))
    return out.where(n >= 2)


def convergence_report(searches: DataFrame, start, end, window_seconds: int = 300
                       ) -> dict[str, DataFrame]:
    """All reports over one scan; ``search_events`` is computed once, into a
    checkpoint that goes when no report refers to it any more."""
    ev = materialize(search_events(searches, start, end, window_seconds))
    return {"event_client_distribution": event_client_distribution(ev),
            "full_convergence": full_convergence(ev),
            "spread_histogram": spread_histogram(ev),
            "events_per_client": events_per_client(ev),
            "client_overlap": client_overlap(ev),
            "unique_contribution": unique_contribution(ev),
            "sample_converged": sample_converged(ev)}
