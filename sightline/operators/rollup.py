"""Daily rollups of the raw log (the two materialised views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as E


def daily_search_tuples(searches: DataFrame) -> DataFrame:
    """count(*) per (UTC date, username, normalised query)."""
    return (searches
            .groupBy(E.event_date("timestamp").alias("date"), F.col("username"),
                     E.normalize_query("query").alias("query_normalized"))
            .agg(F.count(F.lit(1)).alias("search_count")))


def daily_client_stats(searches: DataFrame) -> DataFrame:
    """Per (client, date): searches and distinct users.

    The distinct count is planned as an aggregate on (client, date, user) first,
    so a client-day holding a large share of all rows still spreads over tasks.
    """
    return (searches
            .groupBy("client_id", E.event_date("timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("search_count"),
                 F.countDistinct("username").alias("unique_users")))


def refresh_rollups(new_rows: DataFrame, tuples_path: str, stats_path: str) -> None:
    """Recompute both rollups for the months present in ``new_rows`` (all raw
    rows of those months) and replace only those month partitions (dynamic
    partition overwrite); other months stay as they are. Same result as a
    full recompute."""
    # range-partitioned on (month, date, ...): a task writes a contiguous run of
    # months (about one file per month), and a large day fills several tasks
    t = daily_search_tuples(new_rows).withColumn("month", E.month_key("date"))
    c = daily_client_stats(new_rows).withColumn("month", E.month_key("date"))
    for df, path, keys in ((t, tuples_path, ["username", "query_normalized"]),
                           (c, stats_path, ["client_id"])):
        (df.repartitionByRange("month", "date", *keys).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))
