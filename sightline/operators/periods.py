"""Time periods: ISO weeks, calendar months and all_time.

Periods are generated by Spark from the data's own date range (one tiny
aggregate, then ``sequence`` + ``explode``); no driver loop over dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as E

PERIOD_KEYS = ["period_type", "period_id"]


def date_range(df: DataFrame, column: str = "date") -> DataFrame:
    """One row (min_date, max_date); no row when the input is empty."""
    return (df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))
              .where(F.col("min_date").isNotNull()))


def min_live_date(live: DataFrame) -> DataFrame:
    return live.agg(F.min("date").alias("min_live_date"))


def generate_periods(dates: DataFrame, column: str = "date") -> DataFrame:
    """All weeks and months covering [min, max] (full bounds at the edges) and
    all_time = (min, max). Output: period_type, period_id, start_date, end_date."""
    r = date_range(dates, column)
    weeks = (r.select(F.explode(F.sequence(E.week_start("min_date"), F.col("max_date"),
                                           F.expr("INTERVAL 7 DAYS"))).alias("s"))
              .select(F.lit("week").alias("period_type"), E.iso_week_key("s").alias("period_id"),
                      F.col("s").alias("start_date"), F.date_add("s", 6).alias("end_date")))
    months = (r.select(F.explode(F.sequence(E.month_start("min_date"), F.col("max_date"),
                                            F.expr("INTERVAL 1 MONTH"))).alias("s"))
               .select(F.lit("month").alias("period_type"), E.month_key("s").alias("period_id"),
                       F.col("s").alias("start_date"), E.month_end("s").alias("end_date")))
    all_time = r.select(F.lit("all_time").alias("period_type"), F.lit("all_time").alias("period_id"),
                        F.col("min_date").alias("start_date"), F.col("max_date").alias("end_date"))
    return weeks.unionByName(months).unionByName(all_time)


def existing_periods(summary: DataFrame) -> DataFrame:
    return summary.select(*PERIOD_KEYS).distinct()


def stale_periods(periods: DataFrame, existing: DataFrame, live: DataFrame) -> DataFrame:
    """Periods still to compute: drop those ending before the first live date
    that already have a summary; all_time is always kept; with no live data
    nothing is dropped."""
    mld = min_live_date(live).scalar()              # scalar subquery, one value
    done = existing_periods(existing).withColumn("_done", F.lit(True))
    p = periods.join(done, PERIOD_KEYS, "left")
    skip = ((F.col("period_type") != "all_time") & mld.isNotNull()
            & (F.col("end_date") < mld) & F.col("_done").isNotNull())
    return p.where(~skip).select(periods.columns)


def week_start_from_id(period_id) -> F.Column:
    """Monday of ISO week ``YYYY-Www``: Monday of the week holding 4 January,
    plus 7 * (week - 1) days."""
    pid = E.col(period_id)
    year = F.substring(pid, 1, 4).cast("int")
    week = F.substring(pid, 7, 2).cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(E.week_start(jan4), (week - 1) * 7)


def available_periods(summary: DataFrame, max_ts) -> DataFrame:
    """Weeks and months that have a summary row, with label and bounds to the
    second; only periods starting at or before ``max_ts``; newest first."""
    s = summary.where(F.col("period_type").isin("week", "month")).select(*PERIOD_KEYS)
    is_week = F.col("period_type") == "week"
    start = F.when(is_week, week_start_from_id("period_id")).otherwise(
        F.to_date(F.concat(F.col("period_id"), F.lit("-01"))))
    s = s.withColumn("start_date", start)
    end = F.when(is_week, F.date_add("start_date", 6)).otherwise(F.last_day("start_date"))
    label = F.when(is_week, F.concat(F.substring("period_id", 7, 2), F.lit("/"),
                                     F.substring("period_id", 1, 4))
                   ).otherwise(F.date_format("start_date", "MMMM yyyy"))
    out = s.select(*PERIOD_KEYS, "start_date", end.alias("end_date"), label.alias("label"),
                   F.col("start_date").cast("timestamp_ntz").alias("start_ts"),
                   (end.cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND"))
                   .alias("end_ts"))
    out = out.where(F.col("start_ts") <= F.lit(max_ts).cast("timestamp_ntz"))
    return out.orderBy(F.col("start_date").desc(), "period_type")
