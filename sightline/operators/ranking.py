"""Consecutive ranks 1..n per group without putting a whole group into one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` shuffles every row of a group
to one task; the all_time top list is one such group holding every query. Here
the rows are range-partitioned on (g, o) instead, every task numbers its rows,
and a small table of per-(task, group) counts (bounded by tasks + groups)
supplies each task's offset. The order must be total (end with a unique key).

The numbered rows are used twice (counts and the final join), so they are
materialised once with a reliable ``checkpoint()`` in the session's shared
checkpoint folder: two independent evaluations could sample different range
boundaries and disagree on the numbering, and a lost executor cannot change
numbers that are already written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


def rank_within(df: DataFrame, group_cols: list[str], order_cols: list[Column],
                rank_col: str = "rank") -> DataFrame:
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in group_cols], *order_cols)
    rid = F.monotonically_increasing_id()
    ensure_checkpoint_dir(df.sparkSession)
    numbered = ordered.select("*", F.shiftright(rid, _LOCAL_BITS).alias("_task"),
                              (rid.bitwiseAND((1 << _LOCAL_BITS) - 1)).alias("_pos")
                              ).checkpoint(eager=True)
    counts = (numbered.groupBy("_task", *group_cols)
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")))
    before = Window.partitionBy(*group_cols).orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("_task", *group_cols, "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # offsets has at most (#tasks + #groups) rows: a proven bound for broadcast
    out = numbered.join(F.broadcast(offsets), ["_task", *group_cols], "inner")
    rank = (F.col("_before") + F.col("_pos") - F.col("_first") + 1).cast("int")
    return out.select(*df.columns, rank.alias(rank_col))
