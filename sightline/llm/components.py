"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_table, write_once


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); the root is the
    smallest node reachable.

    Each round points every node at the smallest of itself and its neighbours
    (map-side minimum, so a hub is no hot group) and at what that one points at, then
    carries the links over to the nodes pointed at. Links within one node go, so the
    rounds get smaller and smaller; a node's pointer tables are chained at the end,
    last round first. Ids are hashes, so runs of falling ids are short. Every round
    is written, and no round repeats an earlier one.
    """
    rounds: list[DataFrame] = []
    now = write_once(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while True:
        ends = now.select("a", "b").union(now.select("b", "a"))
        near = write_once(ends.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("root")), "near")
        further = near.select(F.col("node").alias("root"), F.col("root").alias("further"))
        up = write_once(near.join(further, "root").select("node", F.col("further").alias("root")), "pointers")
        drop_table(near)
        rounds.append(up)
        at = [up.select(F.col("node").alias(c), F.col("root").alias("_" + c)) for c in ("a", "b")]
        carried = now.join(at[0], "a").join(at[1], "b").where("_a <> _b").select(
            F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
        carried = write_once(carried, "links")
        drop_table(now)
        now = carried
        if not now.limit(1).count():
            break
    drop_table(now)
    roots = rounds.pop()
    while rounds:
        up = rounds.pop()
        ahead = roots.select(F.col("node").alias("root"), F.col("root").alias("_root"))
        new = write_once(up.join(ahead, "root", "left").select(
            "node", F.coalesce("_root", "root").alias("root")), "roots")
        drop_table(up)
        drop_table(roots)
        roots = new
    return roots
