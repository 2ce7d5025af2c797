"""Merkle fixity audit of archive replicas.

Every record of a replica is hashed (SHA-256). Records lie at offsets of
archive files; ordered offset ranges form the tree: ranges of 64 KB, of 4 MB
and so on up to a file, then runs of files up to one root. A node's digest is
the hash of its children's keys and digests in order. Two replicas are compared
from the root down, and only the children of nodes that differ are compared, so
an audit of sound replicas reads two roots and a damaged record is found along
one path. Ranges are aligned to offsets, not to record numbers: a record that is
missing or too many changes its own branch and no other.

Trees of both replicas are built together, level by level; each level is written
once (a few bytes per range).

Defined cases: null payloads are hashed as empty; records at the same place
(repeated rows) form one leaf from their number, smallest and largest digest and
a sum over all; a null file or offset is a place of its own; an empty replica
makes all records of the other missing or extra; extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import write_once

RANGE_BITS, FAN_BITS, OFFSET_BITS = 16, 6, 34   # 64 KB, 64 children, files below 16 GB


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """A WARC/1.1 resource record as text."""
    end = "\r\n"
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{end}WARC-Type: resource{end}WARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")), F.lit(f">{end}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit(f"{end}Content-Type: text/html{end}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(end * 2), body, F.lit(end * 2))


def leaves(records: DataFrame, replica: str, file_col: str = "file", offset_col: str = "offset",
           payload_col: str = "payload", id_col: str = "record_id") -> DataFrame:
    """(replica, file, offset, record_id, length, digest): one row per place."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    rows = records.select(F.col(file_col).cast("long").alias("file"), F.col(offset_col).cast("long").alias("offset"),
                          F.col(id_col).alias("record_id"), F.octet_length(payload).cast("long").alias("length"),
                          F.sha2(payload, 256).alias("digest"))
    many = F.sha2(F.concat_ws(":", F.count(F.lit(1)), F.min("digest"), F.max("digest"),
                              F.sum(F.xxhash64("digest").cast("decimal(38,0)")).cast("string")), 256)
    return rows.groupBy("file", "offset").agg(
        F.min("record_id").alias("record_id"), F.sum("length").alias("length"),
        F.when(F.count(F.lit(1)) == 1, F.min("digest")).otherwise(many).alias("digest")
    ).select(F.lit(replica).alias("replica"), "file", "offset", "record_id", "length", "digest")


def _next(key: Column, level: int) -> Column:
    """The parent's key, from a node's key at ``level`` (0: a leaf)."""
    bits = RANGE_BITS + FAN_BITS * (level - 1)
    if level == 0:
        return F.struct(key["file"].alias("file"), F.shiftright(key["at"], RANGE_BITS).alias("at"))
    if bits < OFFSET_BITS - FAN_BITS:
        return F.struct(key["file"].alias("file"), F.shiftright(key["at"], FAN_BITS).alias("at"))
    if bits < OFFSET_BITS:  # the last ranges of a file meet in the file
        return F.struct(key["file"].alias("file"), F.lit(0).cast("long").alias("at"))
    return F.struct(F.shiftright(key["file"], FAN_BITS).alias("file"), F.lit(0).cast("long").alias("at"))


def levels_to_file() -> int:
    """The level at which a node is a whole file."""
    return 2 + (OFFSET_BITS - RANGE_BITS - 1) // FAN_BITS


def build(rows: DataFrame) -> list[DataFrame]:
    """Levels of the trees of all replicas in ``rows`` (of ``leaves``), from the
    leaves up to one root: (replica, key, digest), written."""
    out = [rows.select("replica", F.struct(F.col("file").alias("file"), F.col("offset").alias("at")).alias("key"), "digest")]
    span = rows.agg(F.min("file"), F.max("file")).first()
    spread = max(abs(x) for x in span if x is not None) if any(x is not None for x in span) else 0
    top = levels_to_file()
    while spread:  # runs of files: until one run holds all (and one those below 0)
        top, spread = top + 1, spread >> FAN_BITS
    for level in range(top):
        children = F.sort_array(F.collect_list(F.struct("key", "digest")))
        text = F.transform(children, lambda c: F.concat_ws(
            ":", c["key"]["file"].cast("string"), c["key"]["at"].cast("string"), c["digest"]))
        up = out[-1].select("replica", _next(F.col("key"), level).alias("up"), "key", "digest")
        out.append(write_once(up.groupBy("replica", F.col("up").alias("key")).agg(
            F.sha2(F.array_join(text, "\n"), 256).alias("digest")), f"level{level + 1}"))
    return out


def _differ(nodes: DataFrame, first: str, second: str) -> DataFrame:
    side = lambda r: F.max(F.when(F.col("replica") == r, F.col("digest")))
    both = nodes.groupBy("key").agg(side(first).alias("a"), side(second).alias("b"))
    return both.where(~F.col("a").eqNullSafe(F.col("b")))


def descend(tree: list[DataFrame], first: str, second: str) -> DataFrame:
    """(key, a, b) of the leaves that differ, along differing branches only."""
    bad = _differ(tree[-1], first, second)
    for level in range(len(tree) - 2, -1, -1):
        if level == len(tree) - 2 and not bad.limit(1).count():  # roots agree: nothing else is read
            return bad
        same_up = reduce(lambda x, y: x & y, [F.col("up")[c].eqNullSafe(F.col("key_bad")[c]) for c in ("file", "at")])
        below = tree[level].withColumn("up", _next(F.col("key"), level))
        bad = _differ(below.join(bad.select(F.col("key").alias("key_bad")), same_up, "left_semi"), first, second)
    return bad


def audit(first: DataFrame, second: DataFrame, **columns) -> DataFrame:
    """Records of two replicas that differ: file, offset, record_id, status
    (changed, missing, extra: as seen from the first), lengths and digests."""
    rows = write_once(leaves(first, "a", **columns).unionByName(leaves(second, "b", **columns)), "leaves")
    tree = build(rows)
    bad = descend(tree, "a", "b").select("key", F.col("a").alias("digest_a"), F.col("b").alias("digest_b"))
    pick = lambda r, c: F.max(F.when(F.col("replica") == r, F.col(c)))
    near = F.col("key")["file"].eqNullSafe(F.col("file")) & F.col("key")["at"].eqNullSafe(F.col("offset"))
    found = bad.join(rows.drop("digest"), near).groupBy("file", "offset", "digest_a", "digest_b").agg(
        F.coalesce(pick("a", "record_id"), pick("b", "record_id")).alias("record_id"),
        pick("a", "length").alias("length_a"), pick("b", "length").alias("length_b"))
    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
              .otherwise("changed"))
    return found.select("file", "offset", "record_id", status.alias("status"), "length_a", "length_b",
                        "digest_a", "digest_b")
