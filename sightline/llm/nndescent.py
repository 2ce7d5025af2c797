"""Approximate nearest neighbours: NN-descent graph and greedy graph search.

* Vectors of one direction (to 2^-40 of the largest component) are one *node*;
  a node keeps the ``k`` + 1 smallest ids among its rows, which is all that a list
  of the k nearest can need. A vector that a third of the rows share is one node.
  Nodes are numbered by their smallest id, so ties go to the smaller id everywhere.
* Start: random hyperplanes cut the nodes into cells of about ``LEAF`` nodes, a
  few times over; inside a cell each node takes its nearest. A cell that came
  out larger is dealt into parts by hash.
* NN-descent: the neighbours of a node (its own, and a hash sample of those
  that name it) meet at the node by a join and are compared with one another:
  neighbours of neighbours. A pair nearer than the furthest neighbour of one of
  them is sent there; each node keeps the best ``K``. Rounds go on until few
  lists change.
* Search: a beam of ``BEAM`` nodes per query. Each step joins the best nodes not
  yet visited with the graph (lists both ways), scores their neighbours and
  merges them into the beam, until a beam holds only visited nodes.

Inside, vectors travel in single precision (scaled by a power of two, so vectors
given in single precision are exact) and are normalised and scored in double;
the whole beams are then scored again on the original vectors in double.

Defined cases: rows without an id, and vectors null, zero or holding null or
non-finite components take no part; of vectors of several dimensions the most
frequent takes part (the smaller, if two are equally frequent); fewer than k
candidates give all of them; ties go to the smaller id; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import drop_table, write_once

K, LEAF, TREES, CHANGE = 20, 1024, 8, 0.02
BEAM, EXPAND = 224, 64

LIST = T.StructType([T.StructField("node", T.LongType()), T.StructField("near", T.BinaryType()),
                     T.StructField("score", T.BinaryType())])
PAIR = T.StructType([T.StructField("node", T.LongType()), T.StructField("other", T.LongType()),
                     T.StructField("score", T.DoubleType())])


def code(v: np.ndarray) -> np.ndarray:
    """Single-precision rows of a matrix, scaled by a power of two."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]).astype(np.float32)


def direction(v: np.ndarray) -> np.ndarray:
    """Equal rows for rows of a matrix that differ by a positive factor only."""
    return np.rint(v / np.abs(v).max(axis=1, keepdims=True) * 2.0 ** 40).astype(np.int64)


def unit(codes) -> np.ndarray:
    """The vectors of length 1, in double, of some codes (Arrow or bytes)."""
    f = np.stack([np.frombuffer(c if isinstance(c, bytes) else c.as_py(), np.float32) for c in codes]).astype(float)
    return f / np.linalg.norm(f, axis=1, keepdims=True)


def by_run(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Consecutive rows of equal ``column`` as one table, across batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = batch.slice(lo, hi - lo)
            at = batch.schema.get_field_index(column)
            if held and held[-1].column(at)[0].as_py() != part.column(at)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _sink(schema: T.StructType, size: int = 20_000):
    """Collects rows of columns (arrays) and gives full record batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = to_arrow_schema(schema)
    held: list[tuple] = []
    count = 0

    def put(cols: tuple | None = None) -> Iterator[pa.RecordBatch]:
        nonlocal held, count
        if cols is not None and len(cols[0]):
            held.append(cols)
            count += len(cols[0])
        if held and (cols is None or count >= size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for c in col for x in c] if pa.types.is_binary(f.type)
                          else np.concatenate(col), f.type) for col, f in zip(zip(*held), kinds)], schema=kinds)
            held, count = [], 0

    return put


# -- nodes ------------------------------------------------------------------------

def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(node, vec, code, ids, way) per direction, and (id, way) per row: node is
    a number in the order of the smallest ids, way a hash of the direction."""
    src = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    src = src.where(~bad & F.exists("vec", lambda x: x != 0))
    sizes = src.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    src = src.where(F.size("vec") == (sizes["d"] if sizes else -1))
    row = T.StructType([T.StructField("id", T.LongType()), T.StructField("way", T.LongType()),
                        T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("code", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            m = np.ascontiguousarray(flat.reshape(batch.num_rows, -1))
            ids = np.array([xxhash.xxh3_64_intdigest(r.tobytes()) for r in direction(m)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids), batch.column(1),
                 pa.array([c.tobytes() for c in code(m)], pa.binary())], names=row.names)

    rows = write_once(src.mapInArrow(encode, row), "vectors")
    rank = F.row_number().over(Window.partitionBy("way").orderBy("id"))
    few = rows.select("way", "id").distinct().withColumn("r", rank).where(F.col("r") <= k + 1)
    ids = few.groupBy("way").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 at most
    first = few.where("r = 1").select("way", "id")
    nodes = rows.join(first, ["way", "id"]).dropDuplicates(["way"]).join(ids, "way").orderBy("id", "way")
    nodes = nodes.withColumn("node", F.monotonically_increasing_id())  # one id may come with several vectors
    return write_once(nodes.select("node", "vec", "code", "ids", "way"), "nodes"), rows.select("id", "way")


# -- the graph ----------------------------------------------------------------------

def _best(other: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best distinct others: highest score, then smallest number."""
    order = np.lexsort((-score, other))
    other, score = other[order], score[order]
    keep = np.concatenate(([True], other[1:] != other[:-1]))
    other, score = other[keep], score[keep]
    top = np.lexsort((other, -score))[:k]
    return other[top], score[top]


def start_lists(nodes: DataFrame, count: int, k: int = K, leaf: int = LEAF, trees: int = TREES) -> DataFrame:
    """First neighbour lists: nearest within random cells (packed, one row per
    node and tree)."""
    bits = max(0, int(np.ceil(np.log2(max(1, count) / leaf))))
    schema = T.StructType([T.StructField("tree", T.IntegerType()), T.StructField("cell", T.LongType()),
                           T.StructField("node", T.LongType()), T.StructField("code", T.BinaryType())])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = unit(batch.column(1))
            planes = np.random.default_rng(17).standard_normal((trees, max(1, bits), m.shape[1])).astype(np.float32)
            for t in range(trees):
                side = (m @ planes[t].T > 0)[:, :bits].astype(np.int64)
                cell = side @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(m), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(m), t, np.int32)), pa.array(cell), batch.column(0), batch.column(1)],
                    names=schema.names)

    placed = write_once(nodes.select("node", "code").mapInArrow(cells, schema), "cells")
    sizes = placed.groupBy("tree", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * leaf)).alias("parts"))
    # at most trees * 2^bits rows, twice trees * nodes / leaf: a join, not a broadcast by hand
    dealt = placed.join(sizes, ["tree", "cell"]).select(
        F.xxhash64("tree", "cell", F.pmod(F.xxhash64("node", "tree"), F.col("parts"))).alias("cell"), "node", "code")

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = _sink(LIST, 4000)
        for tab in by_run(batches, "cell"):
            ids = tab.column("node").to_numpy()
            m = unit(tab.column("code"))
            n = min(k, len(ids) - 1)
            if n < 1:
                continue
            for lo in range(0, len(ids), 256):
                s = m[lo:lo + 256] @ m.T
                s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -9
                top = np.argpartition(-s, n - 1, axis=1)[:, :n]
                best = np.take_along_axis(s, top, 1)
                yield from put((ids[lo:lo + 256], [r.tobytes() for r in ids[top]], [r.tobytes() for r in best]))
        yield from put()

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(inside, LIST)


def keep_best(lists: DataFrame, k: int = K) -> DataFrame:
    """One packed list of the k best per node from packed lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = _sink(LIST, 4000)
        for tab in by_run(batches, "node"):
            near = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in tab.column("near")])
            score = np.concatenate([np.frombuffer(x.as_py(), np.float64) for x in tab.column("score")])
            near, score = _best(near, score, k)
            yield from put(([tab.column("node")[0].as_py()], [near.tobytes()], [score.tobytes()]))
        yield from put()

    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(run, LIST)


def _edges(lists: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = _sink(PAIR)
        for batch in batches:
            for node, near, score in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                other = np.frombuffer(near.as_py(), np.int64)
                yield from put((np.full(len(other), node), other, np.frombuffer(score.as_py(), np.float64)))
        yield from put()

    return lists.mapInArrow(run, PAIR)


def both_ways(lists: DataFrame, k: int = K) -> DataFrame:
    """(center, member): a node's own neighbours, and of the nodes that name it
    the k with the smallest hash (a node that all name stays bounded)."""
    edges = _edges(lists).select("node", "other")
    spot = F.xxhash64("other", "node")
    back = edges.withColumn("r", F.row_number().over(Window.partitionBy("other").orderBy(spot, "node")))
    back = back.where(F.col("r") <= k).select(F.col("other").alias("center"), F.col("node").alias("member"))
    return edges.toDF("center", "member").union(back).distinct()


def descend(lists: DataFrame, codes: DataFrame, k: int = K) -> tuple[DataFrame, int]:
    """One round: neighbours of a node are compared with one another. Returns
    the new lists and how many pairs were sent."""
    known = lists.select(F.col("node").alias("member"), "near", "score")
    members = both_ways(lists, k).join(known, "member").join(
        codes.select(F.col("node").alias("member"), "code"), "member")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = _sink(PAIR)
        for tab in by_run(batches, "center"):
            ids = tab.column("member").to_numpy()
            if len(ids) < 2:
                continue
            m = unit(tab.column("code"))
            s = m @ m.T
            np.fill_diagonal(s, -9)
            score = [np.frombuffer(x.as_py(), np.float64) for x in tab.column("score")]
            least = np.array([x[-1] if len(x) >= k else -2 for x in score])
            a, b = np.nonzero(s > least[:, None])
            if len(a):
                near = [set(np.frombuffer(x.as_py(), np.int64).tolist()) for x in tab.column("near")]
                new = np.fromiter((int(ids[y]) not in near[x] for x, y in zip(a.tolist(), b.tolist())), bool, len(a))
                yield from put((ids[a[new]], ids[b[new]], s[a[new], b[new]]))
        yield from put()

    found = write_once(members.repartition("center").sortWithinPartitions("center").mapInArrow(meet, PAIR)
                       .groupBy("node", "other").agg(F.max("score").alias("score")), "found")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = _sink(LIST, 4000)
        for tab in by_run(batches, "node"):
            rows = tab.column("other").to_numpy()
            single = tab.column("near").is_null().to_numpy()
            near, score = [rows[single]], [tab.column("one").to_numpy()[single]]
            for x, y in zip(tab.column("near").to_pylist(), tab.column("score").to_pylist()):
                if x is not None:
                    near.append(np.frombuffer(x, np.int64))
                    score.append(np.frombuffer(y, np.float64))
            best, s = _best(np.concatenate(near), np.concatenate(score), k)
            yield from put(([tab.column("node")[0].as_py()], [best.tobytes()], [s.tobytes()]))
        yield from put()

    none = F.lit(None).cast("binary")
    rows = found.select("node", "other", F.col("score").alias("one"), none.alias("near"), none.alias("score")).union(
        lists.select("node", F.lit(0).cast("long"), F.lit(0.0), "near", "score"))
    new = write_once(rows.repartition("node").sortWithinPartitions("node").mapInArrow(merge, LIST), "lists")
    sent = found.count()
    drop_table(found)
    return new, sent


def build(nodes: DataFrame, k: int = K) -> DataFrame:
    """The neighbour graph: packed lists of the k best per node (written). Rounds
    go on until few entries change; a round never lowers a score, so they end."""
    count = nodes.count()
    lists = write_once(keep_best(start_lists(nodes, count, k), k), "lists")
    while True:
        new, sent = descend(lists, nodes, k)
        drop_table(lists)
        lists = new
        if sent <= CHANGE * k * count:
            return lists


def with_codes(lists: DataFrame, nodes: DataFrame, k: int = K) -> DataFrame:
    """(node, near, codes): lists both ways with the codes of the neighbours."""
    rows = both_ways(lists, k).join(nodes.select(F.col("node").alias("member"), "code"), "member")
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("near", T.BinaryType()),
                           T.StructField("codes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = _sink(schema, 2000)
        for tab in by_run(batches, "center"):
            yield from put(([tab.column("center")[0].as_py()], [tab.column("member").to_numpy().tobytes()],
                            [b"".join(c.as_py() for c in tab.column("code"))]))
        yield from put()

    return write_once(rows.repartition("center").sortWithinPartitions("center").mapInArrow(run, schema), "graph")


# -- search -----------------------------------------------------------------------

STATE = T.StructType([T.StructField("query", T.LongType()), T.StructField("code", T.BinaryType()),
                      T.StructField("near", T.BinaryType()), T.StructField("score", T.BinaryType()),
                      T.StructField("seen", T.BinaryType())])
SCORED = T.StructType([T.StructField("query", T.LongType()), T.StructField("near", T.BinaryType()),
                       T.StructField("score", T.BinaryType())])


def search(queries: DataFrame, graph: DataFrame, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """Greedy search for (query, code, entry): beams of the best nodes found
    as (query, near, score). An entry is a node of the graph; it counts as
    found itself."""
    spark = graph.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = graph.repartition(parts, "node").persist(StorageLevel.DISK_ONLY)  # shuffled once for all steps
    entry = np.array([9.0]).tobytes()
    state = queries.select("query", "code", "entry")

    def begin(batches):
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([np.array([e], np.int64).tobytes() for e in batch.column(2).to_pylist()], pa.binary()),
                 pa.array([entry] * n, pa.binary()), pa.array([b"\0"] * n, pa.binary())], names=STATE.names)

    def frontier(batches):
        schema = ["query", "code", "node"]
        for batch in batches:
            q, c, v = [], [], []
            for query, code_, near, seen in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist()
                                                  for x in ("query", "code", "near", "seen"))):
                at = np.flatnonzero(np.frombuffer(seen, np.uint8) == 0)[:expand]  # beams are sorted
                v.append(np.frombuffer(near, np.int64)[at])
                q += [query] * len(at)
                c += [code_] * len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(c, pa.binary()),
                 pa.array(np.concatenate(v) if v else np.empty(0, np.int64))], names=schema)

    def visit(batches):
        put = _sink(SCORED, 500)
        for batch in batches:
            for query, code_, near, codes in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist()
                                                   for x in ("query", "code", "near", "codes"))):
                size = len(code_)
                m = unit([codes[lo:lo + size] for lo in range(0, len(codes), size)])
                # ties are ties whatever the last bits of a sum
                yield from put(([query], [near], [np.round(m @ unit([code_])[0], 14).tobytes()]))
        yield from put()

    def update(left, right):
        import pandas as pd
        if not len(left):
            return pd.DataFrame({n: [] for n in STATE.names})
        s = left.iloc[0]
        near, score = np.frombuffer(s["near"], np.int64), np.frombuffer(s["score"], np.float64)
        seen = np.frombuffer(s["seen"], np.uint8).copy()
        seen[np.flatnonzero(seen == 0)[:expand]] = 1
        if len(right):
            more = np.concatenate([np.frombuffer(x, np.int64) for x in right["near"]])
            got = np.concatenate([np.frombuffer(x, np.float64) for x in right["score"]])
            more, first = np.unique(more, return_index=True)
            new = ~np.isin(more, near)
            near = np.concatenate((near, more[new]))
            score = np.concatenate((score, got[first][new]))
            seen = np.concatenate((seen, np.zeros(int(new.sum()), np.uint8)))
            top = np.lexsort((near, -score))[:beam]
            near, score, seen = near[top], score[top], seen[top]
        return pd.DataFrame({"query": [s["query"]], "code": [s["code"]], "near": [near.tobytes()],
                             "score": [score.tobytes()], "seen": [seen.tobytes()]})

    front = T.StructType([T.StructField("query", T.LongType()), T.StructField("code", T.BinaryType()),
                          T.StructField("node", T.LongType())])
    state = write_once(state.mapInArrow(begin, STATE), "beams")
    done = None
    while True:
        open_ = state.where("locate(unhex('00'), seen) > 0")
        asked = open_.mapInArrow(frontier, front)
        scored = asked.join(held, "node").select("query", "code", "near", "codes").mapInArrow(visit, SCORED)
        new = write_once(open_.groupBy("query").cogroup(scored.groupBy("query")).applyInPandas(update, STATE), "beams")
        closed = state.where("locate(unhex('00'), seen) = 0").select(*SCORED.names)
        done = closed if done is None else done.union(closed)
        state = new
        if not new.where("locate(unhex('00'), seen) > 0").limit(1).count():
            held.unpersist()
            return done.union(new.select(*SCORED.names))


def nearest(vectors: DataFrame, wanted: F.Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows of each row that ``wanted`` (a condition on ``id``)
    names: query_id, rank, vec_id, score."""
    nodes, rows = nodes_of(vectors, id_col, vector_col, k)
    graph = with_codes(build(nodes), nodes)
    asked = rows.where(wanted).distinct().join(nodes.select("way", "node"), "way").select("id", "node")
    starts = asked.select("node").distinct().join(nodes, "node")
    beams = search(starts.select(F.col("node").alias("query"), "code", F.col("node").alias("entry")), graph)

    def unpack(batches):
        for batch in batches:
            q, v = [], []
            for query, near in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(near, np.int64)
                q.append(np.full(len(ids), query))
                v.append(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, np.int64))
                                              for x in (q, v)], names=["query", "node"])

    pair = T.StructType([T.StructField("query", T.LongType()), T.StructField("node", T.LongType())])
    found = beams.mapInArrow(unpack, pair).join(nodes.select("node", "vec", "ids"), "node").join(
        starts.select(F.col("node").alias("query"), F.col("vec").alias("own")), "query")
    # by powers of two (exact), so that no square vanishes or overflows
    for name in ("vec", "own"):
        top = F.array_max(F.transform(name, lambda x: F.abs(x)))
        power = F.pow(F.lit(2.0), -F.greatest(F.least(F.floor(F.log2(top)), F.lit(1000)), F.lit(-1000)))
        found = found.withColumn("_by", power).withColumn(name, F.transform(name, lambda x: x * F.col("_by"))).drop("_by")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("vec", "own") / (F.sqrt(dot("vec", "vec")) * F.sqrt(dot("own", "own")))
    scored = found.select("query", cosine.alias("score"), F.explode("ids").alias("vec_id"))
    # k + 1 per query node: one of them may be the asking row itself
    place = Window.partitionBy("query").orderBy(F.desc(F.round("score", 14)), "vec_id")
    best = scored.withColumn("r", F.row_number().over(place)).where(F.col("r") <= k + 1)
    best = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "score", "vec_id"))).alias("best"))
    out = asked.join(best.withColumnRenamed("query", "node"), "node").select(
        F.col("id").alias("query_id"), F.slice(F.filter(
            "best", lambda b: b["vec_id"] != F.col("id")), 1, k).alias("best"))
    return out.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        F.col("b.score").alias("score"))
