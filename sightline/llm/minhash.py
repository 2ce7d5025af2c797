"""Near-duplicate groups by b-bit MinHash, confirmed on the full sets.

Two texts are linked when 100 * |A n B| >= 75 * |A u B| over their distinct
five-word shingles. Only group membership is wanted, so work goes where groups
are still apart:

1. ``sketch``: one pass over the documents. Texts with the same shingle set are
   one *node* (its 64-bit set hash). Of K minima per set, ``rows`` of them make
   a band key, and the low B bits of all K are packed into longs.
2. Band keys meet in buckets, whose smallest node is their hub; each node is
   paired with the hub it shares most buckets with (stars, not all pairs). The packed signatures give an estimate of the
   similarity, corrected for chance agreement of B bits, by counting bits; the
   pairs above it are confirmed on the full sets.
3. Where a bucket still holds several groups, its members are compared in
   blocks by their packed signatures. Likely pairs in different groups hold
   together *families*; a block names only pairs that join something new, so as
   many as it has members. A family's members meet in blocks with their full sets,
   where the likely pairs are confirmed unless they are joined by then. So every
   pair that shares a band and passes the estimate is either inside one group
   already or was tested: no cap, no sample, and no list of all pairs.

With 32 bands of 4 rows a pair at the threshold (0.75) misses all bands with
probability 5e-6, and its estimate lies below ``FLOOR`` (five deviations
lower) with probability about 1e-7.

Defined cases: null, empty and blank texts have no shingles and stay alone; a
text of fewer than five words is one shingle; repeated rows fall into one node
and each row gets its result; a null id never wins a group (its component is
the smallest id there is, or null); extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import blank_words, drop_table, slices, write_once

WORDS, SIMILAR = 5, 75
BANDS, ROWS, B = 32, 4, 4
K = BANDS * ROWS
LONGS = K * B // 64
FLOOR = 0.55            # confirmed if the estimate reaches this
BLOCK = 512             # members compared at a time inside a bucket
BLOCK_BYTES = 16 << 20  # and their sets
BITS_BYTES = 32 << 20   # of a table of bits over the shingles of a block
GROUP = 256             # pairs of one hub confirmed at a time
BROADCAST_IDS = 2_000_000   # 16 MB of ids; above it the join shuffles

_rng = np.random.default_rng(20240607)
_MUL = (_rng.integers(0, 2**63, K, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _rng.integers(0, 2**63, K, dtype=np.uint64)
_WORD_MUL = (_rng.integers(0, 2**63, WORDS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_BAND_MUL = (_rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ONES = np.uint64(0x1111111111111111)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles."""
    words = blank_words(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for j in range(WORDS):
        total += h[j:j + n] * _WORD_MUL[j]
    return np.unique(_mix(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 2048):
        part = shingles[lo:lo + 2048]
        for k in range(0, K, 16):  # a slice that stays in the cache
            x = part[None, :] * _MUL[k:k + 16, None] + _ADD[k:k + 16, None]
            np.minimum(out[k:k + 16], x.min(axis=1), out=out[k:k + 16])
    return out


def node_of(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def packed(mins: np.ndarray) -> np.ndarray:
    """Low B bits of the minima, 64 / B of them in a long; rows stay rows."""
    low = (mins & np.uint64((1 << B) - 1)).reshape(*mins.shape[:-1], LONGS, 64 // B)
    shift = (np.arange(64 // B) * B).astype(np.uint64)
    return np.bitwise_or.reduce(low << shift, axis=-1).view(np.int64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    m = mins.reshape(*mins.shape[:-1], BANDS, ROWS)
    x = (m * _BAND_MUL).sum(axis=-1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    return _mix(x).view(np.int64)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n_shingles, node, bands, sig) per document, written once."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"),
                      F.xxhash64(text_col).alias("text_hash"))
    schema = T.StructType([
        T.StructField("id", src.schema["id"].dataType), T.StructField("text_hash", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sig", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sizes, nodes, mins = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text)
                    sizes.append(len(s))
                    nodes.append(node_of(s) if len(s) else None)
                    if len(s):
                        mins.append(minima(s))
                m = np.array(mins, np.uint64).reshape(-1, K)
                has = np.array([n is not None for n in nodes], bool)

                def lists(values: np.ndarray, width: int) -> pa.Array:
                    ends = np.concatenate(([0], np.cumsum(has * width))).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1)))

                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                     lists(band_keys(m), BANDS), lists(packed(m), LONGS)], names=schema.names)

    return write_once(src.mapInArrow(run, schema), "sketch")


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures (arrays of longs), corrected for
    the 2^-B share of agreements by chance."""
    differ = F.lit(0)
    for i in range(LONGS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        y = x
        for s in range(1, B):
            y = y.bitwiseOR(F.shiftrightunsigned(x, s))
        differ = differ + F.bit_count(y.bitwiseAND(F.lit(int(_ONES))))
    agree = 1 - differ / F.lit(float(K))
    return (agree - 2.0 ** -B) / (1 - 2.0 ** -B)


def _sizes_fit(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= SIMILAR * F.greatest(a, b)


def star_pairs(members: DataFrame, signatures: DataFrame) -> DataFrame:
    """(a, b): each node with the hub of its buckets that it shares most of them
    with, if the estimate lets the pair pass."""
    hubs = members.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("other"))
    hubs = hubs.where("b <> other").select("key", "b")
    shared = (members.distinct().join(hubs, "key").where("node <> b")
              .groupBy(F.col("node").alias("a"), "b").agg(F.count(F.lit(1)).alias("bands")))
    pairs = shared.groupBy("a").agg(F.max_by("b", F.struct("bands", -F.col("b"))).alias("b"))
    x = signatures.select(F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("sig").alias("a_sig"))
    y = signatures.select(F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("sig").alias("b_sig"))
    return (pairs.join(x, "a").join(y, "b")
            .where(_sizes_fit("a_n", "b_n") & (estimate("a_sig", "b_sig") >= FLOOR)).select("a", "b"))


SET = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType())])


def with_sets(uses: DataFrame, docs: DataFrame, sketches: DataFrame, id_col: str, text_col: str,
              fields: list[T.StructField]) -> DataFrame:
    """The rows of ``uses`` (node, and an array ``uses`` of structs of ``fields``), one
    per use, with the node's full set. Sets are made anew from the text of one row per
    node, the one of its smallest (id, text hash), and sent straight to their uses."""
    holder = sketches.where("node is not null").groupBy("node").agg(F.min(F.struct(
        F.col("id").isNull().alias("none"), "id", "text_hash")).alias("at"))
    wanted = write_once(uses.join(holder, "node").select(
        "node", "uses", F.col("at.id").alias("id"), F.col("at.text_hash").alias("text_hash")), "wanted")
    sends = wanted.agg(F.sum(F.size("uses"))).first()[0] or 0
    small = sends <= BROADCAST_IDS
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                      F.col(text_col).cast("binary").alias("text"))
    own = wanted.where("id is not null")
    rows = src.join(F.broadcast(own) if small else own, ["id", "text_hash"])
    # nodes without any id: rows without one, each text once
    lone = (src.where("id is null").groupBy("text_hash").agg(F.first("text").alias("text"))
            .join(wanted.where("id is null").drop("id"), "text_hash"))
    columns = ["node", "uses", "text"]
    rows = rows.select(columns).unionByName(lone.select(columns))
    out = T.StructType([*fields, *SET.fields])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, 2, size=1 << 20)):
            where, blobs = [], []
            for text in part.column(2).to_pylist():
                blobs.append(shingle_set(text).tobytes())
            use = part.column(1)
            where = np.repeat(np.arange(part.num_rows), np.diff(use.offsets.to_numpy()))
            flat = use.flatten()
            cols = [flat.field(f.name) for f in fields]
            # a set goes as often as it is used: a few rows at a time
            sizes = np.cumsum(np.array([len(b) for b in blobs], np.int64)[where])
            lo = 0
            while lo < len(where):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + (8 << 20))))
                at = where[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in cols), part.column(0).take(pa.array(at)),
                     pa.array([blobs[i] for i in at.tolist()], pa.binary())], names=out.names)
                lo = hi

    got = rows.mapInArrow(sets, out)
    got._llm_path = wanted._llm_path  # to be dropped when the result is written
    return got


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SIMILAR * (len(a) + len(b) - both)


PAIRS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def confirmed(pairs: DataFrame, docs: DataFrame, sketches: DataFrame, id_col: str,
              text_col: str) -> DataFrame:
    """The pairs (a, b) of nodes with their hub that hold on the full sets.

    Pairs of one b go in groups of ``GROUP`` so that its set travels once per
    group and no group grows with the data.
    """
    slot = F.xxhash64("a") % 65536
    width = pairs.groupBy("b").agg((F.ceil(F.count(F.lit(1)) / GROUP)).alias("parts"))
    pairs = write_once(pairs.join(width, "b").select(
        "a", "b", F.pmod(slot, F.col("parts")).alias("part")), "pairs")
    needs = (pairs.select(F.col("a").alias("node"), "b", "part")
             .union(pairs.select(F.col("b").alias("node"), "b", "part").distinct()))
    needs = needs.groupBy("node").agg(F.collect_list(F.struct("b", "part")).alias("uses"))
    sent = with_sets(needs, docs, sketches, id_col, text_col,
                     [T.StructField("b", T.LongType()), T.StructField("part", T.LongType())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, held, found = None, None, []
        for batch in batches:  # sorted: a group's hub comes before its members
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("b", "part", "node")]
            blobs = batch.column(batch.schema.get_field_index("shingles"))
            for i, (b, part, node) in enumerate(zip(*(c.to_pylist() for c in cols))):
                s = np.frombuffer(blobs[i].as_py(), np.uint64)
                if node == b:
                    hub, held = (b, part), s
                elif hub == (b, part) and similar(held, s):
                    found.append((node, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=PAIRS.names)
            found = []

    grouped = (sent.repartition("b", "part")
               .sortWithinPartitions("b", "part", (F.col("node") != F.col("b")), "node"))
    done = write_once(grouped.mapInArrow(check, PAIRS).distinct(), "links")
    drop_table(pairs)
    drop_table(sent)
    return done


def open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (key, node, root) of buckets that still hold several groups. Groups
    only grow, so a bucket that holds one is done for good."""
    at = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return at.join(several.select("key"), "key")


class Groups(dict):
    """Union-find over the groups of a block."""

    def find(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = self.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self[max(x, y)] = min(x, y)
        return x != y


def _by_block(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``names`` (the input is sorted by them)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        ids = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in names])
        cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            part = batch.slice(lo, hi - lo)
            if held and any(held[-1].column(held[-1].schema.get_field_index(c))[0]
                            != part.column(part.schema.get_field_index(c))[0] for c in names):
                yield pa.Table.from_batches(held)
                held = []
            if part.num_rows:
                held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def likely_in(tab: pa.Table, i: int, j: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(x, ys, estimates): members of a block that lie in different groups and may be
    linked, by sizes and packed signatures."""
    node, root, n, mine = (tab.column(c).to_numpy() for c in ("node", "root", "n", "mine"))
    sig = np.concatenate([c.flatten().to_numpy() for c in tab.column("sig").chunks]).reshape(-1, LONGS).view(np.uint64)
    left = np.arange(len(node)) if i == j else np.flatnonzero(mine == i)
    for x in left.tolist():
        y = np.arange(x + 1, len(node)) if i == j else np.flatnonzero(mine != mine[x])
        y = y[(root[y] != root[x]) & (node[y] != node[x])
              & (100 * np.minimum(n[y], n[x]) >= SIMILAR * np.maximum(n[y], n[x]))]
        if len(y):
            d = sig[y] ^ sig[x]
            z = d.copy()
            for s in range(1, B):
                z |= d >> np.uint64(s)
            agree = 1 - np.bitwise_count(z & _ONES).sum(axis=1) / K
            est = (agree - 2.0 ** -B) / (1 - 2.0 ** -B)
            if (ok := est >= FLOOR).any():
                yield x, y[ok], est[ok]


def _blocks(rows: DataFrame, by: str, parts: DataFrame) -> DataFrame:
    """Members of ``by`` dealt into ``parts`` and sent to the meetings (i, j),
    i <= j, of their part with every part."""
    rows = rows.join(parts, by)
    mine = F.pmod(F.xxhash64("node"), F.col("parts"))
    meetings = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda other: F.struct(
        F.least(other, mine).alias("i"), F.greatest(other, mine).alias("j")))
    return rows.withColumn("mine", mine).withColumn("meetings", meetings)


def forest(members: DataFrame, signatures: DataFrame) -> DataFrame:
    """(a, b): what holds together the members of open buckets that lie in different
    groups and pass the estimate. A block sends at most as many pairs as it has
    members, since only those that join something new go on."""
    parts = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    rows = _blocks(members.join(signatures, "node"), "key", parts)
    rows = rows.select("key", "node", "root", "n", "sig", "mine", F.explode("meetings").alias("m"))
    rows = rows.select("key", "m.i", "m.j", "mine", "node", "root", "n", "sig")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in _by_block(batches, ("key", "i", "j")):
            node, held, out = tab.column("node").to_numpy(), Groups(), []
            for x, ys, _ in likely_in(tab, tab.column("i")[0].as_py(), tab.column("j")[0].as_py()):
                out += [(int(node[x]), y) for y in node[ys].tolist() if held.join(int(node[x]), y)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)],
                                                 names=PAIRS.names)

    return (rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(compare, PAIRS).distinct())


def _intersections(sets: list[np.ndarray]):
    """A function (x, ys) -> sizes of the intersections of set x with sets ys: on rows
    of bits over the shingles that several sets hold, or set by set where that
    table would be large."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    known, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    if len(shared) * len(sets) > 8 * BITS_BYTES:
        return lambda x, ys: np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for y in ys], np.int64)
    column = np.full(len(known), -1)
    column[shared] = np.arange(len(shared))
    col = column[at]
    bits = np.zeros((len(sets), -(-len(shared) // 64) * 64), bool)
    bits[owner[col >= 0], col[col >= 0]] = True
    words = np.packbits(bits, axis=1).view(np.uint64)
    return lambda x, ys: np.bitwise_count(words[ys] & words[x]).sum(axis=1, dtype=np.int64)


def joining(members: DataFrame, signatures: DataFrame, roots: DataFrame, families: DataFrame, docs: DataFrame,
            sketches: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(a, b): links that join the groups of a family, confirmed on the full sets.

    A family's members go in parts (by number and by size of their sets) that meet
    pairwise, so a set travels once per part and not once per pair. A meeting confirms
    likely pairs, best estimate first, and skips those that are joined already.
    """
    rows = families.join(members.select("node", "root").distinct(), "node").join(signatures, "node")
    parts = rows.groupBy("family").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).alias("parts"))
    rows = write_once(_blocks(rows, "family", parts), "families")
    uses = rows.select("node", F.transform("meetings", lambda m: F.struct(
        "family", m["i"].alias("i"), m["j"].alias("j"), "mine", "root", "n", "sig")).alias("uses"))
    fields = [*(T.StructField(c, T.LongType()) for c in ("family", "i", "j", "mine", "root", "n")),
              T.StructField("sig", T.ArrayType(T.LongType()))]
    full = with_sets(uses, docs, sketches, id_col, text_col, fields)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in _by_block(batches, ("family", "i", "j")):
            node, root = (tab.column(c).to_numpy() for c in ("node", "root"))
            sets = [np.frombuffer(x, np.uint64) for x in tab.column("shingles").to_pylist()]
            size, held, out = np.array([len(s) for s in sets], np.int64), Groups(), []
            likely = list(likely_in(tab, tab.column("i")[0].as_py(), tab.column("j")[0].as_py()))
            if not likely:
                continue
            common = _intersections(sets)
            for x, ys, est in sorted(likely, key=lambda t: -t[2].max()):
                ys = ys[np.argsort(-est, kind="stable")]
                ys = ys[[held.find(int(root[y])) != held.find(int(root[x])) for y in ys.tolist()]]
                both = common(x, ys) if len(ys) else np.empty(0, np.int64)
                for y in ys[100 * both >= SIMILAR * (size[ys] + size[x] - both)].tolist():
                    if held.join(int(root[x]), int(root[y])):
                        out.append((int(node[x]), int(node[y])))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)],
                                             names=PAIRS.names)

    met = full.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "node")
    done = write_once(met.mapInArrow(confirm, PAIRS).distinct(), "links")
    drop_table(rows)
    drop_table(full)
    return done


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    return grouped(docs, id_col, text_col).drop("text_hash")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, columns as given, without all but one of each group: the
    one of the smallest id. Of rows with the same id and text one stays."""
    rows = write_once(grouped(docs, id_col, text_col).select(
        F.col(id_col).alias("_llm_id"), F.col("text_hash").alias("_llm_hash"), "kept"), "kept")
    gone = rows.where(~F.col("kept")).select("_llm_id", "_llm_hash").distinct()
    again = rows.where("kept and _llm_id is not null").groupBy("_llm_id", "_llm_hash").count().where("count > 1").drop("count")
    same = docs[id_col].eqNullSafe(F.col("_llm_id")) & F.xxhash64(docs[text_col]).eqNullSafe(F.col("_llm_hash"))
    few = lambda t: F.broadcast(t) if t.count() <= BROADCAST_IDS else t
    left = docs.join(few(gone), same, "left_anti")
    if not again.limit(1).count():
        return left
    again = few(again)
    same = left[id_col].eqNullSafe(F.col("_llm_id")) & F.xxhash64(left[text_col]).eqNullSafe(F.col("_llm_hash"))
    once = left.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
    return left.join(again, same, "left_anti").unionByName(once)


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``groups`` with the hash of the text, which tells rows of one id apart."""
    sketches = sketch(docs, id_col, text_col)
    members = sketches.where("node is not null").select(F.explode("bands").alias("key"), "node")
    signatures = sketches.where("node is not null").groupBy("node").agg(
        F.min("n_shingles").alias("n"), F.first("sig").alias("sig"))
    links = confirmed(star_pairs(members, signatures), docs, sketches, id_col, text_col)
    roots = components(links)
    # what lies in one bucket but in different groups: families of likely pairs
    still = write_once(open_members(members.distinct(), roots), "members")
    likely = write_once(forest(still, signatures), "likely")
    if likely.limit(1).count():
        families = components(likely)
        found = joining(still, signatures, roots, families.withColumnRenamed("root", "family"), docs, sketches,
                        id_col, text_col)
        old, before = roots, links
        roots = components(links.union(found))
        for done in (old, before, found, families):
            drop_table(done)
    else:
        drop_table(links)
    drop_table(still)
    drop_table(likely)
    # one row per node: its group, then the smallest id of the group
    nodes = sketches.where("node is not null").groupBy("node").agg(F.min("id").alias("id"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = nodes.groupBy("root").agg(F.min("id").alias("component_id"))
    named = write_once(nodes.join(firsts, "root").select("node", "component_id"), "named")
    drop_table(roots)
    rows = sketches.select("id", "text_hash", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(F.col("id").alias(id_col), "text_hash", "n_shingles", component.alias("component_id"),
                       component.eqNullSafe(F.col("id")).alias("kept"))
