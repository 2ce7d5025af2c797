"""Phrase collocations from an FM-index per shard over word ids.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends and
those into words; every count is per language. With ``least`` occurrences asked for:

1. ``shards``: each task numbers the words of about ``SHARD_BYTES`` of text and
   keeps the pieces as a run of word numbers (0 between pieces). Words are dealt
   into hash buckets, where the counts of all shards meet; a word that occurs
   often enough gets an id of its own. (``vocabulary.by_bucket``)
2. ``pairs``: a shard replaces all other words by 0 and builds the FM-index of
   the rest. Extending the interval of every word to the left lists the shard's
   two-word phrases with their counts. They are dealt into hash buckets, a row per
   shard and bucket, where the counts of all shards meet (``summed``); the shard
   gets back a bit for each of its pairs.
3. ``longer``: where two neighbours are no frequent pair no candidate passes, so
   the shard cuts its run there and keeps only what hangs together. On the index of
   the rest, and of its reverse, intervals are extended by turns (pairs to the
   left, then right, left, right; the interval of the other index moves along), which
   lists each phrase of three to five words once. Their counts meet like those of pairs.

Counts are whole at every step: a shard leaves out only what cannot occur
``least`` times anywhere. A phrase's extensions by one word on either side are rows
of the same table. The index is sorted by as many words as phrases may have, which
is as deep as any interval is ever extended.

Defined cases: null, empty and wordless texts have no word; a null language is
``und``; repeated rows count as often as they come; an empty table gives no
phrases; extra columns are not looked at. A document longer than a shard is cut
between pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocabulary as V
from .shared import drop_table, slices, write_once

WORDS, LEAST, FIRST = 5, 100, 2000
SHARD_BYTES = 6 << 20
UND = "und"

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if b in _BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


# -- the index ------------------------------------------------------------------

def depth_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of a cyclic text in the order of their next ``depth`` symbols."""
    rank, span = text.astype(np.int64), 1
    while span < depth:  # ranks by so many symbols, combined until deep enough
        step = min(span, depth - span)
        _, rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + np.roll(rank, -step), return_inverse=True)
        span += step
    return np.argsort(rank, kind="stable")


class FMIndex:
    """The symbols before each sorted place (BWT) and where they lead (LF)."""

    def __init__(self, text: np.ndarray, depth: int):
        self.bwt = text[depth_order(text, depth) - 1].astype(np.int64)
        self.lf = np.empty(len(text), np.int64)
        self.lf[np.argsort(self.bwt, kind="stable")] = np.arange(len(text))

    def extend(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of the intervals [lo, lo + size) by the symbol before
        them, but for 0: (interval, symbol, new lo, size, occurrences of smaller
        symbols, by which the interval in the reverse index moves)."""
        owner = np.repeat(np.arange(len(lo)), size)
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(len(owner))
        width = int(self.bwt.max(initial=0)) + 1
        key, first, count = np.unique(owner * width + self.bwt[at], return_index=True, return_counts=True)
        owner, symbol = key // width, key % width
        before = np.cumsum(count) - count
        smaller = before - (np.cumsum(size) - size)[owner]
        real = symbol > 0
        return owner[real], symbol[real], self.lf[at[first[real]]], count[real], smaller[real]


def words_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, lo, size) of the intervals of single symbols but 0."""
    size = np.bincount(text, minlength=1)
    lo = np.cumsum(size) - size
    at = np.flatnonzero(size[1:]) + 1
    return at, lo[at], size[at]


def pairs_in(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, count) of neighbouring symbols but 0."""
    symbol, lo, size = words_of(text)
    owner, before, _, count, _ = FMIndex(text, 1).extend(lo, size)
    return before, symbol[owner], count


def phrases_in(text: np.ndarray, depth: int = WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols, count) of the phrases of 3 to ``depth`` symbols without a 0, by
    extending on either side in turns."""
    ahead, back = FMIndex(text, depth), FMIndex(text[::-1], depth)
    symbol, lo, size = words_of(text)
    there, words = lo, symbol[:, None]  # a symbol's interval is the same in both
    for n in range(2, depth + 1):
        if n % 2 == 0:
            owner, symbol, lo, size, smaller = ahead.extend(lo, size)
            there = there[owner] + smaller
            words = np.column_stack((symbol, words[owner]))
        else:
            owner, symbol, there, size, smaller = back.extend(there, size)
            lo = lo[owner] + smaller
            words = np.column_stack((words[owner], symbol))
        if n > 2:
            yield words, size


def connected(text: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The text cut between places i and i + 1 where ``linked[i]`` is false,
    without symbols that are left alone; 0 first, between and last."""
    after = np.append(linked, False)
    keep = after | np.insert(linked, 0, False)
    out = np.stack((text, np.zeros_like(text)), axis=1)
    take = np.stack((keep, keep & ~after), axis=1)
    return np.insert(out[take], 0, 0)


# -- rows of numbers --------------------------------------------------------------

def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in few bytes: the first byte of each, then the second, and so on, as zstd."""
    planes = np.ascontiguousarray(numbers, np.int64).reshape(-1, 1).view(np.uint8).T
    return np.int64(numbers.size).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    planes = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(np.int64).ravel()


def bucket_of(columns: list[np.ndarray], n_buckets: int) -> np.ndarray:
    """The bucket of each row of word ids."""
    key = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        key = (key ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return (key % np.uint64(n_buckets)).astype(np.int64)


DEALT = T.StructType([
    T.StructField("block", T.LongType()),        # -1: of all shards
    T.StructField("bucket", T.IntegerType()),
    T.StructField("data", T.BinaryType())])      # columns of word ids and the counts; back in the shard a bit each


def dealt(block: int, columns: list[np.ndarray], n: np.ndarray, n_buckets: int) -> Iterator[dict]:
    """A shard's rows by bucket, in the order they have."""
    bucket = bucket_of(columns, n_buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
        at = order[lo:hi]
        yield {"block": block, "bucket": int(bucket[at[0]]), "data": packed(np.stack([*(c[at] for c in columns), n[at]]))}


def summed(rows: DataFrame, width: int, least: int, n_buckets: int, back: bool) -> DataFrame:
    """Rows of ``width`` word ids with ``least`` occurrences in all shards, by bucket (block
    -1); with ``back`` also which of its rows these are, for each shard and bucket."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        bucket = key[0].as_py()
        lists = [unpacked(x).reshape(width + 1, -1) for x in table.column("data").to_pylist()]
        ends = np.cumsum([x.shape[1] for x in lists])
        every = np.concatenate(lists, axis=1)
        del lists
        order = np.lexsort(every[:width])
        every = every[:, order]
        first = np.flatnonzero(np.append(True, (every[:width, 1:] != every[:width, :-1]).any(axis=0)))
        n = np.add.reduceat(every[width], first)
        often = n >= least
        out = [{"block": -1, "bucket": bucket,
                "data": packed(np.concatenate((every[:width, first[often]], n[None, often])))}] if often.any() else []
        if back:
            good = np.empty(len(order), bool)
            good[order] = np.repeat(often, np.diff(first, append=len(order)))
            out += [{"block": b, "bucket": bucket, "data": np.packbits(x).tobytes()}
                    for b, x in zip(table.column("block").to_pylist(), np.split(good, ends[:-1]))]
        return pa.Table.from_pylist(out, schema=to_arrow_schema(DEALT))

    return rows.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(run, DEALT)


def _counted(found: DataFrame, width: int) -> DataFrame:
    """(phrase, n) of the frequent rows, as arrays of word ids."""
    schema = T.StructType([T.StructField("phrase", T.ArrayType(T.LongType())), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                got = unpacked(data).reshape(width + 1, -1)
                ids = got[:width].T
                real = ids > 0
                ends = np.append(0, np.cumsum(real.sum(axis=1))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, ids[real]), pa.array(got[width])],
                                                 names=schema.names)

    return found.where("block = -1").select("data").mapInArrow(run, schema)


# -- the shards -----------------------------------------------------------------

SHARD = T.StructType([
    T.StructField("block", T.LongType()),
    T.StructField("bucket", T.IntegerType()),    # -1: the run of the shard, -2: words per language
    T.StructField("pieces", T.BinaryType()),     # language and word, "\n" after each
    T.StructField("marks", T.BinaryType()),      # occurrences of each (uint32)
    T.StructField("run", T.BinaryType())])       # word numbers from 1, 0 between pieces (packed)


class _Words(dict):
    """Numbers of the words of a language, drawn from a counter all share."""

    def __init__(self, names: list[bytes], lang: str):
        self.names, self.prefix = names, quote(lang).encode() + b" "
        self[b"\n"] = 0

    def __missing__(self, word: bytes) -> int:
        self.names.append(self.prefix + word)
        n = self[word] = len(self.names)
        return n


def parts_of(text: bytes, size: int) -> Iterator[bytes]:
    """A long text cut between pieces, at the first break after ``size`` bytes."""
    lo = 0
    while lo + size < len(text):
        hi = text.find(b"\n", lo + size)
        if hi < 0:
            break
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def shards(docs: DataFrame, lang_col: str, text_col: str, n_buckets: int,
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The shard table, written once."""
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UND)).alias("lang"),
                      F.col(text_col).cast("binary").alias("text")).where(F.octet_length("text") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(SHARD)
        block = TaskContext.get().partitionId() << 32
        names, langs, totals, runs, held = [], {}, {}, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, names, langs, totals, runs, held
            text = np.concatenate(runs)
            count = np.bincount(text, minlength=len(names) + 1)[1:]
            bucket = np.fromiter((xxhash.xxh32_intdigest(p) % n_buckets for p in names), np.int64, len(names))
            order = np.argsort(bucket, kind="stable")  # numbers follow the buckets
            place = np.zeros(len(names) + 1, np.int32)
            place[order + 1] = np.arange(1, len(names) + 1)
            rows = [{"block": block, "bucket": -1, "run": packed(place[text])}]
            for lang, n in totals.items():
                rows.append({"block": block, "bucket": -2, "pieces": quote(lang).encode(),
                             "marks": np.array([n], np.int64).tobytes()})
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
                rows.append({"block": block, "bucket": int(bucket[order[lo]]),
                             "pieces": b"".join(names[i] + b"\n" for i in order[lo:hi]),
                             "marks": count[order[lo:hi]].astype(np.uint32).tobytes()})
            block, names, langs, totals, runs, held = block + 1, [], {}, {}, [], 0
            for k in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[k:k + 256], schema=schema)

        for batch in batches:
            for part in slices(batch, 1):
                for lang, whole in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for text in parts_of(whole.translate(_TABLE), shard_bytes):
                        number = langs.get(lang)
                        if number is None:
                            number = langs[lang] = _Words(names, lang)
                        words = [w for w in text.replace(b"\n", b" \n ").split(b" ") if w]
                        words.append(b"\n")
                        got = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
                        totals[lang] = totals.get(lang, 0) + int(np.count_nonzero(got))
                        runs.append(got)
                        held += len(text)
                        if held >= shard_bytes:
                            yield from flush()
        if runs:
            yield from flush()

    return write_once(src.mapInArrow(run, SHARD), "shards")


def _frequent(n_buckets: int, least: int):
    """Ids (from 1, over all buckets; 0: too rare) of a bucket's words, and its
    frequent words in writing."""
    def value(pieces, counts, bucket):
        often = counts >= least
        return np.where(often, (np.cumsum(often) - 1) * n_buckets + bucket + 1, 0)

    def total(pieces, counts, bucket):
        often = np.flatnonzero(counts >= least)
        return b"".join([np.array([len(often), *counts[often]], np.int64).tobytes(),
                         *(pieces[i] + b"\n" for i in often)])

    return value, total


def _words_table(values: DataFrame, n_buckets: int) -> DataFrame:
    """(id, lang, word, n) of the frequent words."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("lang", T.StringType()),
                           T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = int(np.frombuffer(data, np.int64, 1)[0])
                counts = np.frombuffer(data, np.int64, n, 8)
                names = [p.rsplit(b" ", 1) for p in data[8 + 8 * n:].split(b"\n")[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n) * n_buckets + bucket + 1), pa.array([unquote(a.decode()) for a, _ in names], pa.string()),
                     pa.array([w.decode() for _, w in names], pa.string()), pa.array(counts)], names=schema.names)

    return values.where("block = -1").select("bucket", "values").mapInArrow(run, schema)


def _language_totals(table: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [unquote(x.decode()) for x in batch.column(0).to_pylist()]
            n = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n)], names=schema.names)

    return (table.where("bucket = -2").select("pieces", "marks").mapInArrow(run, schema)
            .groupBy("lang").agg(F.sum("n").alias("n")))


# -- pairs and longer phrases -----------------------------------------------------

INDEXED = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("ids", T.BinaryType()),   # id of each symbol from 1 (packed)
    T.StructField("text", T.BinaryType())])                                       # symbols (packed)


def pairs(table: DataFrame, values: DataFrame) -> DataFrame:
    """Per shard its text of frequent words with a neighbour, of which the pairs are
    listed, written once."""
    left = table.where("bucket = -1").select("block", "run")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(INDEXED)
        if not left.num_rows:
            return schema.empty_table()
        block, blob = left.column("block")[0].as_py(), left.column("run")[0].as_py()
        right = right.sort_by("bucket")  # the order of the word numbers
        ids = np.frombuffer(b"".join([np.zeros(1, np.uint64).tobytes(), *right.column("values").to_pylist()]), np.uint64)
        known, symbol = np.unique(ids.astype(np.int64), return_inverse=True)
        if known[0]:  # every word is frequent: 0 still parts the pieces
            known, symbol = np.insert(known, 0, 0), symbol + 1
        text = symbol[unpacked(blob)]
        text = connected(text, (text[:-1] > 0) & (text[1:] > 0))
        return pa.Table.from_pylist([{"block": block, "ids": packed(known), "text": packed(text)}], schema=schema)

    got = left.groupBy("block").cogroup(values.where("block >= 0").groupBy("block")).applyInArrow(run, INDEXED)
    return write_once(got, "pairs", 1)  # a shard a file: no task lists the pairs of several at once


def frequent_pairs(indexed: DataFrame, least: int, n_buckets: int) -> DataFrame:
    """The pairs with ``least`` occurrences and, for each shard, which of its pairs these are, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(DEALT)
        for batch in batches:
            for block, ids, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids = unpacked(ids)
                a, b, n = pairs_in(unpacked(text))
                rows = list(dealt(block, [ids[a], ids[b]], n, n_buckets))
                for k in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_pylist(rows[k:k + 256], schema=schema)

    rows = indexed.select("block", "ids", "text").mapInArrow(run, DEALT)
    return write_once(summed(rows, 2, least, n_buckets, True), "frequent-pairs")


def longer(indexed: DataFrame, frequent: DataFrame, words: int, least: int, n_buckets: int) -> DataFrame:
    """(phrase, n): phrases of three and more words with ``least`` occurrences, as
    arrays of word ids, given the frequent pairs."""
    left = indexed.select("block", "ids", "text")
    right = frequent.where("block >= 0")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(DEALT)
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        block, ids, text = (left.column(c)[0].as_py() for c in ("block", "ids", "text"))
        ids, text = unpacked(ids), unpacked(text)
        a, b, _ = pairs_in(text)
        bucket = bucket_of([ids[a], ids[b]], n_buckets)
        size = np.bincount(bucket, minlength=n_buckets)
        right = right.sort_by("bucket")  # the order in which the pairs were dealt
        bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=size[k])
                for k, x in zip(right.column("bucket").to_pylist(), right.column("data").to_pylist())]
        at = np.argsort(bucket, kind="stable")[np.concatenate(bits) > 0]
        if not len(at):
            return out.empty_table()
        good = np.sort(a[at] * len(ids) + b[at])
        here = text[:-1] * len(ids) + text[1:]
        at = np.minimum(np.searchsorted(good, here), len(good) - 1)
        text = connected(text, (good[at] == here) & (text[:-1] > 0) & (text[1:] > 0))
        used, text = np.unique(text, return_inverse=True)
        ids = ids[used]
        parts = [([ids[symbols[:, k]] if k < symbols.shape[1] else np.zeros(len(n), np.int64) for k in range(words)], n)
                 for symbols, n in phrases_in(text, words)]
        columns = [np.concatenate([c[k] for c, _ in parts]) for k in range(words)]
        n = np.concatenate([n for _, n in parts])
        return pa.Table.from_pylist(list(dealt(block, columns, n, n_buckets)), schema=out)

    got = left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, DEALT)
    return _counted(summed(got, words, least, n_buckets, False), words)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", words: int = WORDS,
                 least: int = LEAST, first: int = FIRST, shard_bytes: int = SHARD_BYTES,
                 n_buckets: int | None = None) -> DataFrame:
    """The best ``first`` phrases of each language: lang, rank, phrase, a (its
    occurrences), l and r (those of the parts of its weakest cut), n (words of the
    language), score, and left_most and right_most (occurrences of its most frequent
    extension by a word on that side, 0 if below ``least``)."""
    buckets = n_buckets or V.bucket_count(docs)
    table = shards(docs, lang_col, text_col, buckets, shard_bytes)
    value, total = _frequent(buckets, least)
    values = write_once(V.by_bucket(table.where("bucket >= 0"), value, buckets, total, np.uint64), "word-ids")
    vocabulary = write_once(_words_table(values, buckets), "words")
    totals = write_once(_language_totals(table), "languages")
    indexed = pairs(table, values)
    drop_table(table)
    drop_table(values)
    meet = max(1, buckets // 2)
    frequent = frequent_pairs(indexed, least, meet)
    one = vocabulary.select(F.array("id").alias("phrase"), "n")
    counts = one.unionByName(_counted(frequent, 2))
    if words > 2:
        counts = counts.unionByName(longer(indexed, frequent, words, least, meet))
    counts = write_once(counts, "phrases")
    drop_table(indexed)
    drop_table(frequent)
    return _ranked(counts, vocabulary, totals, first)


def _ranked(counts: DataFrame, vocabulary: DataFrame, totals: DataFrame, first: int) -> DataFrame:
    size = F.size("phrase")
    # a phrase goes if an extension by one word occurs as often (any longer one that
    # does contains such an extension)
    right = counts.where(size > 2).select(F.slice("phrase", 1, size - 1).alias("phrase"),
                                          F.col("n").alias("right_most"), F.lit(0).cast("long").alias("left_most"))
    left = counts.where(size > 2).select(F.slice("phrase", 2, size - 1).alias("phrase"),
                                         F.lit(0).cast("long").alias("right_most"), F.col("n").alias("left_most"))
    grown = right.unionByName(left).groupBy("phrase").agg(F.max("left_most").alias("left_most"),
                                                          F.max("right_most").alias("right_most"))
    mine = (counts.where(size > 1).withColumnRenamed("n", "a").join(grown, "phrase", "left")
            .fillna(0, ["left_most", "right_most"])
            .where(F.greatest("left_most", "right_most") < F.col("a")))
    cut = F.explode(F.sequence(F.lit(1), size - 1))
    cuts = mine.select("phrase", "a", "left_most", "right_most", cut.alias("k"))
    cuts = cuts.select("*", F.slice("phrase", F.lit(1), F.col("k")).alias("head"),
                       F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("rest"))
    part = lambda name, n: counts.select(F.col("phrase").alias(name), F.col("n").alias(n))
    languages = vocabulary.select(F.array("id").alias("one"), "lang").join(
        totals.withColumnRenamed("n", "n_lang"), "lang")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n_lang as decimal(17,0)))"
                   " div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))")
    scored = (cuts.join(part("head", "l"), "head").join(part("rest", "r"), "rest")
              .withColumn("one", F.slice("phrase", 1, 1)).join(languages, "one").withColumn("score", score))
    weakest = scored.groupBy("phrase", "lang", "a", "left_most", "right_most", F.col("n_lang").alias("n")).agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # in writing: only here do the words themselves come in
    spelled = (weakest.select("phrase", F.posexplode("phrase").alias("at", "id")).join(vocabulary.select("id", "word"), "id")
               .groupBy("phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))),
                                                               lambda x: x["word"]), " ").alias("text")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = weakest.join(spelled, "phrase").select(
        "lang", F.col("text").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"), "left_most", "right_most")
    return (rows.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= first)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left_most", "right_most"))
