"""Per-document sums over a corpus-wide vocabulary.

Many statistics of a text are sums, over its distinct pieces, of (times it
occurs) x (a value that belongs to the piece alone): tokens per pre-token,
log-probability per word. The value is wanted once per distinct piece of the
whole corpus, and the vocabulary grows with the corpus, so it is neither
broadcast nor collected. The join is laid out in blocks:

1. ``index``: each task cuts its documents into blocks of about
   ``block_bytes`` of text. A block writes its own vocabulary once, dealt into
   hash buckets, and per document the (piece number, frequency) list as packed
   gaps. One table in the shared folder; a frequent piece is one entry per
   block, not one per document, so there are no hot keys.
2. ``by_bucket``: the vocabularies meet by bucket. A function sees all pieces
   of a bucket from all blocks, works out the value of each distinct piece
   once, and sends the values back in the order of each block's pieces.
3. ``by_block``: values and frequency lists meet by block and are summed.

Rows keep their place inside a block, so repeated or null document ids come
out as often as they went in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import write_once

BLOCK_BYTES = 16 << 20
_GAP = 65535

INDEX_SCHEMA = T.StructType([
    T.StructField("block", T.LongType()),
    T.StructField("bucket", T.IntegerType()),    # -1: the frequency lists of the block
    T.StructField("pieces", T.BinaryType()),     # distinct pieces, "\n" after each
    T.StructField("marks", T.BinaryType()),      # what `mark` keeps of each piece (uint32)
    T.StructField("keys", T.BinaryType()),       # the documents' ids as an Arrow stream
    T.StructField("sizes", T.BinaryType()),      # packed list length of each document (uint32)
    T.StructField("gaps", T.BinaryType()),       # piece numbers as gaps (uint16)
    T.StructField("freqs", T.BinaryType()),      # frequencies (uint8)
    T.StructField("extra", T.BinaryType()),      # what `sequence` keeps of the block
])


class _Numbers(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def pack(numbers: np.ndarray, freqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted piece numbers and frequencies as uint16 gaps and uint8 counts.

    A wide gap is bridged by entries of frequency 0, a high frequency split
    over entries of gap 0; ``unpack`` needs no special case.
    """
    gaps = np.diff(numbers, prepend=0)
    if len(gaps) and (gaps.max() > _GAP or freqs.max() > 255):
        g, f = [], []
        for a, b in zip(gaps.tolist(), freqs.tolist()):
            while a > _GAP:
                g.append(_GAP)
                f.append(0)
                a -= _GAP
            g.append(a)
            f.append(min(b, 255))
            while (b := b - 255) > 0:
                g.append(0)
                f.append(min(b, 255))
        gaps, freqs = np.array(g), np.array(f)
    return gaps.astype(np.uint16), freqs.astype(np.uint8)


def unpack(sizes: bytes, gaps: bytes, freqs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, piece number, frequency) of every entry of a block."""
    n = np.frombuffer(sizes, np.uint32).astype(np.int64)
    run = np.cumsum(np.frombuffer(gaps, np.uint16), dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(n)))
    before = np.concatenate(([0], run))[starts[:-1]]  # gaps start anew in each document
    doc = np.repeat(np.arange(len(n)), n)
    return doc, run - before[doc], np.frombuffer(freqs, np.uint8).astype(np.int64)


def keys_bytes(column: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([column], ["key"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def keys_of(data: bytes) -> pa.Array:
    with pa.ipc.open_stream(pa.BufferReader(data)) as src:
        return src.read_all().column(0).combine_chunks()


def index(docs: DataFrame, id_col: str, text_col: str, split: Callable[[str], Counter],
          n_buckets: int, name: str, mark: Callable | None = None,
          sequence: Callable | None = None, as_bytes: bool = False,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write the block table (see the module text) and read it back.

    ``split(text)`` gives a Counter of pieces (no piece may hold a newline).
    ``mark(ids, lists, n)`` may add one number to each of the block's n pieces;
    lists holds (piece numbers, frequencies) per document.
    ``sequence(ids, texts)`` may keep bytes for the block.
    """
    src = docs.select(F.col(id_col).alias("key"),
                      F.col(text_col).cast("binary" if as_bytes else "string").alias("text"))

    def one_block(number: int, ids: list, texts: list, key_type) -> Iterator[dict]:
        numbers, lists = _Numbers(), []
        for text in texts:
            c = split(text) if text else Counter()
            lists.append((np.fromiter(map(numbers.__getitem__, c), np.int64, len(c)),
                          np.fromiter(c.values(), np.int64, len(c))))
        pieces = [p if as_bytes else p.encode() for p in numbers]
        bucket = np.fromiter((xxhash.xxh32_intdigest(p) % n_buckets for p in pieces),
                             np.int64, len(pieces))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        marks = None
        if mark is not None:
            marks = mark(ids, lists, len(numbers)).astype(np.uint32)[order]
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            yield {"block": number, "bucket": int(bucket[order[lo]]),
                   "pieces": b"".join(pieces[i] + b"\n" for i in order[lo:hi]),
                   "marks": marks[lo:hi].tobytes() if marks is not None else None}
        sizes, gaps, freqs = [], [], []
        for at, f in lists:
            at = place[at]
            o = np.argsort(at)
            g, q = pack(at[o], f[o])
            sizes.append(len(g))
            gaps.append(g.tobytes())
            freqs.append(q.tobytes())
        yield {"block": number, "bucket": -1, "keys": keys_bytes(pa.array(ids, key_type)),
               "sizes": np.array(sizes, np.uint32).tobytes(), "gaps": b"".join(gaps),
               "freqs": b"".join(freqs),
               "extra": sequence(ids, texts) if sequence is not None else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(INDEX_SCHEMA)
        number = TaskContext.get().partitionId() << 32
        ids, texts, held, kind = [], [], 0, None

        def flush():
            nonlocal ids, texts, held, number
            rows = list(one_block(number, ids, texts, kind))
            number += 1
            ids, texts, held = [], [], 0
            for k in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[k:k + 256], schema=schema)

        for batch in batches:
            kind = batch.schema.field(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                held += len(t) if t else 0
                if held >= block_bytes or len(ids) >= 65536:
                    yield from flush()
        if ids:
            yield from flush()

    return write_once(src.mapInArrow(run, INDEX_SCHEMA), name)


VALUE_SCHEMA = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("values", T.BinaryType())])


def by_bucket(table: DataFrame, value: Callable, n_buckets: int,
              total: Callable | None = None, kind: type = np.uint32) -> DataFrame:
    """Values of the pieces, worked out once per distinct piece of the corpus.

    ``value(pieces, marks, bucket)`` gets the distinct pieces of a bucket and the
    sum of their marks (None without marks) and returns whole numbers, kept as
    ``kind``; a number beyond it raises. The result has one row per (block,
    bucket): the values in the order of its pieces. ``total(pieces, marks, bucket)``
    may add bytes per bucket, in a row of block -1.
    """
    rows = table.where("bucket >= 0").select("block", "bucket", "pieces", "marks")

    def run(key, pdf):
        numbers, at, sums = _Numbers(), [], []
        for blob in pdf["pieces"]:
            at.append([numbers[p] for p in blob.split(b"\n")[:-1]])
        if pdf["marks"].notna().all():
            sums = np.zeros(len(numbers), np.int64)
            for i, m in zip(at, pdf["marks"]):  # a block names a piece once
                sums[i] += np.frombuffer(m, np.uint32)
        got = np.asarray(value(list(numbers), sums if len(sums) else None, key[0]), np.int64)
        if len(got) and not 0 <= int(got.min()) <= int(got.max()) <= np.iinfo(kind).max:
            raise OverflowError("a value of the vocabulary does not fit its kind")
        got = got.astype(kind)
        out = pdf[["block", "bucket"]].assign(values=[got[i].tobytes() for i in at])
        if total is not None:
            out.loc[len(out)] = [-1, key[0], total(list(numbers), sums, key[0])]
        return out

    return rows.repartition(n_buckets, "bucket").groupBy("bucket").applyInPandas(run, VALUE_SCHEMA)


def by_block(table: DataFrame, values: DataFrame, finish: Callable, schema: T.StructType,
             more: DataFrame | None = None, kind: type = np.uint32) -> DataFrame:
    """Meet values and frequency lists by block.

    ``finish(lists, values)`` gets the block's frequency row (a dict) and the
    values of its pieces (``kind``, in the order of their numbers), and returns
    a pandas frame. ``more`` (block, extra) takes the place of the block's own
    ``extra``.
    """
    left = table.where("bucket < 0").select("block", "keys", "sizes", "gaps", "freqs", "extra")
    if more is not None:
        left = left.drop("extra").join(more, "block", "left")

    def run(lists, vals):
        import pandas as pd
        if not len(lists):
            return pd.DataFrame({f.name: [] for f in schema})
        vals = vals.sort_values("bucket")  # the order of the piece numbers
        got = np.frombuffer(b"".join(vals["values"]), kind)
        return finish(lists.iloc[0].to_dict(), got)

    return left.groupBy("block").cogroup(values.groupBy("block")).applyInPandas(run, schema)


def bucket_count(docs: DataFrame) -> int:
    """Buckets follow the session's shuffle partitions, which follow the input."""
    return max(32, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
