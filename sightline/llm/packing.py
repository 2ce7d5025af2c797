"""Packing of tokenised documents into windows by non-negative least squares.

1. One pass tokenises each document once. Whole windows of a long document
   stand for themselves; its remainder (shorter than a window) is to be packed.
   Of a remainder only its length and checksums are kept: of all of it and of
   every ``grid`` tokens of it, so that any cut on the grid is known without
   reading the text again.
2. The histogram of remainder lengths (at most ``window`` - 1 numbers) goes to
   the driver. Shallow combinations of two and three lengths that fill a window
   exactly are the columns of a matrix; non-negative least squares finds how
   often to repeat each so that their sum comes nearest to the histogram. The
   counts are rounded down to what is there. What is left is packed greedily:
   largest first, then the largest that fits, and a gap that nothing fits is
   filled by cutting a document on the grid. The plan speaks of ranges of
   ranks within a length, so its size depends on the number of lengths, not of
   documents.
3. Ranks within a length come from per-task counts (no task sees a whole
   length), and each task looks up the plan for its own documents.

Only the very last windows are padded, by less than ``grid`` tokens elsewhere.

Defined cases: null and empty texts are the single end token; repeated rows and
ids are packed as often as they come; an empty table gives no pieces; extra
columns are not looked at.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import slices, write_once

WINDOW, GRID, END = 2048, 32, 1
MAX_COLUMNS = 20_000    # triples taken into the matrix: those that most documents could form
CACHE = 300_000         # distinct chunks a worker keeps ids of

_SPECIAL = "<|endoftext|>"  # the tokenizer's one special string
_SPECIAL_ID = 50256
# Characters on which both libraries are known to cut words alike.
_COMMON = re.compile(r"[\t\n\r -~¡-ɏ]*")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"))


class ByteTokens:
    """Ids of the byte-level tokenizer as little-endian uint32 bytes.

    A single blank between two other characters always begins a new pre-token,
    so the text is cut there and the ids of each chunk are worked out once.
    Usual characters go through the ranks of the same vocabulary (faster on
    short strings), all others through the tokenizer itself.
    """

    def __init__(self, json_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        outer = self

        class After(dict):  # chunk after a blank -> ids
            def __missing__(self, chunk):
                if len(self) >= CACHE:
                    self.clear()
                got = self[chunk] = outer.whole(" " + chunk)
                return got

        self.after = After()

    def whole(self, text: str) -> bytes:
        if _COMMON.fullmatch(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _SPECIAL in text:
            mark = np.array([_SPECIAL_ID], "<u4").tobytes()
            return mark.join(self.ids(part) for part in text.split(_SPECIAL))
        first, *rest = text.split(" ")
        if not first or "" in rest:  # runs of blanks belong together
            return self.whole(text)
        return self.whole(first) + b"".join(map(self.after.__getitem__, rest))


_LOADED: dict[tuple, ByteTokens] = {}


def tokens_of(paths: tuple[str, str]) -> ByteTokens:
    if paths not in _LOADED:
        _LOADED[paths] = ByteTokens(*paths)
    return _LOADED[paths]


def joined_crc(chunks: np.ndarray, sizes: list[int]) -> int:
    """Checksum of a run of bytes from the checksums of its chunks."""
    total = 0
    for crc, n in zip(chunks.tolist(), sizes):
        zeros = bytes(n)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


# ---------------------------------------------------------------------------
# The plan
# ---------------------------------------------------------------------------

def combinations(hist: np.ndarray, window: int, most: int = MAX_COLUMNS) -> list[tuple[int, ...]]:
    """Two or three present lengths that fill a window exactly."""
    have = np.flatnonzero(hist)
    pairs = [(window - b, b) for b in have.tolist() if 2 * b <= window and hist[window - b]]
    a, b = np.meshgrid(have, have, indexing="ij")
    c = window - a - b
    ok = (a >= b) & (b >= c) & (c > 0)
    a, b, c = a[ok], b[ok], c[ok]
    ok = hist[c] > 0
    a, b, c = a[ok], b[ok], c[ok]
    score = np.minimum(np.minimum(hist[a], hist[b]), hist[c])
    top = np.argsort(-score, kind="stable")[:most]
    return pairs + list(zip(a[top].tolist(), b[top].tolist(), c[top].tolist()))


def nnls(columns: list[tuple[int, ...]], hist: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that minimises |A x - hist|; A counts the lengths of a column.

    Multiplicative updates x <- x * (A'h) / (A'A x): they keep x non-negative
    and never raise the residual.
    """
    where = np.concatenate([np.array(c) for c in columns])
    col = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    h = hist.astype(float)
    up = np.bincount(col, h[where], len(columns))
    x = np.full(len(columns), h.sum() / max(1, len(where)))
    for _ in range(rounds):
        ax = np.bincount(where, x[col], len(h))
        x *= up / np.maximum(np.bincount(col, ax[where], len(columns)), 1e-12)
    return x


class _Pool:
    """Remainders by length, as ranges (length of the remainder, first rank,
    end rank, start inside the remainder)."""

    def __init__(self, hist: np.ndarray):
        self.count = hist.astype(np.int64).copy()
        self.ranges = {int(n): deque([(int(n), 0, int(hist[n]), 0)]) for n in np.flatnonzero(hist)}

    def take(self, length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        self.count[length] -= n
        queue = self.ranges[length]
        while n:
            whole, lo, hi, start = queue[0]
            k = min(n, hi - lo)
            yield whole, lo, lo + k, start
            n -= k
            if lo + k == hi:
                queue.popleft()
            else:
                queue[0] = (whole, lo + k, hi, start)

    def add(self, length: int, part: tuple[int, int, int, int]) -> None:
        self.count[length] += part[2] - part[1]
        self.ranges.setdefault(length, deque()).append(part)

    def largest(self, at_most: int) -> int:
        have = np.flatnonzero(self.count[:at_most + 1])
        return int(have[-1]) if len(have) else 0


def plan(hist: np.ndarray, window: int = WINDOW, grid: int = GRID) -> np.ndarray:
    """Rows (remainder length, first rank, end rank, start, length, first
    sequence, offset): the pieces of the remainders with these ranks."""
    pool, rows, sequence = _Pool(hist), [], 0

    def put(parts, length, first, offset):
        for whole, lo, hi, start in parts:
            rows.append((whole, lo, hi, start, length, first, offset))
            first += hi - lo

    def fill(lengths: list[int], n: int, cut: tuple[int, int] | None = None) -> None:
        nonlocal sequence
        offset = 0
        for length in lengths:
            put(list(pool.take(length, n)), length, sequence, offset)
            offset += length
        if cut:  # the head of a longer remainder, its tail goes back
            length, head = cut
            parts = list(pool.take(length, n))
            put(parts, head, sequence, offset)
            for whole, lo, hi, start in parts:
                pool.add(length - head, (whole, lo, hi, start + head))
        sequence += n

    columns = combinations(hist, window)
    if columns:
        x = nnls(columns, hist)
        for k in np.argsort(-x, kind="stable").tolist():
            need = np.bincount(columns[k], minlength=len(hist))
            n = min(int(x[k]), *(int(pool.count[v] // need[v]) for v in set(columns[k])))
            if n:
                fill(list(columns[k]), n)
    while (length := pool.largest(window)):  # what is left, largest first
        lengths, gap = [length], window - length
        used = {length: 1}
        while gap:
            fits = gap
            while (fits := pool.largest(fits)) and pool.count[fits] <= used.get(fits, 0):
                fits -= 1
            if not fits:
                break
            lengths.append(fits)
            used[fits] = used.get(fits, 0) + 1
            gap -= fits
        cut = None
        if gap >= grid:
            longer = window
            while (longer := pool.largest(longer)) > gap and pool.count[longer] <= used.get(longer, 0):
                longer -= 1
            if longer > gap:
                cut = (longer, gap // grid * grid)
                used[longer] = used.get(longer, 0) + 1
        fill(lengths, min(int(pool.count[v] // k) for v, k in used.items()), cut)
    return np.array(rows, np.int64).reshape(-1, 7)


# ---------------------------------------------------------------------------
# The jobs
# ---------------------------------------------------------------------------

def lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            window: int = WINDOW, grid: int = GRID, end: int = END,
            paths: tuple[str, str] | None = None) -> DataFrame:
    """Tokenise once: number of ids and checksums per document (written)."""
    paths = paths or tokenizer_paths()
    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("task", T.LongType()), T.StructField("place", T.LongType()),
        src.schema[0], T.StructField("n", T.LongType()),
        T.StructField("full", T.BinaryType()), T.StructField("crc", T.LongType()),
        T.StructField("grid", T.BinaryType())])
    kinds = [pa.int64(), pa.int64(), None, pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place, tk = TaskContext.get().partitionId(), 0, tokens_of(paths)
        for batch in (p for whole in batches for p in slices(whole, 1)):
            n, full, crc, parts = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = memoryview(tk.ids(text) + tail)
                cut = len(ids) // (4 * window) * 4 * window
                n.append(len(ids) // 4)
                full.append(np.array([zlib.crc32(ids[k:k + 4 * window])
                                      for k in range(0, cut, 4 * window)], np.uint32).tobytes())
                crc.append(zlib.crc32(ids[cut:]))
                parts.append(np.array([zlib.crc32(ids[k:k + 4 * grid])
                                       for k in range(cut, len(ids), 4 * grid)], np.uint32).tobytes())
            at = np.arange(place, place + len(n))
            place += len(n)
            cols = [np.full(len(n), task), at, batch.column(0), n, full, crc, parts]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kinds)],
                names=schema.names)

    return write_once(src.mapInArrow(run, schema), "lengths")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         grid: int = GRID, end: int = END, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    table = lengths(docs, id_col, text_col, window, grid, end, paths)
    rest = (F.col("n") % window).cast("int")
    counts = table.groupBy("task", rest.alias("rest")).agg(F.count(F.lit(1)).alias("here"))
    hist = np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("here").alias("n")).collect():  # at most `window` rows
        hist[r["rest"]] = r["n"]
    hist[0] = 0
    rows = plan(hist, window, grid)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    shared = docs.sparkSession.sparkContext.broadcast(rows)  # bounded by lengths, not documents
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("task", "rest", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("first"))
    schema = T.StructType([
        T.StructField(id_col, table.schema["key"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])

    def run(mine: pa.Table, firsts: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(schema)
        if not mine.num_rows:
            return out.empty_table()
        return pieces(mine.sort_by("place"), firsts, shared.value, window, grid).rename_columns(schema.names).cast(out)

    return table.groupBy("task").cogroup(ranks.groupBy("task")).applyInArrow(run, schema)


def pieces(mine: pa.Table, firsts: pa.Table, rows: np.ndarray, window: int, grid: int) -> pa.Table:
    """The pieces of one task's documents. Ids stay Arrow values throughout: a
    null among them must not turn large ones into floats."""
    n = mine.column("n").to_numpy()
    rest = n % window
    # whole windows: sequences of their own, numbered within the task
    k = n // window
    doc = np.repeat(np.arange(len(n)), k)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
    task = mine.column("task")[0].as_py()
    parts = [(doc, nth * window, np.full(len(doc), window),
              np.frombuffer(b"".join(mine.column("full").to_pylist()), np.uint32).astype(np.int64),
              ((task + 1) << 32) + np.arange(len(doc)), np.zeros(len(doc), np.int64))]
    # remainders: rank within the length, then the plan's ranges
    first = np.zeros(window, np.int64)
    first[firsts.column("rest").to_numpy()] = firsts.column("first").to_numpy()
    order = np.argsort(rest, kind="stable")
    sizes = np.bincount(rest, minlength=window)
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n)) - (np.cumsum(sizes) - sizes)[rest[order]]
    rank += first[rest]
    crc, grids = mine.column("crc").to_numpy(), mine.column("grid").to_pylist()
    out = []
    bounds = np.searchsorted(rows[:, 0], np.arange(window + 1))
    for length in np.flatnonzero(sizes[1:]) + 1:
        block = rows[bounds[length]:bounds[length + 1]]
        who = np.flatnonzero(rest == length)
        who = who[np.argsort(rank[who])]
        lo = np.searchsorted(rank[who], block[:, 1])
        hi = np.searchsorted(rank[who], block[:, 2])
        for (whole, a, _, start, size, sequence, offset), i, j in zip(block.tolist(), lo, hi):
            for d in who[i:j].tolist():
                if size == whole:
                    c = int(crc[d])
                else:
                    got = np.frombuffer(grids[d], np.uint32)[start // grid:-(-(start + size) // grid)]
                    c = joined_crc(got, [4 * min(grid, size - g) for g in range(0, size, grid)])
                out.append((d, n[d] - whole + start, size, c, sequence + rank[d] - a, offset))
    if out:
        parts.append(tuple(np.array(c, np.int64) for c in zip(*out)))
    doc, start, size, crcs, sequence, offset = (np.concatenate(c) for c in zip(*parts))
    key = mine.column("key").combine_chunks().take(pa.array(doc))
    return pa.table([key, *(pa.array(c) for c in (start, size, crcs, n[doc], sequence, offset))],
                    names=["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
