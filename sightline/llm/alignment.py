"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers cut the same bytes. Offsets where tokens of both end cut the text
into groups, and every token of A is linked with every token of B in its group.

1. Both models begin a new token where a blank follows a character that is no
   white space, so such places cut a text into *chunks* that are tokenised and
   aligned by themselves, once per distinct chunk of a block.
2. Documents go in blocks of about ``BLOCK_BYTES``. A block is turned around:
   per id pair a compressed bitmap of its documents, in *planes*: plane j holds
   the documents whose number of links of that pair has bit j set. The OR of the
   planes is the pair's document bitmap and its popcount the number of documents;
   the popcounts weighted by 2^j give the number of links.
3. Blocks hold different documents, so the counts of a pair add up over blocks: one
   row per block and pair meets in Spark's aggregation, never one per document.
   The totals and the highest total of each A id come back to the block's pairs,
   and its postings hand them to the documents.

Defined cases: texts null, empty or not given back byte for byte by either model
have no tokens (zeros and an empty digest); ids may repeat or be null, each row
counts as a document; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import token_counts as TC
from .packing import ByteTokens, tokenizer_paths
from .shared import slices, write_once
from .vocabulary import keys_bytes, keys_of

BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 16_384
DENSE = 16      # a pair in more than one of so many documents is a row of bits

TOGETHER = 2048     # plain chunks tokenised in one call
LONG = 512          # characters of a chunk that goes by itself
CROSS = 4096        # links of a group that are listed one by one
KNOWN = 300_000     # chunks kept from block to block

_CUT = re.compile(r"(?<=\S)(?= )")
_LOOSE = re.compile(r"\s ")
# a blank, then characters on which the libraries agree, lines only inside
_PLAIN = re.compile(r" [!-~¡-ɏ]+(?:\n+[!-~¡-ɏ]+)*")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


# -- the two tokenizers -------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """Letter of the byte-level alphabet -> byte: printable bytes stand for
    themselves, the others take letters from 256 on, in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Pair:
    """Both tokenizers, with the bytes of each of their ids."""

    def __init__(self, paths: tuple[str, str, str]):
        self.a = ByteTokens(*paths[:2])
        self.a.full.encode_special_tokens = True
        self.b = TC.load(paths[2])
        letters = _byte_letters()
        special = {i: t.content for i, t in self.a.full.get_added_tokens_decoder().items()}
        self.a_bytes = [special[i].encode() if i in special else
                        bytes(letters[c] for c in self.a.full.id_to_token(i))
                        for i in range(self.a.full.get_vocab_size())]
        self.b_bytes = []
        for i in range(len(self.b)):
            p = self.b.id_to_piece(i)
            m = _BYTE.fullmatch(p) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(m[1], 16)]) if m else p.replace(TC.BLANK, " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # how an id is written: inside its side of a group, and at the end of it
        self.written = [f"{i}{end}" for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
                        for i in range(n) for end in ends]

    def encode(self, text: str, plain: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a text that begins with a blank; None where a model
        does not give its bytes back."""
        a = self.a.fast.encode_ordinary(text) if plain else np.frombuffer(self.a.whole(text), "<u4").tolist()
        b = self.b.encode(text[1:], num_threads=1) if len(text) > 1 else [self.b.piece_to_id(TC.BLANK)]
        raw = text.encode()
        if (b"".join(map(self.a_bytes.__getitem__, a)) != raw
                or b"".join(map(self.b_bytes.__getitem__, b)) != raw):
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


_LOADED: dict[tuple, Pair] = {}


def pair_of(paths: tuple[str, str, str]) -> Pair:
    if paths not in _LOADED:
        _LOADED[paths] = Pair(paths)
    return _LOADED[paths]


def chunks_of(text: str) -> list[str]:
    """The blank and the text, cut where both tokenizers begin anew."""
    parts = text.split(" ")
    if "" not in parts and not _LOOSE.search(text):  # every blank stands alone
        return [" " + p for p in parts]
    return _CUT.split(" " + text)


def _ramp(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Chunks:
    """Distinct chunks, numbered, with their alignment."""

    def __init__(self, tools: Pair):
        self.tools, self.number, self.fresh = tools, {}, []
        self.fine: list[bool] = []
        self.text: list[str] = []                # groups in writing, ";" after each
        self.sizes: list[np.ndarray] = []        # n_a, n_b, n_groups of each chunk
        self.pairs: list[np.ndarray] = []        # a << 32 | b of its links
        self.times: list[np.ndarray] = []
        self.widths: list[np.ndarray] = []       # entries of `pairs` of each chunk

    def numbers(self, text: str | None) -> np.ndarray:
        """Chunk numbers of a text, in order; new chunks wait for ``align``."""
        if not text:
            return np.empty(0, np.int64)
        chunks, number = chunks_of(text), self.number
        for c in chunks:
            if c not in number:
                number[c] = len(number)
                self.fresh.append(c)
        return np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))

    def align(self) -> None:
        """Align what is new: plain chunks together, ``TOGETHER`` at a time (their
        ends are token ends of both), the others one by one. Numbers keep the
        order of `fresh`."""
        run: list[str] = []
        for c in self.fresh:
            if len(c) > LONG or not _PLAIN.fullmatch(c):
                self._together(run)
                run = []
                self._add([c], self.tools.encode(c, False))
            else:
                run.append(c)
                if len(run) >= TOGETHER:
                    self._together(run)
                    run = []
        self._together(run)
        self.fresh = []

    def _together(self, run: list[str]) -> None:
        if run:
            got = self.tools.encode("".join(run), True)
            if got is None:
                for c in run:
                    self._add([c], self.tools.encode(c, False))
            else:
                self._add(run, got)

    def _add(self, chunks: list[str], ids: tuple[np.ndarray, np.ndarray] | None) -> None:
        n = len(chunks)
        self.fine += [ids is not None] * n
        if ids is None:
            self.text += [""] * n
            self.sizes.append(np.zeros((n, 3), np.int64))
            self.widths.append(np.zeros(n, np.int64))
            return
        tools, (a, b) = self.tools, ids
        end_a, end_b = np.cumsum(tools.a_sizes[a]), np.cumsum(tools.b_sizes[b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)   # group of each token
        n_a, n_b = np.bincount(of_a, minlength=len(both)), np.bincount(of_b, minlength=len(both))
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        chunk = np.searchsorted(np.cumsum([len(c.encode()) for c in chunks]), both)  # of each group
        self.sizes.append(np.stack([np.bincount(chunk, w, n) for w in (n_a, n_b, np.ones(len(both)))], axis=1).astype(np.int64))
        # links: the tokens of a group cross; a large group by distinct ids, whose counts multiply
        small = n_a * n_b <= CROSS
        first = np.flatnonzero(small[of_a])
        wide = n_b[of_a[first]]
        second = np.repeat((stop_b - n_b)[of_a[first]], wide) + _ramp(wide)
        pair, owner = np.repeat(a[first], wide) << 32 | b[second], np.repeat(chunk[of_a[first]], wide)
        times = np.ones(len(pair), np.int64)
        for g in np.flatnonzero(~small).tolist():
            x, k = np.unique(a[stop_a[g] - n_a[g]:stop_a[g]], return_counts=True)
            y, m = np.unique(b[stop_b[g] - n_b[g]:stop_b[g]], return_counts=True)
            pair = np.concatenate((pair, (x[:, None] << 32 | y).ravel()))
            times = np.concatenate((times, np.multiply.outer(k, m).ravel()))
            owner = np.concatenate((owner, np.full(len(x) * len(y), chunk[g])))
        if len(both) and not small.all():
            order = np.argsort(owner, kind="stable")
            pair, times, owner = pair[order], times[order], owner[order]
        self.pairs.append(pair)
        self.times.append(times)
        self.widths.append(np.bincount(owner, minlength=n))
        # in writing: a group's tokens of A, then those of B
        code = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.diff(of_a, append=-1) != 0, np.diff(of_b, append=-1) != 0
        code[np.arange(len(a)) + (stop_b - n_b)[of_a]] = 2 * a + last_a
        code[np.arange(len(b)) + stop_a[of_b]] = 2 * (len(tools.a_bytes) + b) + last_b
        words = list(map(tools.written.__getitem__, code.tolist()))
        ends = np.cumsum(self.sizes[-1][:, :2].sum(axis=1)).tolist()
        self.text += ["".join(words[lo:hi]) for lo, hi in zip([0, *ends], ends)]


# -- bitmaps ------------------------------------------------------------------------

class PairBitmaps:
    """Postings of pairs in a block of documents: planes of compressed bitmaps.

    A plane keeps a pair's documents as sorted uint16 numbers, or as a row of
    bits where the pair is in more than one of ``DENSE`` documents.
    """

    def __init__(self, n_docs: int, n_pairs: int, planes: list[tuple]):
        self.n_docs, self.n_pairs, self.planes = n_docs, n_pairs, planes

    @classmethod
    def of(cls, pair: np.ndarray, doc: np.ndarray, times: np.ndarray, n_docs: int, n_pairs: int) -> PairBitmaps:
        """From postings sorted by (pair, doc), each once, times > 0."""
        planes = []
        for j in range(int(times.max(initial=0)).bit_length()):
            on = (times >> j) & 1 == 1
            p, d = pair[on], doc[on]
            size = np.bincount(p, minlength=n_pairs)
            dense = np.flatnonzero(size * DENSE > max(n_docs, 256))
            row = np.full(n_pairs, -1)
            row[dense] = np.arange(len(dense))
            thick = row[p] >= 0
            bits = np.zeros((len(dense), n_docs), bool)
            bits[row[p[thick]], d[thick]] = True
            size[dense] = 0
            planes.append((size.astype(np.uint32), d[~thick].astype(np.uint16), dense.astype(np.uint32),
                           np.packbits(bits, axis=1)))
        return cls(n_docs, n_pairs, planes)

    def _plane(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """(pair, doc) of a plane, sorted."""
        size, docs, dense, bits = self.planes[j]
        row, at = np.nonzero(np.unpackbits(bits, axis=1, count=self.n_docs)) if len(dense) else (
            np.empty(0, np.int64), np.empty(0, np.int64))
        pair = np.concatenate((np.repeat(np.arange(self.n_pairs), size), dense.astype(np.int64)[row]))
        doc = np.concatenate((docs.astype(np.int64), at))
        order = np.argsort(pair * self.n_docs + doc, kind="stable")
        return pair[order], doc[order]

    def links(self) -> np.ndarray:
        """Links per pair: the planes' popcounts, weighted."""
        out = np.zeros(self.n_pairs, np.int64)
        for j, (size, _, dense, bits) in enumerate(self.planes):
            out += size.astype(np.int64) << j
            out[dense] += np.bitwise_count(bits).sum(axis=1, dtype=np.int64) << j
        return out

    def documents(self) -> np.ndarray:
        """Documents per pair: popcount of the OR of its planes."""
        pair, _, _ = self.postings()
        return np.bincount(pair, minlength=self.n_pairs)

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, doc, links), sorted: the OR of the planes with its links."""
        got = [self._plane(j) for j in range(len(self.planes))]
        keys = np.concatenate([p * self.n_docs + d for p, d in got] or [np.empty(0, np.int64)])
        times = np.repeat(1 << np.arange(len(got)), [len(p) for p, _ in got])
        merged, at = np.unique(keys, return_inverse=True)
        links = np.bincount(at, times, len(merged)).astype(np.int64)
        width = max(1, self.n_docs)
        return merged // width, merged % width, links

    def dump(self) -> bytes:
        parts = [np.array([self.n_docs, self.n_pairs, len(self.planes)], np.int64).tobytes()]
        for size, docs, dense, bits in self.planes:
            parts += [np.array([len(docs), len(dense)], np.int64).tobytes(), size.tobytes(), docs.tobytes(),
                      dense.tobytes(), bits.tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, data: bytes) -> PairBitmaps:
        at = 0

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        n_docs, n_pairs, n_planes = take(np.int64, 3).tolist()
        planes = []
        for _ in range(n_planes):
            n, k = take(np.int64, 2).tolist()
            planes.append((take(np.uint32, n_pairs), take(np.uint16, n), take(np.uint32, k),
                           take(np.uint8, k * -(-n_docs // 8)).reshape(k, -(-n_docs // 8))))
        return cls(n_docs, n_pairs, planes)


# -- the jobs -------------------------------------------------------------------------

BLOCK = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("pairs", T.BinaryType()),    # a << 32 | b, sorted
    T.StructField("counts", T.BinaryType()),     # documents of each pair (int64)
    T.StructField("bitmaps", T.BinaryType()), T.StructField("keys", T.BinaryType()),
    T.StructField("sizes", T.BinaryType()),      # n_a, n_b, n_groups, n_links of each document (int64)
    T.StructField("digests", T.BinaryType())])   # sha256 of each document's groups (32 bytes; zeros: no tokens)


def block_row(number: int, chunks: Chunks, ids: pa.Array, lists: list[np.ndarray]) -> dict:
    """A block of documents (chunk numbers of each) turned around."""
    n = len(lists)
    fine = np.array(chunks.fine, bool)
    lists = [x if len(x) and fine[x].all() else x[:0] for x in lists]
    doc = np.repeat(np.arange(n), [len(x) for x in lists])
    chunk = np.concatenate([*lists, np.empty(0, np.int64)]).astype(np.int64)
    each = np.concatenate([*chunks.sizes, np.empty((0, 3), np.int64)])
    sizes = np.zeros((n, 4), np.int64)
    for k in range(3):
        sizes[:, k] = np.bincount(doc, each[chunk, k], n)
    text = chunks.text
    digests = b"".join(hashlib.sha256("".join([text[c] for c in x.tolist()])[:-1].encode()).digest()
                       if len(x) else bytes(32) for x in lists)
    # (document, chunk) once with its frequency, then the chunk's pairs
    spot, freq = np.unique(doc * max(1, len(fine)) + chunk, return_counts=True)
    doc, chunk = spot // max(1, len(fine)), spot % max(1, len(fine))
    width = np.concatenate([*chunks.widths, np.empty(0, np.int64)]).astype(np.int64)
    starts = np.cumsum(width) - width
    take = np.repeat(starts[chunk], width[chunk]) + _ramp(width[chunk])
    pairs, at = np.unique(np.concatenate([*chunks.pairs, np.empty(0, np.int64)])[take], return_inverse=True)
    times = np.concatenate([*chunks.times, np.empty(0, np.int64)])[take].astype(np.int64)
    key, inverse = np.unique(at * n + np.repeat(doc, width[chunk]), return_inverse=True)
    links = np.zeros(len(key), np.int64)
    np.add.at(links, inverse, times * np.repeat(freq, width[chunk]))
    pair, doc = key // max(1, n), key % max(1, n)
    np.add.at(sizes[:, 3], doc, links)
    maps = PairBitmaps.of(pair, doc, links, n, len(pairs))
    return {"block": number, "pairs": pairs.astype(np.int64).tobytes(),
            "counts": maps.documents().astype(np.int64).tobytes(), "bitmaps": maps.dump(),
            "keys": keys_bytes(ids), "sizes": sizes.tobytes(), "digests": digests}


def paths_of() -> tuple[str, str, str]:
    return (*tokenizer_paths(), TC.model_path())


def blocks(docs: DataFrame, id_col: str, text_col: str, paths: tuple[str, str, str],
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The block table, written once."""
    src = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema, tools = to_arrow_schema(BLOCK), pair_of(paths)
        number, held, ids, lists, chunks = TaskContext.get().partitionId() << 32, 0, [], [], Chunks(tools)

        def flush() -> pa.RecordBatch:
            nonlocal number, held, ids, lists, chunks
            chunks.align()
            row = block_row(number, chunks, pa.concat_arrays(ids), lists)
            number, held, ids, lists = number + 1, 0, [], []
            if len(chunks.number) > KNOWN:
                chunks = Chunks(tools)
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for part in slices(batch, 1, rows=512, size=1 << 20):
                ids.append(part.column(0))
                lists += map(chunks.numbers, part.column(1).to_pylist())
                held += part.column(1).nbytes
                if held >= block_bytes or len(lists) >= BLOCK_ROWS:
                    yield flush()
        if lists:
            yield flush()

    return write_once(src.mapInArrow(run, BLOCK), "alignment")


def _rows(table: DataFrame, with_counts: bool) -> DataFrame:
    """(block, pair, n) of the blocks' pairs; without counts (block, pair)."""
    fields = [T.StructField("block", T.LongType()), T.StructField("pair", T.LongType())]
    schema = T.StructType([*fields, T.StructField("n", T.LongType())] if with_counts else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, counts in zip(*(batch.column(k) for k in range(3))):
                pair = np.frombuffer(pairs.as_py(), np.int64)
                n = np.frombuffer(counts.as_py(), np.int64)
                for lo in range(0, len(pair), 65536):
                    p = pair[lo:lo + 65536]
                    cols = [np.full(len(p), block.as_py()), p, n[lo:lo + 65536]][:len(schema)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=schema.names)

    return table.select("block", "pairs", "counts").mapInArrow(run, schema)


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether its A id
    has no pair in more documents."""
    n = _rows(table, True).groupBy("pair").agg(F.sum("n").alias("n"))
    n = write_once(n.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    top = n.groupBy("a").agg(F.max("n").alias("top"))
    return n.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


RESULT = [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          paths: tuple[str, str, str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair is the most frequent of its A id), count_sum (over links) and
    groups_sha256."""
    table = blocks(docs, id_col, text_col, paths or paths_of(), block_bytes)
    valued = _rows(table, False).join(pair_counts(table), "pair")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *RESULT,
                           T.StructField("groups_sha256", T.StringType())])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        out = to_arrow_schema(schema)
        if not left.num_rows:
            return out.empty_table()
        row = left.to_pylist()[0]
        ids, pairs = keys_of(row["keys"]), np.frombuffer(row["pairs"], np.int64)
        sizes = np.frombuffer(row["sizes"], np.int64).reshape(-1, 4)
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        at = np.searchsorted(pairs, right.column("pair").to_numpy())
        count[at] = right.column("n").to_numpy()
        best[at] = right.column("best").to_numpy()
        pair, doc, links = PairBitmaps.load(row["bitmaps"]).postings()
        scores = np.zeros((2, len(ids)), np.int64)  # whole numbers: products may pass 2^53
        np.add.at(scores[0], doc, links * best[pair])
        np.add.at(scores[1], doc, links * count[pair])
        hexes = [row["digests"][k:k + 32].hex() if sizes[k // 32, 0] else "" for k in range(0, 32 * len(ids), 32)]
        return pa.Table.from_arrays([ids.cast(out.field(0).type), *(pa.array(c) for c in sizes.T),
                                     *(pa.array(c) for c in scores), pa.array(hexes, pa.string())], schema=out)

    return (table.select("block", "pairs", "bitmaps", "keys", "sizes", "digests").groupBy("block")
            .cogroup(valued.groupBy("block")).applyInArrow(finish, schema))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          paths: tuple[str, str, str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The corpus-wide table of linked id pairs: a, b, documents, links."""
    table = blocks(docs, id_col, text_col, paths or paths_of(), block_bytes)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "documents", "links")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, data in zip(batch.column(0), batch.column(1)):
                pair, maps = np.frombuffer(pairs.as_py(), np.int64), PairBitmaps.load(data.as_py())
                cols = [pair >> 32, pair & 0xFFFFFFFF, maps.documents(), maps.links()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=schema.names)

    got = table.select("pairs", "bitmaps").mapInArrow(run, schema)
    return got.groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
