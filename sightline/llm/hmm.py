"""Hidden Markov language model, trained by Baum-Welch over partitions.

A text is a sequence of tokens: its words and one end. The latent states emit
word *classes* (a short word by its hash, a longer one by the hash of its
ending, the end by itself), and a class emits its words by their corpus
counts:

    P(text) = sum over state paths of  prod A(s, s') * E(s', class(w)) * P(w | class(w))
    P(w | class) = (c(w) + 0.5) / (N_class + 0.5 * (V_class + 1))

so the model has a parameter per word of the corpus (the counts, which grow
with it), while what Baum-Welch re-estimates (``STATES`` x ``CLASSES``) is
small enough to broadcast. Every training text takes part in every iteration:
each partition runs scaled forward-backward over its sequences and sends
expected counts, which Spark sums by class. For training, a text is cut into
sequences of ``SEGMENT`` tokens (continuing ones have their own start
distribution); scores come from the exact scaled forward recursion over the
whole text. The factor P(w | class) needs no order, so it is a sum over the
vocabulary (module ``vocabulary``).

Defined cases: a null, empty or blank text is the end token alone; rows with a
null id are scored but not learned from; repeated rows count as often as they
come; without any training row the counts are 0 and the formulas hold as they
stand (N = V = 0); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocabulary as V
from .shared import blank_words, write_once

STATES, ROUNDS, SEGMENT = 8, 8, 64
HALF = 2048
END = 2 * HALF
CLASSES = END + 1
PRIOR = 0.05      # added to every expected emission count
BATCH = 8192      # sequences in step


def word_class(word: bytes) -> int:
    return zlib.crc32(word) % HALF if len(word) <= 4 else HALF + zlib.crc32(word[-3:]) % HALF


class _Classes(dict):
    def __missing__(self, word):
        got = self[word] = word_class(word)
        return got


def training(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 1


@dataclass
class Chain:
    first: np.ndarray   # (states,) at the start of a text
    later: np.ndarray   # (states,) at the start of a continuing sequence
    move: np.ndarray    # (states, states)
    emit: np.ndarray    # (classes, states): columns sum to 1

    def single(self) -> Chain:
        """In single precision: the recursions are scaled at every step."""
        return Chain(*(x.astype(np.float32) for x in (self.first, self.later, self.move, self.emit)))

    @classmethod
    def start(cls, states: int = STATES, seed: int = 5) -> Chain:
        rng = np.random.default_rng(seed)
        emit = rng.gamma(2.0, size=(CLASSES, states))
        move = np.full((states, states), 1.0) + 4 * states * np.eye(states) * 0.25
        even = np.full(states, 1 / states)
        return cls(even, even, move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def log_probability(self, seqs: list[np.ndarray]) -> np.ndarray:
        """log10 P of whole class sequences (each of one token at least), by
        the scaled forward recursion, in step over the sequences."""
        order = np.argsort([-len(s) for s in seqs], kind="stable")
        sizes = np.array([len(seqs[i]) for i in order])
        flat = np.concatenate([seqs[i] for i in order]).astype(np.int64)
        at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        total = np.zeros(len(seqs))
        state = self.first * self.emit[flat[at]]
        active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
        for t in range(1, int(sizes[0])):
            n = int(active[t])
            if n < len(state):
                total[n:len(state)] += np.log(state[n:].sum(axis=1))
                state = state[:n]
            state = (state @ self.move) * self.emit[flat[at[:n] + t]]
            if t % 8 == 0:  # scale before the product gets small
                s = state.sum(axis=1)
                total[:n] += np.log(s)
                state /= s[:, None]
        total[:len(state)] += np.log(state.sum(axis=1))
        out = np.empty(len(seqs))
        out[order] = total / np.log(10)
        return out

    def expect(self, seqs: np.ndarray, sizes: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, ...]:
        """Expected counts (first, later, move, emit) of sequences sorted from
        long to short: seqs (n, length) padded, opens: begins its text."""
        n, length = seqs.shape
        k = len(self.first)
        active = [int((sizes > t).sum()) for t in range(length)]
        alpha, scale = np.zeros((length, n, k), self.emit.dtype), np.ones((length, n), self.emit.dtype)
        a = np.where(opens[:, None], self.first, self.later) * self.emit[seqs[:, 0]]
        for t in range(length):
            m = active[t]
            if t:
                a = (a[:m] @ self.move) * self.emit[seqs[:m, t]]
            s = a.sum(axis=1)
            a = a / s[:, None]
            alpha[t, :m], scale[t, :m] = a, s
        beta, move = np.ones((n, k), self.emit.dtype), np.zeros((k, k))
        for t in range(length - 2, -1, -1):
            m = active[t + 1]
            ahead = self.emit[seqs[:m, t + 1]] * beta[:m] / scale[t + 1, :m, None]
            move += alpha[t, :m].T @ ahead
            alpha[t + 1, :m] *= beta[:m]
            beta[:m] = ahead @ self.move.T
        alpha[0] *= beta
        live = np.arange(length)[:, None] < sizes[None, :]
        cls, gamma = seqs.T[live], alpha[live]
        emit = np.stack([np.bincount(cls, gamma[:, j], CLASSES) for j in range(k)], axis=1)
        return alpha[0][opens].sum(axis=0), alpha[0][~opens].sum(axis=0), move * self.move, emit


# -- what a block keeps: lengths, whether each text trains, classes in order ----

def _sequences(ids: list, texts: list) -> bytes:
    known, sizes, parts = _Classes(), [], []
    for text in texts:
        words = blank_words(text)
        sizes.append(len(words))
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint16, len(words)))
    trains = np.array([training(i) for i in ids], np.uint8)
    return (np.array([len(ids)], np.uint32).tobytes() + np.array(sizes, np.uint32).tobytes()
            + trains.tobytes() + (np.concatenate(parts) if parts else np.empty(0, np.uint16)).tobytes())


def _restore(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    sizes = np.frombuffer(data, np.uint32, n, 4).astype(np.int64)
    trains = np.frombuffer(data, np.uint8, n, 4 + 4 * n).astype(bool)
    return sizes, trains, np.frombuffer(data, np.uint16, -1, 4 + 5 * n)


def _texts(data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """Class sequences with their end, and whether they train."""
    sizes, trains, flat = _restore(data)
    ends = np.cumsum(sizes)
    whole = np.insert(flat.astype(np.int64), ends, END)
    cuts = ends + np.arange(1, len(ends) + 1)
    return np.split(whole, cuts[:-1]) if len(ends) else [], trains


def _segments(data: bytes) -> tuple[np.ndarray, ...]:
    """The training sequences of a block, from long to short: all classes in a
    row, and of each sequence its place there, its size and whether it begins a text."""
    sizes, trains, flat = _restore(data)
    whole = np.insert(flat, np.cumsum(sizes), END)
    size = sizes + 1
    begin, mine = (np.cumsum(size) - size)[trains], size[trains]
    parts = -(-mine // SEGMENT)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    long = np.minimum(SEGMENT, np.repeat(mine, parts) - SEGMENT * nth)
    order = np.argsort(-long, kind="stable")
    return whole, (np.repeat(begin, parts) + SEGMENT * nth)[order], long[order], (nth == 0)[order]


def _counts(ids: list, lists: list, n: int) -> np.ndarray:
    """Occurrences of each piece of the block in training texts."""
    mine = [x for i, x in zip(ids, lists) if training(i)]
    if not mine:
        return np.zeros(n)
    return np.bincount(np.concatenate([a for a, _ in mine]),
                       np.concatenate([f for _, f in mine]), minlength=n)


# -- training ---------------------------------------------------------------------

def _expected(blocks: DataFrame, chain: Chain) -> DataFrame:
    """Expected counts summed over all partitions: one row per class (emission)
    and, below 0, per start distribution and state (transitions)."""
    k = len(chain.first)
    schema = T.StructType([T.StructField("row", T.IntegerType()),
                           *[T.StructField(f"s{j}", T.DoubleType()) for j in range(k)]])
    shared = blocks.sparkSession.sparkContext.broadcast(chain.single())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total, ends = shared.value, np.zeros((CLASSES + 2 + k, k)), 0
        for batch in batches:
            for data in batch.column(0):
                whole, starts, long, opens = _segments(data.as_py())
                for lo in range(0, len(starts), BATCH):
                    sizes, step = long[lo:lo + BATCH], np.arange(int(long[lo]))
                    at = starts[lo:lo + BATCH, None] + step
                    table = np.where(step < sizes[:, None], whole[np.minimum(at, len(whole) - 1)], END)
                    first, later, move, emit = model.expect(table, sizes, opens[lo:lo + BATCH])
                    total[:CLASSES] += emit
                    total[CLASSES] += first
                    total[CLASSES + 1] += later
                    total[CLASSES + 2:] += move
        at = np.flatnonzero(total.any(axis=1))
        rows = np.where(at < CLASSES, at, CLASSES - 1 - at).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(rows), *[pa.array(total[at, j]) for j in range(k)]],
                                         names=schema.names)

    got = blocks.select("extra").mapInArrow(run, schema)
    return got.groupBy("row").agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)])


def baum_welch(blocks: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[Chain, np.ndarray]:
    """The chain after ``rounds`` re-estimations, and training tokens per class."""
    chain = Chain.start(states)
    per_class = np.zeros(CLASSES)
    for _ in range(rounds):
        total = np.zeros((CLASSES + 2 + states, states))
        for r in _expected(blocks, chain).collect():  # CLASSES + states + 2 rows at most
            total[r["row"] if r["row"] >= 0 else CLASSES - 1 - r["row"]] = r[1:]
        per_class = total[:CLASSES].sum(axis=1)
        emit = total[:CLASSES] + PRIOR
        first, later, move = (total[CLASSES] + 1, total[CLASSES + 1] + 1, total[CLASSES + 2:] + 1)
        chain = Chain(first / first.sum(), later / later.sum(), move / move.sum(axis=1, keepdims=True),
                      emit / emit.sum(axis=0))
    return chain, per_class


def _class_totals(pieces: list[bytes], counts: np.ndarray, bucket: int) -> bytes:
    """(class, training tokens, distinct training words) of a bucket's pieces."""
    cls = np.fromiter(map(word_class, pieces), np.int64, len(pieces))
    n = np.zeros(CLASSES, np.int64)
    np.add.at(n, cls, np.asarray(counts, np.int64))  # whole numbers beyond 2^53
    v = np.bincount(cls, np.asarray(counts) > 0, CLASSES)
    at = np.flatnonzero(n)
    return np.stack([at, n[at], v[at]]).astype(np.int64).tobytes()


def _summed(values: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("cls", "n", "v")])

    def run(batches):
        for batch in batches:
            for x in batch.column(0).to_pylist():
                rows = np.frombuffer(x, np.int64).reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=schema.names)

    rows = (values.where("block = -1").select("values").mapInArrow(run, schema)
            .groupBy("cls").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())  # <= CLASSES
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rows:
        n[r["cls"]], v[r["cls"]] = r["n"], r["v"]
    return n, v


# -- scoring ----------------------------------------------------------------------

def _forward(blocks: DataFrame, chain: Chain) -> DataFrame:
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("extra", T.BinaryType())])
    shared = blocks.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for batch in batches:
            for block, data in zip(batch.column(0), batch.column(1)):
                data = data.as_py()
                seqs, _ = _texts(data)
                sizes = np.array([len(s) for s in seqs], np.int64)
                got = shared.value.log_probability(seqs) if seqs else np.empty(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()], pa.int64()),
                     pa.array([sizes.tobytes() + got.tobytes()], pa.binary())], names=schema.names)

    return blocks.select("block", "extra").mapInArrow(run, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
          rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score (unigram) and score (this model), both log10."""
    n_buckets = V.bucket_count(docs)
    table = V.index(docs, id_col, text_col, lambda t: Counter(blank_words(t)), n_buckets, "words",
                    mark=_counts, sequence=_sequences, as_bytes=True)
    blocks = table.where("bucket < 0")
    chain, per_class = baum_welch(blocks, states, rounds)
    values = write_once(V.by_bucket(table, lambda pieces, counts, _: counts, n_buckets, _class_totals, np.uint64), "counts")
    n_class, v_class = _summed(values)
    ends = float(round(per_class[END]))
    n_all, v_all = n_class.sum() + ends, v_class.sum() + (ends > 0)
    below = np.log10(n_class + 0.5 * (v_class + 1))  # of P(w | class)
    below_all = float(np.log10(n_all + 0.5 * (v_all + 1)))
    end_base = float(np.log10(ends + 0.5)) - below_all
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType())])
    known_end, train_tokens = int(ends > 0), int(n_all)

    def finish(row, counts):
        import pandas as pd
        ids = V.keys_of(row["keys"])
        n = len(ids)
        tokens = np.frombuffer(row["extra"], np.int64, n)
        path = np.frombuffer(row["extra"], np.float64, n, 8 * n)
        doc, piece, freq = V.unpack(row["sizes"], row["gaps"], row["freqs"])
        top = np.log10(counts + 0.5)
        add = lambda w: np.bincount(doc, w * freq, n)
        top_sum = add(top[piece]) if len(doc) else np.zeros(n)
        known = add(counts[piece] > 0) if len(doc) else np.zeros(n)
        keys = ids.to_pylist()
        return pd.DataFrame({
            id_col: pd.array(keys, dtype="object"),
            "held_out": [i is not None and not training(i) for i in keys],
            "n_tokens": tokens, "n_known": known.astype(np.int64) + known_end,
            "train_tokens": train_tokens,
            "base_score": top_sum - (tokens - 1) * below_all + end_base,
            "score": path + top_sum})

    # P(w | class) is counted over the classes of the sequence, in `_forward`:
    # its denominators go into the emissions
    emit = chain.emit.copy()
    emit[:END] /= 10 ** below[:END, None]
    more = _forward(blocks, Chain(chain.first, chain.later, chain.move, emit))
    return V.by_block(table, values.where("block >= 0"), finish, schema, more, np.uint64)
