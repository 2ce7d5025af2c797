"""Toxicity by multiple-instance learning: sentences are judged, documents are labelled.

A document is a bag of sentences and toxic if any of them is:

    p(sentence) = 1 / (1 + exp(-(bias + sum of the weights of its features)))
    P(document) = 1 - prod (1 - p(sentence))                        (noisy-or)

Features are the words of a sentence with their beginnings and endings of three
to six letters. Only the ``FEATURES`` that tell labelled documents apart best
get a weight (a bound of the model, not of the data): the distinct words of
documents are counted by label over all labelled rows, a feature's z-score ranks
it, and of features with the same counts inside one word the shortest stands for
all.

The weights come from document labels alone. Every round sends, per partition,
the gradient and curvature of the likelihood of all labelled documents, summed
by Spark per feature; the driver takes a damped Newton step per weight with an
L2 penalty and momentum. A sentence of a toxic document is pulled up by its share of the
document's probability, so the round's responsibilities find the offending ones.
``locate`` returns them.

Defined cases: null, empty and wordless texts have no sentence and score 0; rows
with a null id or a null label are scored but not learned from; of several labels
of an id the highest counts; repeated documents count as often as they come; without
any toxic training row the score is 0 everywhere; extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import drop_table, slices, write_once

FEATURES = 8192         # weights of the model
LEAST_Z, LEAST_DOCS = 4.0, 5
LIFT = 1.5              # a feature's share among toxic documents against clean ones, or the reverse
PARTS = range(3, 7)     # letters of a beginning or ending
ROUNDS, RIDGE, MOMENTUM = 20, 1.0, 0.8
HELD = 400_000          # word counts a task holds before it sends them on
KNOWN = 200_000         # words a worker remembers the features of
BROADCAST_LABELS = 2_000_000    # ids and labels, 32 MB; above it the join shuffles

_SENTENCE = re.compile(r"[^.!?\n\r…。！？]+")
_WORD = re.compile(r"[^\W_]+")


def word_features(word: str) -> list[str]:
    """The word, its beginnings and its endings, each in a form of its own."""
    sizes = [k for k in PARTS if k < len(word)]
    return [word + ".", *(word[:k] + "-" for k in sizes), *("-" + word[-k:] for k in sizes)]


def sentences(text: str | None) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches between sentence marks that hold a word."""
    for m in _SENTENCE.finditer(text or ""):
        if _WORD.search(m.group()):
            yield m.span()


@dataclass
class Model:
    features: list[str]
    weights: np.ndarray
    bias: float
    whole: dict[str, int] = field(default_factory=dict)     # features by kind: number of each
    begin: dict[str, int] = field(default_factory=dict)
    end: dict[str, int] = field(default_factory=dict)
    likely: tuple[set, set] = ((), ())                      # first and last letters of some beginning and ending
    known: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self):
        for i, f in enumerate(self.features):
            kind = self.whole if f[-1] == "." else self.begin if f[-1] == "-" else self.end
            kind[f.strip(".-")] = i
        least = PARTS[0]
        self.likely = {f[:least] for f in self.begin}, {f[-least:] for f in self.end}

    def __getstate__(self):
        return {"features": self.features, "weights": self.weights, "bias": self.bias}

    def __setstate__(self, state):
        self.__init__(**state)

    def of_word(self, word: str) -> tuple[int, ...]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            out, least = [self.whole.get(word)], PARTS[0]  # the numbers of `word_features`, none built
            sizes = [k for k in PARTS if k < len(word)]
            if word[:least] in self.likely[0]:
                out += [self.begin.get(word[:k]) for k in sizes]
            if word[-least:] in self.likely[1]:
                out += [self.end.get(word[-k:]) for k in sizes]
            got = self.known[word] = tuple([i for i in out if i is not None])
        return got

    def instances(self, text: str | None) -> tuple[int, list[tuple[int, int, list[int]]]]:
        """Number of sentences without any feature, and (start, end, features)
        of the others."""
        plain, out, known, of_word = 0, [], self.known, self.of_word
        for m in _SENTENCE.finditer(text or ""):
            words = _WORD.findall(m.group().lower())
            if not words:
                continue
            here: set[int] = set()
            for w in words:
                got = known.get(w)
                if got is None:
                    got = of_word(w)
                if got:
                    here.update(got)
            if here:
                out.append((*m.span(), sorted(here)))
            else:
                plain += 1
        return plain, out

    def judge(self, text: str | None) -> tuple[float, int, list[tuple[int, int, float]]]:
        """P(document), its number of sentences, and (start, end, p) of those
        with features."""
        plain, rows = self.instances(text)
        if self.bias == -np.inf:  # nothing toxic was learned from
            return 0.0, plain + len(rows), []
        got = [(a, b, float(_p(self.bias + self.weights[f].sum()))) for a, b, f in rows]
        clear = plain * np.log1p(-_p(self.bias)) + sum(np.log1p(-min(p, 1 - 1e-12)) for *_, p in got)
        return float(-np.expm1(clear)), plain + len(rows), got


def _p(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


# -- learning ---------------------------------------------------------------------

def held_out_digit(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """(label 0 or 1, text) of the documents that may be learned from."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .where(held_out_digit(id_col) != 2)
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label")))
    known = write_once(known, "labels")
    small = known.count() <= BROADCAST_LABELS
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    src = src.where(F.col("text").isNotNull() & F.col("_id").isNotNull())
    return src.join(F.broadcast(known) if small else known, "_id").select("label", "text")


def _frequencies(rows: DataFrame) -> DataFrame:
    """(feature, clean, toxic): distinct words of documents of either label that
    have the feature; feature "" counts the documents."""
    schema = T.StructType([T.StructField("word", T.StringType()),
                           T.StructField("clean", T.LongType()), T.StructField("toxic", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def send() -> Iterator[pa.RecordBatch]:
            for k, counts in enumerate(seen):
                n = pa.array(list(counts.values()), pa.int64())
                none = pa.array(np.zeros(len(counts), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *((none, n) if k else (n, none))],
                                                 names=schema.names)
                counts.clear()

        for batch in batches:
            for part in slices(batch, 1):
                for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts = seen[1 if label > 0 else 0]
                    counts.update(set(_WORD.findall(text.lower())))
                    counts[""] += 1
                if len(seen[0]) + len(seen[1]) >= HELD:
                    yield from send()
        yield from send()

    words = rows.mapInArrow(run, schema).groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    size = F.char_length("word")
    parts = [F.filter(F.array(*map(F.lit, PARTS)), lambda k: k < size)] * 2
    forms = F.concat(  # as in `word_features`
        F.array(F.concat("word", F.lit("."))),
        F.transform(parts[0], lambda k: F.concat(F.left("word", k), F.lit("-"))),
        F.transform(parts[1], lambda k: F.concat(F.lit("-"), F.right("word", k))))
    forms = F.when(size > 0, forms).otherwise(F.array(F.lit("")))
    return words.select(F.explode(forms).alias("feature"), "clean", "toxic").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def choose(frequencies: DataFrame, features: int = FEATURES) -> tuple[list[str], int, int]:
    """The features of the highest z-score, and the numbers of clean and toxic documents."""
    got = frequencies.where("feature = ''").collect()  # one row
    clean, toxic = (int(got[0]["clean"]), int(got[0]["toxic"])) if got else (0, 0)
    if not clean or not toxic:
        return [], clean, toxic
    share = (F.col("clean") + F.col("toxic")) / F.lit(float(clean + toxic))
    z = F.abs(F.col("toxic") - toxic * share) / F.sqrt(
        share * (1 - share) * F.lit(toxic * clean / (clean + toxic)) + F.lit(1e-9))
    lift = F.col("toxic") / toxic / ((F.col("clean") + 0.5) / clean)
    best = (frequencies.where("feature <> ''").where(F.col("clean") + F.col("toxic") >= LEAST_DOCS)
            .where((lift >= LIFT) | (lift <= 1 / LIFT)).withColumn("z", z).where(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "feature").limit(4 * features))
    kept: dict[tuple, list[str]] = {}   # features of the same documents, as far as counts tell
    names = []
    for r in sorted(best.collect(), key=lambda r: (-r["z"], len(r["feature"]), r["feature"])):  # at most 4 x features
        core = r["feature"].strip(".-")
        same = kept.setdefault((r["clean"], r["toxic"]), [])
        if not any(core in x or x in core for x in same):
            same.append(core)
            names.append(r["feature"])
    return names[:features], clean, toxic


BAG = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("plain", T.LongType()),
                    T.StructField("sizes", T.BinaryType()), T.StructField("features", T.BinaryType())])


def bags(rows: DataFrame, model: Model) -> DataFrame:
    """The labelled documents as bags of sentences, written once."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                cols: tuple[list, ...] = ([], [], [], [])
                for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    plain, sents = shared.value.instances(text)
                    cols[0].append(1 if label > 0 else 0)
                    cols[1].append(plain)
                    cols[2].append(np.array([len(f) for *_, f in sents], np.uint32).tobytes())
                    cols[3].append(np.array([x for *_, f in sents for x in f], np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    names=BAG.names)

    return write_once(rows.mapInArrow(run, BAG), "bags")


def slopes(weights: np.ndarray, bias: float, label: np.ndarray, plain: np.ndarray, doc: np.ndarray,
           sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient and curvature of the log-likelihood by weight (the bias last),
    and the log-likelihood, of bags: sentences (doc, sizes, features at)."""
    n = len(weights)
    sent = np.repeat(np.arange(len(sizes)), sizes)
    p = _p(bias + np.bincount(sent, weights[at], len(sizes)))
    p0 = _p(bias)
    clear = plain * np.log1p(-p0) + np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(label))
    whole = np.maximum(-np.expm1(clear), 1e-12)     # P(document)
    # a sentence of a toxic document is expected to be toxic by p / P, of a clean one by 0
    pull = np.where(label > 0, 1 / whole, 0.0) - 1
    g, h = p * pull[doc], p * (1 - p)
    grad, curve = np.zeros(n + 1), np.zeros(n + 1)
    grad[:n] = np.bincount(at, g[sent], n)
    curve[:n] = np.bincount(at, (h * (sizes + 1))[sent], n)
    grad[n] = g.sum() + (plain * p0 * pull).sum()
    curve[n] = (h * (sizes + 1)).sum() + (plain * p0 * (1 - p0)).sum()
    return grad, curve, float(np.where(label > 0, np.log(whole), clear).sum())


def _round(table: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    n = len(model.features)
    shared = table.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("g", T.DoubleType()),
                           T.StructField("h", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grad, curve = np.zeros(n + 1), np.zeros(n + 1)
        for batch in batches:
            for part in slices(batch, 3):
                label, plain = part.column(0).to_numpy(), part.column(1).to_numpy()
                sizes = [np.frombuffer(x, np.uint32) for x in part.column(2).to_pylist()]
                doc = np.repeat(np.arange(len(sizes)), [len(x) for x in sizes])
                at = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint16).astype(np.int64)
                flat = np.concatenate([*sizes, np.empty(0, np.uint32)]).astype(np.int64)
                g, h, _ = slopes(*shared.value, label, plain, doc, flat, at)
                grad += g
                curve += h
        at = np.flatnonzero(curve)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(grad[at]), pa.array(curve[at])],
                                         names=schema.names)

    grad, curve = np.zeros(n + 1), np.zeros(n + 1)
    summed = table.mapInArrow(run, schema).groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    for r in summed.collect():  # one row a weight at most
        grad[r["at"]], curve[r["at"]] = r["g"], r["h"]
    shared.unpersist()
    return grad, curve


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", features: int = FEATURES, rounds: int = ROUNDS,
          ridge: float = RIDGE) -> Model:
    """The model of all labelled documents outside the held-out ids."""
    rows = labelled(docs, labels, id_col, text_col, label_col)
    counted = write_once(_frequencies(rows), "features")
    names, clean, toxic = choose(counted, features)
    drop_table(counted)
    if not toxic:
        return Model([], np.zeros(0), -np.inf)
    model = Model(names, np.zeros(len(names)), -5.0)
    table = bags(rows, model)
    speed, speed_bias = np.zeros(len(names)), 0.0
    for _ in range(rounds):  # slopes are taken where the last move leads
        ahead = Model(names, model.weights + MOMENTUM * speed, model.bias + MOMENTUM * speed_bias)
        grad, curve = _round(table, ahead)
        step = (grad[:-1] - ridge * ahead.weights) / (curve[:-1] + ridge)
        speed = MOMENTUM * speed + np.clip(step, -2.0, 2.0)
        speed_bias = MOMENTUM * speed_bias + float(np.clip(grad[-1] / (curve[-1] + 1.0), -1.0, 1.0))
        model = Model(names, model.weights + speed, float(np.clip(model.bias + speed_bias, -20.0, 20.0)))
    drop_table(table)
    return model


# -- use --------------------------------------------------------------------------

def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          offending: float = 0.3) -> DataFrame:
    """One row per document: id, score, n_sentences, n_offending (sentences of
    probability ``offending`` or more) and the place of the worst of them, as
    start and length in characters (null where there is none)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kinds = [T.DoubleType(), *[T.LongType()] * 4]
    names = ["score", "n_sentences", "n_offending", "worst_start", "worst_length"]
    schema = T.StructType([src.schema[0], *(T.StructField(n, t) for n, t in zip(names, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                for text in part.column(1).to_pylist():
                    whole, n, sents = shared.value.judge(text)
                    bad = [s for s in sents if s[2] >= offending]
                    a, b, _ = max(bad, key=lambda s: (s[2], -s[0]), default=(None, None, 0))
                    rows.append((whole, n, len(bad), a, b - a if bad else None))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cols[0], pa.float64()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                    names=schema.names)

    return src.mapInArrow(run, schema)


def locate(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           least: float = 0.3) -> DataFrame:
    """The offending sentences: id, start and length in characters, sentence, p."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([src.schema[0], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("sentence", T.StringType()), T.StructField("p", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = [(i, a, b - a, text[a:b], p)
                        for i, text in enumerate(part.column(1).to_pylist())
                        for a, b, p in shared.value.judge(text)[2] if p >= least]
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.float64())],
                    names=schema.names)

    return src.mapInArrow(run, schema)
