"""Language identification: family first, then one-versus-one inside it.

Texts become hashed character n-grams (1 to 3, lower case, runs of blanks as
one). A linear support vector machine per pair of families votes for the
family, and one per pair of languages inside the family votes for the
language. A text's features are the shares of its n-grams, so a margin is the
mean weight of the n-grams of the whole text.

The classifiers are fitted on a bounded sample of labelled rows: at most
``PER_LANGUAGE`` documents per language, those with the smallest hash of their
id. Each machine is trained in a task of its own (a group holds no more than
the sample). Prediction is one pass over all documents with the weights
broadcast (2^14 x machines).

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text if no language could be learned; rows with a null language or a
null id are predicted but never learned from; one learned language is
predicted for everything that has a letter; extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import slices, write_once

# Families of closely related languages; any other code is a
# family of its own.
FAMILY = {
    **dict.fromkeys(["en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"], "germanic"),
    **dict.fromkeys(["fr", "es", "it", "pt", "ca", "ro", "gl"], "romance"),
    **dict.fromkeys(["ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr"], "slavic"),
}
UND = "und"
BITS, ORDERS = 14, 3
STRETCH = 1 << 18       # characters looked at in one go
PER_LANGUAGE = 1000     # bound of the sample
EPOCHS, REGULAR = 15, 1e-4

_BLANKS = re.compile(r"\s+")
_LETTER = re.compile(r"[^\W\d_]")


def _stretches(text: str) -> Iterator[str]:
    """" text " in lower case with runs of blanks as one, about ``STRETCH``
    characters at a time, cut before blanks where there is one near."""
    lo, last = 0, " "
    yield " "
    while lo < len(text):
        hi = lo + STRETCH
        blank = _BLANKS.search(text, hi, hi + 256)
        hi = blank.start() if blank else hi
        part = _BLANKS.sub(" ", text[lo:hi].lower())
        if last == " ":
            part = part.lstrip()
        if part:
            yield part
            last = part[-1]
        lo = hi
    if last != " ":
        yield " "


def gram_counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text. Memory does not
    follow the text: a stretch is counted together with the end of the last."""
    total, tail = np.zeros(1 << BITS, np.int64), ""
    for part in _stretches(text):
        c = np.frombuffer((tail + part).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        h = np.zeros(len(c), np.uint64)
        for n in range(1, min(ORDERS, len(c)) + 1):
            h = (h[:len(c) - n + 1] + c[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            new = max(0, len(tail) - n + 1)     # n-grams that end in this stretch
            total += np.bincount((h[new:] >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
            h = h ^ (h >> np.uint64(29))
        tail = (tail + part)[1 - ORDERS:]
    return total


@dataclass
class Model:
    families: list[str]                     # sorted
    languages: dict[str, list[str]]         # family -> sorted languages
    machines: list[tuple[str, str, str]]    # (group, first, second); group "" = families
    weights: np.ndarray                     # (2^BITS, machines), float32
    bias: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not _LETTER.search(text):
            return UND, 0.0
        n = gram_counts(text)
        at = np.flatnonzero(n)
        margin = (n[at] / n.sum()) @ self.weights[at] + self.bias
        family, sure = self._vote("", self.families, margin)
        language, surer = self._vote(family, self.languages[family], margin)
        return language, sure * surer

    def _vote(self, group: str, names: list[str], margin: np.ndarray) -> tuple[str, float]:
        """Most votes, then the larger sum of margins, then the name; and how
        sure its narrowest duel is."""
        if len(names) == 1:
            return names[0], 1.0
        votes, total, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
        for k, (g, a, b) in enumerate(self.machines):
            if g == group:
                m = float(margin[k])
                votes[a if m >= 0 else b] += 1
                p = 1 / (1 + np.exp(-np.clip(4 * m, -50, 50)))
                for name, sign, q in ((a, 1, p), (b, -1, 1 - p)):
                    total[name] += sign * m
                    least[name] = min(least[name], q)
        best = min(names, key=lambda x: (-votes[x], -total[x], x))
        return best, float(least[best])


def learnable(id_col: str, lang_col: str) -> Column:
    return F.col(lang_col).isNotNull() & (held_out_digit(id_col) != 2)


def held_out_digit(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, which: Column,
           per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` labelled texts of each language: those whose id
    has the smallest hashes, among rows of one id those of the smallest text hash.

    The bound per language is found on ids alone; the texts then pass a filter,
    and what ties at the bound is counted off.
    """
    spot = F.xxhash64(F.col(id_col).cast("string"))
    rows = docs.where(which & F.col(text_col).isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("spot", "id"))
    edge = (rows.select(F.col(lang_col).alias("lang"), spot.alias("spot"), F.col(id_col).alias("id"))
            .withColumn("r", rank).where(F.col("r") <= per_language)
            .groupBy("lang").agg(F.max("spot").alias("edge")))  # one row per language
    return (rows.select(F.col(lang_col).alias("lang"), spot.alias("spot"), F.col(text_col).alias("text"))
            .join(F.broadcast(edge), "lang").where("spot <= edge")
            .withColumn("r", F.row_number().over(
                Window.partitionBy("lang").orderBy("spot", F.xxhash64("text"), "text")))
            .where(F.col("r") <= per_language).select("lang", "spot", "text"))


def _vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    n = gram_counts(text)
    at = np.flatnonzero(n)
    return at.astype(np.int32), (n[at] / n.sum()).astype(np.float32)


def fit_machine(at: list[np.ndarray], share: list[np.ndarray], sign: np.ndarray) -> tuple[np.ndarray, float]:
    """Hinge loss with L2 by averaged stochastic subgradient steps (Pegasos),
    classes weighted alike. Features are scaled to norm 1 on average; the
    weights come back for unscaled shares."""
    scale = 1 / max(1e-9, float(np.mean([np.linalg.norm(s) for s in share])))
    share = [s * scale for s in share]
    rng = np.random.default_rng(11)
    part = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())) * len(sign)
    w, bias, mean, mean_bias, steps = np.zeros(1 << BITS), 0.0, np.zeros(1 << BITS), 0.0, 0
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(sign)):
            rate = 2.0 / (1 + REGULAR * 100 * steps)
            steps += 1
            if sign[i] * (w[at[i]] @ share[i] + bias) < 1:
                w[at[i]] += rate * part[i] * sign[i] * share[i]
                bias += 0.05 * rate * part[i] * sign[i]
        w *= 1 - REGULAR * EPOCHS
        if epoch >= EPOCHS // 2:
            mean += w
            mean_bias += bias
    k = EPOCHS - EPOCHS // 2
    return mean / k * scale, mean_bias / k


def train(docs: DataFrame, which: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fit all machines on the bounded sample of rows where ``which`` holds."""
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("spot", T.LongType()),
        T.StructField("at", T.BinaryType()), T.StructField("share", T.BinaryType())])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, 2)):
            got = [_vector(t) if t else (np.empty(0, np.int32), np.empty(0, np.float32))
                   for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([a.tobytes() for a, _ in got], pa.binary()),
                 pa.array([s.tobytes() for _, s in got], pa.binary())], names=schema.names)

    rows = write_once(sample(docs, id_col, text_col, lang_col, which, per_language)
                      .mapInArrow(vectors, schema).where(F.length("at") > 0), "lang-sample")
    known = sorted(r["lang"] for r in rows.select("lang").distinct().collect())  # languages, a short list
    languages: dict[str, list[str]] = {}
    for lang in known:
        languages.setdefault(FAMILY.get(lang, lang), []).append(lang)
    families = sorted(languages)
    machines = [("", a, b) for a, b in combinations(families, 2)]
    machines += [(f, a, b) for f in families for a, b in combinations(languages[f], 2)]
    weights = np.zeros((1 << BITS, len(machines)), np.float32)
    bias = np.zeros(len(machines))
    if machines:
        side = {}  # language -> [(machine, sign)]
        for k, (group, a, b) in enumerate(machines):
            for name, sign in ((a, 1), (b, -1)):
                for lang in languages[name] if not group else [name]:
                    side.setdefault(lang, []).append((k, sign))
        spark = docs.sparkSession
        use = spark.createDataFrame([(lang, k, s) for lang, xs in side.items() for k, s in xs],
                                    "lang string, machine int, sign int")
        out = T.StructType([T.StructField("machine", T.IntegerType()), T.StructField("w", T.BinaryType()),
                            T.StructField("bias", T.DoubleType())])

        def fit(key, pdf):
            import pandas as pd
            pdf = pdf.sort_values(["spot", "lang"])
            w, b = fit_machine([np.frombuffer(x, np.int32) for x in pdf["at"]],
                               [np.frombuffer(x, np.float32) for x in pdf["share"]],
                               pdf["sign"].to_numpy().astype(float))
            return pd.DataFrame({"machine": [key[0]], "w": [w.astype(np.float32).tobytes()], "bias": [b]})

        fitted = rows.join(F.broadcast(use), "lang").groupBy("machine").applyInPandas(fit, out)
        for r in fitted.collect():  # one row of fixed size per machine
            weights[:, r["machine"]] = np.frombuffer(r["w"], np.float32)
            bias[r["machine"]] = r["bias"]
    return Model(families, languages, machines, weights, bias)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([src.schema[0], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, 1)):
            got = [shared.value.predict(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=schema.names)

    return src.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The documents, as they are, whose text is in a learned language with at
    least this score; ``und`` never is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    k = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, k)):
            got = [shared.value.predict(t) for t in part.column(k).to_pylist()]
            yield part.filter(pa.array([g[0] != UND and g[1] >= least for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
