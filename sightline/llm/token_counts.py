"""Token counts without token ids.

A byte-pair model never joins characters across certain places: with a
sentencepiece model whose pieces hold the blank sign only at their start and
no newline at all, nothing spans a non-blank character before a blank, or
either side of a newline. The text between two such places is a *pre-token*
and its number of pieces does not depend on what stands around it. So every
distinct pre-token of the corpus is counted once, and a document's number of
tokens is the sum over its pre-token frequencies (``vocabulary`` does the
join). A model without these properties is refused.

Defined cases: null and empty texts have 0 tokens and 0 bytes; rows with the
same or a null id each get their own row; extra columns are not looked at.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocabulary as V

BLANK = "▁"
MODEL = "piece_bpe_32k.model"

_LOADED: dict[str, object] = {}


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def load(path: str):
    """The sentencepiece model, once per worker."""
    if path not in _LOADED:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [sp.id_to_piece(i) for i in range(len(sp))
               if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in own) or sp.encode(
                " a  b ", out_type=str) != sp.encode(f"{BLANK}a{BLANK}{BLANK}b{BLANK}", out_type=str):
            raise ValueError("pre-tokens of this model are not independent")
        _LOADED[path] = sp
    return _LOADED[path]


# A pre-token is kept as the text that gives it when encoded alone (the model
# puts one blank before a text). What cannot be given so begins with "\\1":
# a newline, a blank alone, and a piece after a newline ("\\1b" before it). A
# piece that itself begins with "\\0" or "\\1" gets "\\0" before it.
NEWLINE, ALONE, BARE, PLAIN = "\1n", "\1_", "\1b", "\0"


def pre_tokens(text: str) -> Counter:
    """Pre-token -> how often."""
    if BLANK in text:
        text = text.replace(BLANK, " ")
    parts = text.split(" ")
    single = 0  # blanks that stand alone
    if "" in parts:
        parts, single = _join_blanks(parts)
    lines = text.count("\n")
    if lines or "\0" in text or "\1" in text:
        plain = []
        for p in parts:
            first, *rest = p.split("\n")
            if first:
                plain.append(PLAIN + first if first[0] in "\0\1" else first)
            else:
                single += 1
            plain.extend(BARE + r for r in rest if r)
        parts = plain
    out = Counter(parts)
    if lines:
        out[NEWLINE] = lines
    if single:
        out[ALONE] = single
    return out


def _join_blanks(parts: list[str]) -> tuple[list[str], int]:
    """Empty parts are further blanks: they belong to the next part."""
    out, more = [], 0
    for p in parts:
        if p:
            out.append(" " * more + p)
            more = 0
        else:
            more += 1
    if more > 1:  # blanks at the end
        out.append(" " * (more - 1))
    return out, int(more == 1)


def piece_counts(path: str, keys: list[bytes]) -> np.ndarray:
    """Number of model pieces of each pre-token."""
    sp = load(path)
    both = len(sp.encode("\n"))          # the blank the model puts first, and the newline
    newline = both - 1
    texts, less = [], []
    for k in keys:
        s = k.decode()
        if s == NEWLINE or s == ALONE:
            texts.append("\n"), less.append(both - newline if s == NEWLINE else newline)
        elif s[0] == "\1":
            texts.append("\n" + s[2:]), less.append(both)
        else:
            texts.append(s[1:] if s[0] == PLAIN else s), less.append(0)
    return np.array([len(x) for x in sp.encode(texts, num_threads=1)], np.int64) - less


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                       T.StructField("n_bytes", T.LongType())])


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 model: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """One row per document: id, n_tokens, n_bytes (UTF-8)."""
    path, n = model or model_path(), n_buckets or V.bucket_count(docs)
    table = V.index(docs, id_col, text_col, pre_tokens, n, "tokens", sequence=_bytes)
    values = V.by_bucket(table, lambda keys, *_: piece_counts(path, keys), n)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *SCHEMA.fields[1:]])

    def finish(row, got):
        import pandas as pd
        ids = V.keys_of(row["keys"])
        doc, piece, freq = V.unpack(row["sizes"], row["gaps"], row["freqs"])
        # bridges point at any number below the next piece: frequency 0
        total = np.bincount(doc, got.astype(np.int64)[piece] * freq if len(got) else None,
                            minlength=len(ids))
        return pd.DataFrame({id_col: pd.array(ids.to_pylist(), dtype="object"),
                             "n_tokens": total.astype(np.int64),
                             "n_bytes": np.frombuffer(row["extra"], np.int64)})

    return V.by_block(table, values, finish, schema)


def _bytes(ids: list, texts: list) -> bytes:
    return np.array([len(t.encode()) if t else 0 for t in texts], np.int64).tobytes()


def over_limit(counts: DataFrame, limit: int = 4096) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
