"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items go into suffix automata over words. Training texts
stream through them word by word: an automaton holds the longest suffix read so
far that occurs in some item. Where that length reaches ``window`` words (or a
whole item of fewer words ends), the words are a hit. Documents are not shuffled.

Size: items are dealt by hash to shards of about ``shard_words`` words, and a
task builds each shard's automaton and writes it to the shared folder; the
driver never sees an item. The documents meet ``at_once`` automata at a time,
which is all that is broadcast: what a round found travels with its document,
in a written table, to the next round. A benchmark of up to ``at_once`` shards
is one round and one pass over the documents without such a table. The longest
single item is the one thing that a shard's size does not bound.

Defined cases: a null or empty text has no words, is never contaminated and is
returned as it is; items that are null or have no words match nothing; an item
given twice counts once per distinct id; items with a null id match (their
words are hits) but add nothing to the list of ids; an empty item table leaves
all documents clean; extra columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ALNUM_TABLE, alnum_words, drop_table, replace_columns, slices, write_once

WINDOW = 10
SHARD_WORDS = 100_000
AT_ONCE = 4
_WORD = re.compile(rb"[^\x20]+")
_WORDS_OF_TEXT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NONE: dict = {}


@dataclass
class SuffixAutomaton:
    """Generalised suffix automaton over word numbers.

    While it grows, ``step`` holds a dictionary per state; afterwards a state
    with one way on is an entry of ``only`` (word) and ``to`` (state), and the
    few with several are in ``many``."""

    window: int
    vocab: dict[bytes, int] = field(default_factory=dict)
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    items: dict[int, tuple] = field(default_factory=dict)   # state -> item ids (windows)
    short: dict[int, dict] = field(default_factory=dict)    # state -> {words: item ids}
    near_short: list[int] = field(default_factory=list)     # state -> nearest suffix in short
    min_words: int = 0
    only: array = field(default_factory=lambda: array("i"))
    to: array = field(default_factory=lambda: array("i"))
    many: dict[int, dict[int, int]] = field(default_factory=dict)

    def _extend(self, last: int, w: int) -> int:
        if w in self.step[last]:
            q = self.step[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
        cur = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, length: int, link: int, step: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = c
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = c
            p = self.link[p]
        return c

    @classmethod
    def build(cls, texts: list[tuple[object, list[bytes]]], window: int) -> SuffixAutomaton:
        a = cls(window)
        coded = [(i, [a.vocab.setdefault(w, len(a.vocab)) for w in words])
                 for i, words in texts if words]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = a._extend(last, w)
        found: dict[int, list] = {}
        seen: dict[int, int] = {}
        short: dict[int, dict[int, list]] = {}
        for k, (item, ws) in enumerate(coded):
            s = 0
            for w in ws:  # every state that holds a window of this item
                s = a.step[s][w]
                t = s
                while t > 0 and a.length[t] >= window and seen.get(t) != k:
                    seen[t] = k
                    found.setdefault(t, []).append(item)
                    t = a.link[t]
            if len(ws) < window:
                short.setdefault(s, {}).setdefault(len(ws), []).append(item)
        keep = lambda xs: tuple({x for x in xs if x is not None})
        a.items = {s: keep(v) for s, v in found.items()}
        a.short = {s: {n: keep(v) for n, v in d.items()} for s, d in short.items()}
        a.near_short = [-1] * len(a.length)
        for s in sorted(range(len(a.length)), key=a.length.__getitem__):
            up = a.link[s]
            a.near_short[s] = s if s in a.short else a.near_short[up] if up >= 0 else -1
        a.min_words = min([window, *(n for d in short.values() for n in d)])
        a._pack()
        return a

    def _pack(self) -> None:
        ways = [next(iter(d.items())) if len(d) == 1 else (-1, -1) for d in self.step]
        self.only, self.to = (array("i", x) for x in zip(*ways))
        self.many = {s: d for s, d in enumerate(self.step) if len(d) > 1}
        self.step = []
        self.length, self.link, self.near_short = (array("i", x) for x in (self.length, self.link, self.near_short))

    def _next(self, s: int, w: int) -> int:
        return self.to[s] if self.only[s] == w else self.many.get(s, _NONE).get(w, -1)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged word intervals [from, to) under occurrences, and the items."""
        get, spans, items = self.vocab.get, [], set()
        ids = np.fromiter(map(get, words, itertools.repeat(-1)), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        for lo, hi in zip(edge[::2], edge[1::2]):  # stretches of words that items know
            if hi - lo >= self.min_words:
                self._walk(ids[lo:hi].tolist(), int(lo), spans, items)
        return spans, items

    def _walk(self, ids: list[int], base: int, spans: list, items: set) -> None:
        link, length, window, step = self.link, self.length, self.window, self._next
        s = n = 0
        for i, w in enumerate(ids):
            while (t := step(s, w)) < 0 and s:
                s = link[s]
                n = length[s]
            if t >= 0:
                s = t
                n += 1
            best = 0
            if n >= window:
                t = s
                while length[link[t]] >= window:
                    t = link[t]
                items.update(self.items[t])
                best = window
            t = self.near_short[s]
            while t >= 0:
                for m, ids_ in self.short[t].items():
                    if m <= n:
                        items.update(ids_)
                        best = max(best, m)
                t = self.near_short[link[t]] if link[t] >= 0 else -1
            if best:
                a, b = base + i + 1 - best, base + i + 1
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, b))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


AUTOMATA = "shard BIGINT, automaton BINARY"


class Automata:
    """The automata of an item table, built in tasks and written; ``rounds`` are
    the ranges of shards that documents meet together."""

    def __init__(self, items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
                 shard_words: int = SHARD_WORDS, at_once: int = AT_ONCE):
        def build(key, rows):
            texts = [(i, w) for i, t in zip(rows["id"], rows["text"]) if (w := alnum_words(t))]
            return pd.DataFrame({"shard": [key[0]], "automaton": [pickle.dumps(SuffixAutomaton.build(texts, window))]})

        n_words = F.regexp_count(F.col("text").cast("string"), F.lit(_WORDS_OF_TEXT))
        rows = (items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
                .dropDuplicates(["id", "text"]).where(n_words > 0))
        total = rows.agg(F.sum(n_words)).first()[0] or 0
        n = -(-total // shard_words)
        self._sc = items.sparkSession.sparkContext
        self.rounds = [(lo, min(lo + at_once, n) - 1) for lo in range(0, n, at_once)]
        self.table = None
        if n:
            shard = F.pmod(F.xxhash64("id", "text"), F.lit(n)).alias("shard")
            self.table = write_once(rows.select(shard, "*").groupBy("shard").applyInPandas(build, AUTOMATA), "automata")

    def load(self, at: tuple[int, int]):
        """Broadcast one round, serialised."""
        rows = self.table.where(F.col("shard").between(*at)).select("automaton").collect()
        return self._sc.broadcast([bytes(r[0]) for r in rows])


Found = tuple[list[tuple[int, int]], set]  # merged spans, items


def _find(words: list[bytes], machines: list[SuffixAutomaton], before: Found = ([], set())) -> Found:
    spans, items = list(before[0]), set(before[1])
    for a in machines:
        s, i = a.hits(words)
        spans += s
        items |= i
    return merge(spans), items


_FOUND = T.StructType([T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                       T.StructField("items", T.ArrayType(T.StringType()))])
_FOUND_ARROW = pa.struct([("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
_SPANS = pa.list_(pa.list_(pa.int64()))


def _new_name(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _through(docs: DataFrame, text_col: str, automata: Automata, finish: Callable, schema: T.StructType) -> DataFrame:
    """The documents past all automata, one round at a time. ``finish(part,
    found, machines)`` makes the result of a part: per row, ``found`` gives its
    words and ``Found`` over all rounds; ``machines`` is the last round."""
    k, width = docs.columns.index(text_col), len(docs.columns)
    column = _new_name("_found", docs.columns)
    carried = T.StructType([*docs.schema.fields, T.StructField(column, _FOUND)])

    def searched(batches, blobs, begun):
        machines = [pickle.loads(x) for x in blobs]
        for part in (p for batch in batches for p in slices(batch, k)):
            old = part.column(width).to_pylist() if begun else itertools.repeat(None)
            texts = (alnum_words(t.encode() if isinstance(t, str) else t) for t in part.column(k).to_pylist())
            found = [(w, _find(w, machines, (map(tuple, o["spans"]), o["items"]) if o else ([], set())))
                     for w, o in zip(texts, old)]
            yield part.select(carried.names[:width]) if begun else part, found, machines

    def one_round(blobs, begun):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, found, _ in searched(batches, blobs.value, begun):
                cells = [{"spans": list(map(list, spans)), "items": sorted(items)} for _, (spans, items) in found]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, _FOUND_ARROW)], names=carried.names)
        return run

    rows = docs
    for at in automata.rounds[:-1]:
        blobs = automata.load(at)
        done = write_once(rows.mapInArrow(one_round(blobs, rows is not docs), carried), "decontaminate")
        blobs.unpersist()
        if rows is not docs:
            drop_table(rows)
        rows = done
    last = automata.load(automata.rounds[-1]) if automata.rounds else None
    begun = rows is not docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, machines in searched(batches, last.value if last else [], begun):
            yield finish(part, found, machines)

    return rows.mapInArrow(run, schema)


SCAN_SCHEMA = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))])


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, **how) -> DataFrame:
    """One row per document: id, n_words, n_hit, sorted item_ids, and spans
    (word intervals [from, to), merged) under occurrences of item windows."""
    src = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias(_new_name("_text", [id_col])))
    schema = T.StructType([src.schema[0], *SCAN_SCHEMA.fields])
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), _SPANS]

    def finish(part, found, _):
        rows = [(len(w), sum(b - a for a, b in spans), sorted(ids), list(map(list, spans))) for w, (spans, ids) in found]
        cols = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([part.column(0), *(pa.array(list(c), t) for c, t in zip(cols, kinds))],
                                          names=schema.names)

    return _through(src, src.columns[1], Automata(items, window, **how), finish, schema)


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans (from the first byte of a
    span's first word to the last byte of its last)."""
    at = [m.span() for m in _WORD.finditer(text.translate(ALNUM_TABLE))]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]].rstrip())
        last = at[b - 1][1]
    out.append(text[last:].lstrip())
    return b" ".join(x for x in out if x.strip())


def remove(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW,
           max_coverage: float = 0.5, size_col: str | None = "n_chars", **how) -> DataFrame:
    """Documents without the benchmark passages, columns as given.

    Spans under item windows are cut out of the text, and so are passages that
    a cut brings together. A document of which more than ``max_coverage`` of the
    words (or all) lie in such spans goes. ``size_col`` (if present) becomes the
    new number of characters of a text that was cut; everything else stays byte
    for byte. With more than one round of automata, a cut text passes through all
    rounds again until nothing is found.
    """
    automata = Automata(items, window, **how)
    one = len(automata.rounds) <= 1
    names = docs.columns
    open_col = _new_name("_open", names)
    k = names.index(text_col)

    def cut_spans(first: bool):
        def finish(part, found, machines):
            keep, changed = [], {}
            for i, (words, (spans, _)) in enumerate(found):
                hit = sum(b - a for a, b in spans)
                keep.append(not hit or not first or hit <= max_coverage * len(words))
                if hit and keep[-1]:
                    cut = _cut(part.column(k)[i].as_py().encode(), spans)
                    while one and (again := _find(alnum_words(cut), machines)[0]):
                        cut = _cut(cut, again)
                    changed[i] = cut.decode()
                    keep[-1] = bool(alnum_words(cut))
            if changed:  # only then is the column made anew
                texts = part.column(k).to_pylist()
                new = {text_col: pa.array([changed.get(i, t) for i, t in enumerate(texts)], part.column(k).type)}
                if size_col in names:
                    old = part.column(names.index(size_col))
                    new[size_col] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(old.to_pylist())],
                                             old.type)
                part = replace_columns(part, new)
            if not one:
                part = replace_columns(part, {open_col: pa.array([i in changed for i in range(len(found))], pa.bool_())})
            return part.filter(pa.array(keep, pa.bool_()))
        return finish

    if one:
        return _through(docs, text_col, automata, cut_spans(True), docs.schema)
    todo, done = docs.withColumn(open_col, F.lit(True)), []
    while True:  # each turn takes words out of every text that stays open
        first = not done
        got = write_once(_through(todo, text_col, automata, cut_spans(first), todo.schema), "decontaminated")
        done.append(got.where(~F.col(open_col)))
        todo = got.where(open_col)
        if todo.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop(open_col)
