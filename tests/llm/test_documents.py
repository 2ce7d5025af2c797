"""Operators over documents against brute force on small fixtures: nulls,
empty and very long texts, ties, repeated rows, clashing extra columns."""

import hashlib
import json
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

LOREM = ("the law of the sea and the art of the deal is that over it was on by for an "
         "old tree near a long river where nine men rest at noon").split()


def text_of(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(LOREM[i] + str(rng.integers(0, 40)) for i in rng.integers(0, len(LOREM), n))


BASE = text_of(1, 120)
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ROWS = [
    (1, BASE), (2, BASE.upper()), (3, BASE + " more"), (4, text_of(2, 80)), (5, None), (6, ""),
    (7, "  \n\t "), (8, "one two"), (9, "ONE  two"), (10, "!!! ... 123 _"),
    (11, "é " * 30 + "  double  blanks \n\n end "), (12, " ".join(text_of(k, 700) for k in range(12))),
    (13, text_of(3, 60) + " " + PASSAGE + " " + text_of(4, 60)), (14, PASSAGE.upper() + " tail"),
    (15, "Licensed under the Apache License, Version 2.0. CC BY and cc-by MIT License"),
    (16, "x" * 5000), (17, "a<|endoftext|>b \u0001\u0000 ▁z"), (4, text_of(2, 80)), (4, text_of(5, 70)),
    (18, " ".join(text_of(2, 80).split()[:70])), (None, "no id at all"), (None, None),
    (19, "GNU General Public License gnu general public license, version 3 or later"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if t and "law" in t else None, "src", 7, "clash", 1.5) for i, t in ROWS]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score double"
    ).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def split_blank(t):
    return (t or "").encode().lower().split()


def split_alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_token_counts(docs, none):
    from sightline.llm import token_counts as TC
    sp = TC.load(TC.model_path())
    got = rows_of(TC.count_tokens(docs).select("doc_id", "n_tokens", "n_bytes"))
    assert got == sorted(((i, len(sp.encode(t or "")), len((t or "").encode())) for i, t in ROWS), key=str)
    assert TC.count_tokens(none).count() == 0


def test_pre_tokens_are_exact():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from sightline.llm import token_counts as TC
    sp = TC.load(TC.model_path())

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from(list("ab \n\0\1\t\r▁é<s>{") + ["the ", "  ", "語"]), max_size=12).map("".join))
    def check(t):
        if t:
            c = TC.pre_tokens(t)
            n = TC.piece_counts(TC.model_path(), [k.encode() for k in c])
            assert int(np.dot(n, list(c.values()))) == len(sp.encode(t))

    check()


def test_packing_round_trip(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    from sightline.llm import packing as P
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    ids = [np.array(tk.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t in ROWS]
    got = P.pack(docs, window=256).toPandas()
    assert got["length"].sum() == sum(map(len, ids))
    # every piece is a slice of a document of that id
    for r in got.itertuples():
        mine = [x for (i, _), x in zip(ROWS, ids) if (i is None) == (r.doc_id != r.doc_id) and (i is None or i == r.doc_id)]
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for x in mine)
        want[(str(r.doc_id), r.start)] += 1
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *g["length"].cumsum()[:-1]] and g["length"].sum() <= 256
    assert P.pack(none).count() == 0


def test_tokens_equal_the_tokenizer():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    from sightline.llm import packing as P
    paths = P.tokenizer_paths()
    tk, own = Tokenizer.from_file(paths[0]), P.tokens_of(paths)

    @settings(max_examples=400, deadline=None)
    @given(st.text(max_size=30) | st.lists(st.sampled_from(
        [*"ab1.,'s \n\t\u00c0\u00a0\u3000\u00ff", "  ", "<|endoftext|>", " ll"]), max_size=20).map("".join))
    def check(t):
        assert np.frombuffer(own.ids(t), "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids

    check()


def test_plan_uses_every_length_once():
    from sightline.llm import packing as P
    rng = np.random.default_rng(3)
    hist = np.zeros(256, np.int64)
    np.add.at(hist, rng.integers(1, 256, 500), 1)
    hist[200] += 3000  # one length holds most rows
    rows = P.plan(hist, 256, 16)
    filled, cover = Counter(), Counter()
    for whole, lo, hi, start, size, first, offset in rows.tolist():
        assert hi > lo and size > 0
        cover[whole] += (hi - lo) * size
        for k in range(hi - lo):
            filled[first + k] += size
    assert cover == Counter({n: n * int(c) for n, c in enumerate(hist) if c})
    assert max(filled.values()) <= 256 and len(rows) < 5000
    assert sum(256 - v >= 16 for v in filled.values()) <= 1  # padding stays below the grid


def test_components_against_union_find(spark):
    from sightline.llm.components import components
    rng = np.random.default_rng(5)
    ids = rng.integers(-2**62, 2**62, 300).tolist()
    links = [(ids[i], ids[j]) for i, j in rng.integers(0, 300, (170, 2)).tolist()]
    links += [(ids[0], ids[k]) for k in range(1, 40)] + [(x, y) for x, y in zip(ids[100:140], ids[101:140])]
    root = {x: x for pair in links for x in pair}
    for _ in range(len(root)):
        for x, y in links:
            root[x] = root[y] = min(root[x], root[y])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == root
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = split_blank(t)
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = group[a], group[b]
                group = [y if g == x else g for g in group]
    out = []
    for k, (i, _) in enumerate(rows):
        if sets[k]:
            mine = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
            comp = min(mine, default=None)
        else:
            comp = i
        out.append((i, len(sets[k]), comp, comp == i))
    return sorted(out, key=str)


def test_near_duplicates(docs, none):
    from sightline.llm import minhash as M
    assert rows_of(M.groups(docs)) == brute_components(ROWS)
    assert M.groups(none).count() == 0


def test_near_duplicate_chain_and_open_buckets(spark):
    """A chain of texts, each near the next only, and two families whose hubs
    fail against each other: links beyond the first star are found."""
    from sightline.llm import minhash as M
    words = [f"w{k}" for k in range(400)]
    rows = [(100 - k, " ".join(words[12 * k:12 * k + 150])) for k in range(12)]
    rows += [(200 + k, text_of(9, 200) + " " + text_of(50 + k, 20)) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert rows_of(M.groups(docs)) == brute_components(rows)


def test_first_of_each_keeps_one_row_and_columns(docs):
    from sightline.llm import minhash as M
    left = M.first_of_each(docs)
    assert left.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in left.collect())
    assert got[(1, BASE)] == 1 and (2, BASE.upper()) not in got and (3, BASE + " more") not in got
    assert got[(4, text_of(2, 80))] == 1 and got[(4, text_of(5, 70))] == 1
    assert got[(5, None)] == 1 and got[(6, "")] == 1 and got[(None, "no id at all")] == 1


def test_hidden_markov_scores(docs, none):
    from sightline.llm import hmm as H
    train = [t for i, t in ROWS if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for t in train for w in [*split_blank(t), None])
    n, v = sum(count.values()), len(count)
    got = H.score(docs, states=3, rounds=3).collect()
    assert len(got) == len(ROWS)
    want = sorted((str(i), len(split_blank(t)) + 1, sum(count[w] > 0 for w in [*split_blank(t), None]),
                   round(sum(np.log10((count[w] + .5) / (n + .5 * (v + 1))) for w in [*split_blank(t), None]), 6))
                  for i, t in ROWS)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and np.isfinite(r["score"]) for r in got)
    assert H.score(none).count() == 0


def test_forward_and_expected_counts_against_enumeration():
    from itertools import product

    from sightline.llm import hmm as H
    rng = np.random.default_rng(2)
    chain = H.Chain.start(3)
    chain.first, chain.later = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3))
    seqs = [rng.integers(0, 5, n) for n in (5, 1, 3)]

    def paths(s, start):
        for p in product(range(3), repeat=len(s)):
            w = start[p[0]] * chain.emit[s[0], p[0]]
            for t in range(1, len(s)):
                w *= chain.move[p[t - 1], p[t]] * chain.emit[s[t], p[t]]
            yield p, w

    total = [sum(w for _, w in paths(s, chain.first)) for s in seqs]
    assert np.allclose(chain.log_probability(seqs), np.log10(total))
    long = [rng.integers(0, 5, 700), rng.integers(0, 5, 33)]
    a = [chain.first * chain.emit[s[0]] for s in long]
    logs = np.zeros(2)
    for k, s in enumerate(long):
        for c in s[1:]:
            a[k] = (a[k] @ chain.move) * chain.emit[c]
            logs[k] += np.log10(a[k].sum())
            a[k] = a[k] / a[k].sum()
        logs[k] += np.log10(a[k].sum()) + np.log10((chain.first * chain.emit[s[0]]).sum()) * 0
    assert np.allclose(chain.log_probability(long), logs)
    order = np.argsort([-len(s) for s in seqs])
    table = np.full((3, 5), H.END)
    for r, k in enumerate(order):
        table[r, :len(seqs[k])] = seqs[k]
    opens = np.array([True, False, True])
    first, later, move, emit = chain.expect(table, np.array([5, 3, 1]), opens)
    want_move, want_emit = np.zeros((3, 3)), np.zeros((H.CLASSES, 3))
    for r, k in enumerate(order):
        s = seqs[k]
        every = list(paths(s, chain.first if opens[r] else chain.later))
        z = sum(w for _, w in every)
        for p, w in every:
            for t, h in enumerate(p):
                want_emit[s[t], h] += w / z
                if t:
                    want_move[p[t - 1], h] += w / z
    assert np.allclose(move, want_move) and np.allclose(emit, want_emit)
    assert np.isclose(first.sum(), 2) and np.isclose(later.sum(), 1)


def test_baum_welch_raises_the_likelihood(spark, sf_small):
    from sightline.llm import hmm as H
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    by = {n: H.score(docs, rounds=n).agg(F.sum("score"), F.sum("base_score")).first() for n in (1, 6)}
    assert by[6][0] > by[1][0] > by[6][1]


def test_licenses(docs, none):
    from sightline.llm import licenses as L
    rules = L.rules()
    assert len(rules) > 200
    want = []
    for i, t in ROWS:
        w = split_alnum(t)
        line = " " + " ".join(w) + " " if w else " "
        base = [(k, lab) for ph, lab in L.BASE.items() for k in range(len(w)) if w[k:k + len(ph.split())] == ph.split()]
        found = set()
        for p, lab, _, rx in rules:
            for m in re.finditer(f"(?<= )(?=(?:{rx}) )", line):
                hit = re.compile(f"(?:{rx})(?= )").match(line, m.start()).group()
                s = line[:m.start()].count(" ") - 1
                found.add((s, s + hit.count(" "), p, lab))
        kept = {x for x in found if not any(
            y != x and y[0] <= x[0] and y[1] >= x[1] and y[2] <= x[2] and (y[:3] != x[:3] or y[3] < x[3]) for y in found)}
        names = sorted({b for _, b in base})
        want.append((i, len(w), len(base), min((k for k, _ in base), default=None),
                     max((k for k, _ in base), default=None), ",".join(names),
                     ",".join(sorted({*names, *(x[3] for x in kept)}))))
    got = L.summary(L.scan(docs))
    assert rows_of(got.drop("score")) == sorted(want, key=str)
    assert got.where("score < 0 or score > 1 or (labels = '') <> (score = 0)").count() == 0
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert L.summary(L.scan(none)).count() == 0


def minimal(regex):
    """A shortest text of a rule: options left out, first alternatives."""
    for old, new in ((r"\(\?:[^()]*\)(?:\?|\{0,6\})", ""), (r"\(\?:([^()|]*)[^()]*\)", r"\1"), (r"\[cs\]", "c"),
                     (r"\[\^ \]\{1,40\}", "x"), (r"\[0-9\]", "2"), (r".\?", "")):
        regex = re.sub(old, new, regex)
    return regex


def test_each_license_rule_passes_the_gate(spark):
    from sightline.llm import licenses as L
    texts = [(i, minimal(rx)) for i, (*_, rx) in enumerate(L.rules())]
    assert all(re.fullmatch(L.rules()[i][3], t) for i, t in texts)
    said = {9001: ("SPDX-License-Identifier: LGPL-2.1", "lgpl-2.1"), 9002: ("SPDX-License-Identifier: AGPL-3.0", "agpl-3"),
            9003: ("SPDX-License-Identifier: 0BSD", "0bsd"), 9004: ("FreeBSD License", "bsd-2-clause-freebsd")}
    df = spark.createDataFrame(texts + [(i, t) for i, (t, _) in said.items()], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in L.summary(L.scan(df)).collect()}
    assert [t for i, t in texts if not got[i]["score"] > 0] == []
    for i, (_, label) in said.items():
        assert label in got[i]["labels"].split(","), (i, got[i]["labels"])


def test_language(spark, sf_mid, docs, none):
    from sightline.llm import langid as G
    real = spark.read.parquet(f"{sf_mid}/documents.parquet")
    model = G.train(real, G.learnable("doc_id", "lang"), per_language=150)
    got = G.identify(real, model).join(real, "doc_id").withColumn("out", G.held_out_digit("doc_id") == 2)
    rate = got.where("out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert rate > 0.98
    odd = {r["doc_id"]: r for r in G.identify(docs, model).collect()}
    for k in (5, 6, 7, 10):
        assert odd[k]["lang_pred"] == "und" and odd[k]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    assert G.accepted(docs, model).columns == docs.columns
    assert {5, 6, 7, 10}.isdisjoint(r["doc_id"] for r in G.accepted(docs, model).collect())
    nothing = G.train(none, G.learnable("doc_id", "lang"))
    assert {r["lang_pred"] for r in G.identify(docs, nothing).collect()} == {"und"}
    one = G.train(docs, G.learnable("doc_id", "lang"))
    assert {r["lang_pred"] for r in G.identify(docs, one).collect()} == {"en", "und"}
    assert G.identify(none, model).count() == 0


def brute_hits(text, items):
    w, hit, found = split_alnum(text), set(), set()
    for item, t in items:
        iw = split_alnum(t)
        n = min(10, len(iw))
        grams = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)} if n else set()
        for k in range(len(w) - n + 1 if n else 0):
            if tuple(w[k:k + n]) in grams:
                hit |= set(range(k, k + n))
                found |= {str(item)} if item is not None else set()
    return w, hit, found


ITEMS = [(1, PASSAGE), (22, "short item"), (3, None), (4, ""), (5, "two"), (1, PASSAGE), (None, text_of(2, 15)),
         (6, "zeta eta theta iota kappa lambda mu nu xi omicron pi")]


@pytest.mark.parametrize("shard, at_once", [(100_000, 4), (5, 100), (15, 1)])
def test_decontamination_scan(spark, docs, none, shard, at_once):
    from sightline.llm import decontaminate as D
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {}
    for r in D.scan(docs, items, shard_words=shard, at_once=at_once).collect():
        got.setdefault(str(r["doc_id"]), []).append((r["n_words"], r["n_hit"], sorted(r["item_ids"]),
                                                     sorted(p for a, b in r["spans"] for p in range(a, b))))
    want = {}
    for i, t in ROWS:
        w, hit, found = brute_hits(t, ITEMS)
        want.setdefault(str(i), []).append((len(w), len(hit), sorted(found), sorted(hit)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert D.scan(docs, items.where("false")).agg(F.sum("n_hit")).first()[0] == 0
    assert D.scan(none, items).count() == 0
    assert D.digest(["2", "10"]) == hashlib.sha256(b"10,2").hexdigest()


def test_automaton_against_brute_force():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from sightline.llm.decontaminate import SuffixAutomaton
    words = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(words, max_size=4), words)
    def check(items, doc):
        a = SuffixAutomaton.build([(k, w) for k, w in enumerate(items) if w], 4)
        spans, found = a.hits(doc)
        hit, want = set(), set()
        for k, w in enumerate(items):
            n = min(4, len(w))
            for i in range(len(doc) - n + 1 if n else 0):
                if any(doc[i:i + n] == w[j:j + n] for j in range(len(w) - n + 1)):
                    hit |= set(range(i, i + n))
                    want.add(k)
        assert {p for x, y in spans for p in range(x, y)} == hit and found == want

    check()


def test_automaton_keeps_arrays_and_survives_pickling():
    import pickle

    from sightline.llm.decontaminate import SuffixAutomaton
    words = [b"w%d" % (i * i % 101) for i in range(3000)]
    a = SuffixAutomaton.build([(1, words), (2, words[500:900])], 10)
    b = pickle.loads(pickle.dumps(a))
    assert not b.step and len(b.many) < len(b.only) / 2
    spans, found = b.hits([b"other", *words[600:640], b"other"])
    assert spans == [(1, 41)] and found == {1, 2}


@pytest.mark.parametrize("how", [{}, {"shard_words": 3, "at_once": 1}])
def test_decontamination_cuts_what_a_cut_brings_together(spark, how):
    from sightline.llm import decontaminate as D
    x, y, z = ([f"{c}{i}" for i in range(12)] for c in "xyz")
    items = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate((x, y, z))], "item_id bigint, text string")
    rest = " ".join(f"r{i}" for i in range(60))
    nested = " ".join([*x[:6], *y[:6], *z, *y[6:], *x[6:]])
    rows = [(1, f"{rest} {nested}", 5), (2, rest, 5), (3, None, 5), (4, "", 5), (5, nested, 5), (1, f"{rest} {nested}", 5)]
    got = D.remove(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int"), items, **how)
    assert sorted((r["doc_id"], r["text"] or "", r["n_chars"]) for r in got.collect()) == [
        (1, rest, len(rest)), (1, rest, len(rest)), (2, rest, 5), (3, "", 5), (4, "", 5)]


@pytest.mark.parametrize("how", [{}, {"shard_words": 20, "at_once": 1}])
def test_decontamination_cuts_passages_and_keeps_clean_texts(spark, docs, how):
    from sightline.llm import decontaminate as D
    others = [(k, " ".join(f"other{k}x{i}" for i in range(12))) for k in range(2, 6)]
    items = spark.createDataFrame([(1, PASSAGE), *others], "item_id bigint, text string")
    left = D.remove(docs, items, **how)
    assert left.schema == docs.schema
    got = {(r["doc_id"], r["text"]): r["n_chars"] for r in left.collect()}
    clean = [(i, t) for i, t in ROWS if not brute_hits(t, [(1, PASSAGE)])[1]]
    assert all((i, t) in got and got[(i, t)] == 7 for i, t in clean)
    cut = text_of(3, 60) + " " + text_of(4, 60)
    assert got[(13, cut)] == len(cut) and not any(i == 14 for i, _ in got)


def test_entry_without_the_folder(tmp_path):
    """The entry module works when the operators are deleted."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{root}/sightline", tmp_path / "sightline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e, json; print(json.dumps(sorted(e.queries())))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": str(tmp_path)})
    names = json.loads(out.stdout.strip().splitlines()[-1])
    assert "period_summary" in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
