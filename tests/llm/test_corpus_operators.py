"""Toxicity, phrases and alignment against brute force, and inputs that once broke others."""

import bisect
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

ODD = [(1, "The cat sat. THE CAT sat! the cat sat", "en"), (2, None, "en"), (3, "", None), (4, " \t ", "de"),
       (5, "the cat sat on the mat, the cat sat on the mat", None), (5, "the cat sat on the mat, the cat sat on the mat", None),
       (None, "a  b \n c\r\n d <|endoftext|> e ▁ f", "en"), (2**53 + 1, "x " * 3000 + "end", "en"), (8, " lead\n  two", "fr"),
       (9, "漢字かな 混じり😀文 zażółć gęślą já", "ja\nx y"), (10, "tail ", "en"), (11, "tab\there\n \n x", "en"),
       (12, "no-break space thin .,;: x", "und")]
SHAPE = "doc_id bigint, text string, lang string, label int, block string, n bigint"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 7, "clash", 3) for r in ODD], SHAPE).repartition(3)


# -- phrases ------------------------------------------------------------------------

def brute_phrases(rows, least, first=2000, most=5):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if a >= least and len(g) > 1}
        rows = []
        for g, a in cand.items():
            inside = [b for h, b in cand.items() if len(h) > len(g)
                      and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if any(100 * b >= 100 * a for b in inside):
                continue
            s, k, left, r = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]])
                                for k in range(1, len(g)))
            rows.append((s, a, " ".join(g), left, r))
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, left, r, n[lang], s) for i, (s, a, p, left, r) in enumerate(rows[:first])]
    return sorted(out)


def test_phrase_shards_have_files_of_their_own(spark):
    """No task that lists pairs holds those of several shards at once."""
    from sightline.llm import phrases as P, vocabulary as V
    docs = spark.createDataFrame([("en", f"a b c d{i} " * 9) for i in range(40)], "lang string, text string")
    table = P.shards(docs, "lang", "text", 3, 64)
    value, total = P._frequent(3, 1)
    values = P.write_once(V.by_bucket(table.where("bucket >= 0"), value, 3, total, np.uint64), "test-ids")
    indexed = P.pairs(table, values)
    assert indexed.count() > 4 and len(indexed.inputFiles()) == indexed.count()


@pytest.mark.parametrize("shard_bytes", [64, 12 << 20])
def test_phrases(odd, spark, shard_bytes):
    from sightline.llm import phrases as P
    for least in (2, 3):
        got = P.collocations(odd, least=least, first=4, shard_bytes=shard_bytes, n_buckets=3).drop("left_most", "right_most")
        assert sorted(map(tuple, got.collect())) == brute_phrases(ODD, least, 4)
    assert P.collocations(odd.where("false"), least=1, n_buckets=2).count() == 0
    assert P.collocations(odd.where("text is null"), least=1, n_buckets=2).count() == 0


def test_shards_get_bits_of_their_pairs_not_rows(odd, spark, monkeypatch):
    """Pairs meet in rows of a shard and a bucket: no join has a row for each shard and frequent pair."""
    from sightline.llm import phrases as P
    plans, rows, write = {}, {}, P.write_once

    def watched(df, name, *more):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        out = write(df, name, *more)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(P, "write_once", watched)
    got = P.collocations(odd, least=1, first=4, shard_bytes=64, n_buckets=4).drop("left_most", "right_most")
    assert "Join" not in plans["frequent-pairs"] + plans["phrases"]
    assert 1 < rows["pairs"] and rows["frequent-pairs"] <= 2 * (rows["pairs"] + 1)
    assert sorted(map(tuple, got.collect())) == brute_phrases(ODD, 1, 4)


def test_packed_numbers_come_back():
    from sightline.llm import phrases as P
    for numbers in ([], [0], [3, 0, 2**62, 255, 256], range(70000)):
        assert P.unpacked(P.packed(np.array(numbers, np.int64))).tolist() == list(numbers)


def test_index_lists_every_phrase_once():
    from sightline.llm import phrases as P
    rng = np.random.default_rng(3)
    for size in (1, 2, 40, 400):
        text = np.concatenate(([0], rng.integers(0, 5, size), [0]))
        want = Counter()
        for k in range(2, 6):
            for i in range(len(text) - k + 1):
                g = tuple(text[i:i + k].tolist())
                if 0 not in g:
                    want[g] += 1
        a, b, n = P.pairs_in(text)
        assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == {g: c for g, c in want.items() if len(g) == 2}
        got = [(tuple(w), c) for words, count in P.phrases_in(text) for w, c in zip(words.tolist(), count.tolist())]
        assert len(got) == len(dict(got)) and dict(got) == {g: c for g, c in want.items() if len(g) > 2}


# -- alignment ------------------------------------------------------------------------

def brute_alignment(rows):
    import public_tokenizers as public
    import sentencepiece
    from sightline.llm.alignment import _byte_letters
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    letters, docs, per = _byte_letters(), defaultdict(set), []
    for k, (i, text, _) in enumerate(rows):
        groups, links, a, b = [], Counter(), [], []
        if text:
            a, b = ta.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            ab = [bytes(letters[c] for c in ta.id_to_token(x)) for x in a]
            bb = [bytes([int(sp.id_to_piece(x)[3:5], 16)]) if sp.is_byte(x)
                  else sp.id_to_piece(x).replace("▁", " ").encode() for x in b]
            raw = (" " + text).encode()
            if b"".join(ab) != raw or b"".join(bb) != raw:
                a, b = [], []
            else:
                ea, eb = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
                both = sorted(set(ea) & set(eb))
                groups = [([], []) for _ in both]
                for side, (ids, ends) in enumerate(((a, ea), (b, eb))):
                    for x, e in zip(ids, ends):
                        groups[bisect.bisect_left(both, e)][side].append(x)
                links.update((x, y) for ga, gb in groups for x in ga for y in gb)
        for q in links:
            docs[q].add(k)
        per.append((i, len(a), len(b), groups, links))
    count, top = {q: len(s) for q, s in docs.items()}, Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for i, na, nb, groups, links in per:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, na, nb, len(groups), sum(links.values()), sum(v for q, v in links.items() if count[q] == top[q[0]]),
                    sum(v * count[q] for q, v in links.items()), hashlib.sha256(s.encode()).hexdigest() if na else ""))
    return sorted(out, key=repr), {q: (count[q], sum(p[4][q] for p in per)) for q in count}


@pytest.mark.parametrize("block_bytes", [1, 8 << 20])
def test_alignment(odd, block_bytes):
    from sightline.llm import alignment as A
    want, pairs = brute_alignment(ODD)
    assert sorted(map(tuple, A.align(odd, block_bytes=block_bytes).collect()), key=repr) == want
    assert A.align(odd.where("false")).count() == 0
    got = {(r["a"], r["b"]): (r["documents"], r["links"]) for r in A.links(odd, block_bytes=block_bytes).collect()}
    assert got == pairs


def test_bitmaps_round_trip():
    from sightline.llm.alignment import PairBitmaps
    rng = np.random.default_rng(1)
    for n_docs, n_pairs, share in ((1, 1, 1.0), (3000, 20, 0.3), (5000, 50, 0.01), (0, 0, 0)):
        table = np.where(rng.random((n_pairs, n_docs)) < share, rng.integers(1, 300, (n_pairs, n_docs)), 0)
        pair, doc = np.nonzero(table)
        maps = PairBitmaps.load(PairBitmaps.of(pair, doc, table[pair, doc], n_docs, n_pairs).dump())
        p, d, t = maps.postings()
        assert (p == pair).all() and (d == doc).all() and (t == table[pair, doc]).all()
        assert (maps.links() == table.sum(axis=1)).all() and (maps.documents() == (table > 0).sum(axis=1)).all()


def test_large_groups_multiply_counts(monkeypatch):
    from sightline.llm import alignment as A
    tools = A.pair_of(A.paths_of())
    text, sums = "zażółć gęślą jaźń 漢字かな混じり文 naïve ﷽ end", []
    for cross in (4096, 0):
        monkeypatch.setattr(A, "CROSS", cross)
        c = A.Chunks(tools)
        c.numbers(text)
        c.align()
        total = Counter()
        for p, t in zip(c.pairs, c.times):
            for x, k in zip(p.tolist(), t.tolist()):
                total[x] += k
        sums.append((total, np.concatenate(c.sizes).tolist(), c.text, [sum(w.tolist()) for w in c.widths if len(w)] != []))
    assert sums[0] == sums[1]


# -- toxicity -------------------------------------------------------------------------

def test_noisy_or_and_its_slopes():
    from sightline.llm import toxicity as X
    model = X.Model(["bad.", "awk-"], np.array([3.0, 1.5]), -2.0)
    text = "Good words here. A BAD awful thing! nothing\n...\nawkward"
    p = [1 / (1 + np.exp(-(z - 2.0))) for z in (0, 3.0, 0, 1.5)]
    whole, n, sents = model.judge(text)
    assert n == 4 and abs(whole - (1 - np.prod([1 - x for x in p]))) < 1e-12
    assert [text[a:b].strip() for a, b, _ in sents] == ["A BAD awful thing", "awkward"]
    label, plain = np.array([1, 0, 1]), np.array([2, 1, 0])
    doc, sizes, at = np.array([0, 0, 1, 2]), np.array([2, 1, 1, 2]), np.array([0, 1, 1, 0, 0, 1])
    w, bias = np.array([0.4, -0.3]), -1.0
    grad, curve, _ = X.slopes(w, bias, label, plain, doc, sizes, at)
    like = lambda w, b: X.slopes(w, b, label, plain, doc, sizes, at)[2]
    for k in range(2):
        step = np.eye(2)[k] * 1e-6
        assert abs((like(w + step, bias) - like(w - step, bias)) / 2e-6 - grad[k]) < 1e-6
    assert abs((like(w, bias + 1e-6) - like(w, bias - 1e-6)) / 2e-6 - grad[2]) < 1e-6 and (curve > 0).all()


def test_features_of_a_word():
    from sightline.llm import toxicity as X
    words = ["ab", "abc", "abcd", "schimpfwort", "wort", "xwortes"]
    names = sorted({f for w in words for f in X.word_features(w)})
    model = X.Model(names[::2], np.zeros(len(names[::2])), -1.0)
    for w in [*words, "unbekannt", "abcx"]:
        assert sorted(names[::2][i] for i in model.of_word(w)) == sorted(set(X.word_features(w)) & set(names[::2]))


def test_toxicity_learns_from_document_labels(spark):
    from sightline.llm import toxicity as X
    rng = np.random.default_rng(4)
    words = [f"w{k}x{k % 7}y" for k in range(200)]
    rows, labels = [], []
    for i in range(400):
        sents = [" ".join(rng.choice(words, 8)) for _ in range(6)]
        bad = i % 5 == 0
        if bad:
            sents[int(rng.integers(6))] += f" {rng.choice(['grobian', 'schuft'])} extra"
        rows.append((i, ". ".join(sents), 1, "score"))
        labels.append((i, int(bad)))
    rows += [(1000, None, 1, "x"), (1001, "", 1, "x"), (1002, "...", 1, "x"), (None, "ein grobian extra", 1, "x"), (1, rows[1][1], 1, "x")]
    labels += [(2000, 1), (None, 1), (3, None), (5, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label int, score string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = X.train(docs, marks)
    got = X.score(docs, model).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 50 and all((r["score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in held)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["score"] == 0 and by_id[i]["worst_start"] is None for i in (1000, 1001, 1002))
    assert by_id[None]["score"] >= 0.3
    found = X.locate(docs, model).collect()
    assert all("grobian" in r["sentence"] or "schuft" in r["sentence"] for r in found)
    assert {r["doc_id"] for r in found if r["doc_id"] is not None} == {i for i in range(0, 400, 5)}
    nothing = X.train(docs, marks.where("false"))
    assert {r["score"] for r in X.score(docs, nothing).collect()} == {0.0}
    assert X.score(docs.where("false"), model).count() == 0


# -- inputs that once broke others ------------------------------------------------------

def test_packing_keeps_large_ids_beside_a_null(spark):
    from sightline.llm import packing as P
    ids = [2**53 + 1, None, 2**53 + 3]
    got = P.pack(spark.createDataFrame([(i, "a few words") for i in ids], "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted(ids, key=repr)


def test_nearest_of_tiny_and_huge_vectors(spark):
    from sightline.llm import nndescent as N
    rows = [(0, [1e-200, 0.0, 1e-200]), (1, [1e200, 0.0, 1e200]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 5e-324, 0.0]), (50, [2.0, 0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in N.nearest(df, N.F.col("id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    half = round(0.5 ** 0.5, 9)
    assert sorted(got[0]) == [(1, 1, 1.0), (2, 50, 1.0), (3, 2, half), (4, 3, 0.0)]
    assert sorted(got[50]) == [(1, 0, 1.0), (2, 1, 1.0), (3, 2, half), (4, 3, 0.0)]


def test_language_votes_match_a_plain_loop_and_the_sample_is_bounded(spark):
    from sightline.llm import langid as G
    text = "Ein  Satz\nmit Wörtern " * 50
    plain = Counter()
    s = f" {re.sub(chr(92) + 's+', ' ', text.lower()).strip()} "
    for i in range(len(s)):
        h = 0
        for n in range(1, 4):
            if i + n <= len(s):
                h = (h + ord(s[i + n - 1]) + n) * 0x9E3779B97F4A7C15 % 2**64
                plain[h >> 50] += 1
                h ^= h >> 29
    want = np.bincount(list(plain), list(plain.values()), 1 << G.BITS)
    assert (G.gram_counts(text) == want).all()
    old, G.STRETCH = G.STRETCH, 7
    try:
        assert (G.gram_counts(text) == want).all()
    finally:
        G.STRETCH = old
    rng = np.random.default_rng(2)
    model = G.Model(["a", "b"], {"a": ["a1", "a2"], "b": ["b1"]}, [("", "a", "b"), ("a", "a1", "a2")],
                    rng.normal(size=(1 << G.BITS, 2)).astype(np.float32), np.array([0.1, -0.2]))
    share = want / want.sum()
    m = [float(sum(share[i] * float(model.weights[i, k]) for i in np.flatnonzero(share))) + model.bias[k] for k in range(2)]
    sure = [1 / (1 + np.exp(-4 * abs(x))) for x in m]
    want = ("b1", sure[0]) if m[0] < 0 else (("a1" if m[1] >= 0 else "a2"), sure[0] * sure[1])
    got = model.predict(text)
    assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9
    rows = [(7, f"text {k}", "xx") for k in range(500)] + [(k, "hallo", "yy") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = Counter(r["lang"] for r in G.sample(df, "doc_id", "text", "lang", G.F.lit(True), 10).collect())
    assert got == {"xx": 10, "yy": 10}


def test_long_text_does_not_grow_with_the_machines():
    import tracemalloc

    from sightline.llm import langid as G
    names = ["a", "b", "c", "d"]
    model = G.Model(names, {n: [n] for n in names}, [("", x, y) for i, x in enumerate(names) for y in names[i + 1:]],
                    np.zeros((1 << G.BITS, 6), np.float32), np.zeros(6))
    text = "wort " * 4_000_000  # 20 MB
    tracemalloc.start()
    model.predict(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


def test_counts_beyond_32_bits(spark):
    from sightline.llm import vocabulary as V
    big = 2**32 - 5
    rows = [(b, 0, b"the\n", np.array([big], np.uint32).tobytes()) for b in range(3)]
    df = spark.createDataFrame(rows, "block bigint, bucket int, pieces binary, marks binary")
    got = V.by_bucket(df, lambda p, c, _: c, 1, kind=np.uint64).collect()
    assert {np.frombuffer(r["values"], np.uint64)[0] for r in got} == {3 * big}
    with pytest.raises(Exception, match="does not fit"):
        V.by_bucket(df, lambda p, c, _: c, 1).collect()


@pytest.mark.parametrize("block", [512, 7])
def test_family_of_near_copies_below_and_above_the_threshold(spark, block, monkeypatch):
    from sightline.llm import minhash as M
    monkeypatch.setattr(M, "BLOCK", block)
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(1, 5)), replace=False):
            words[at] = f"n{i}x{at}"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(116)} for i, t in rows}
    root = {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for x in sets:
        for y in sets:
            if x < y and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    got = M.groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: find(i) for i in sets}
