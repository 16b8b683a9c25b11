"""The corpus operators against brute-force versions on a small fixture with
null, empty, long, tied and repeated rows and extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orderlake.llm import (bagminhash, deep_shallow, extendible, importance, kneser_ney, licences, pieces, queries,
                           sentence_spans, tiling, wavelet)
from orderlake.llm.common import SHINGLE_PATTERN, read

SCHEMA = "doc_id long, text string, span string, row int, hash string"
RND = random.Random(3)
WORDS = ["".join(RND.choices("abcdefghijklmnopéß", k=RND.randint(1, 9))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(w + (".\n" if r.random() < .05 else "." if r.random() < .1 else "") for w in r.choices(WORDS, k=n))


def fixture_rows():
    passage = prose(70, 1000) + "."
    rows = [(i, prose(RND.randint(3, 120), i)) for i in range(1, 40)]
    rows += [(40 + i, f"{prose(30, 200 + i)}.\n{passage}\n{prose(20, 300 + i)}") for i in range(6)]
    base = prose(150, 77).split(" ")
    rows += [(60 + i, " ".join(base[:70 + i] + ["xx"] + base[71 + i:])) for i in range(5)]
    rows += [(70, None), (71, ""), (72, ""), (73, " \n "), (74, "a"), (75, "a"), (75, "a"), (None, "null id"),
             (None, prose(20, 5)), (76, prose(20, 5)), (3, prose(30, 3)), (80, prose(6000, 80)), (81, prose(6000, 80)),
             (82, "漢字 😀 ▁ ab  cd <|endoftext|> it's x=≠"), (83, "z" * 300), (84, "z" * 120)]
    return [(i, t, "s", 1, "h") for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return fixture_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_op1_wavelet(docs, rows, empty):
    tok = Tokenizer.from_file(queries.WORD_BPE)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for r in order:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    shards = wavelet.write_token_shards(docs, queries.WORD_BPE, shard_tokens=500)
    assert got(wavelet.token_documents(shards), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert wavelet.token_documents(wavelet.write_token_shards(empty, queries.WORD_BPE)).count() == 0


def test_wavelet_matrix():
    x = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(x).to_bytes())
    assert (w.decode() == x).all() and (w.access(np.arange(5000)) == x).all()
    for s in (0, 7, 299, 300, 70000):
        at = np.flatnonzero(x == s)
        assert w.count(s) == len(at) and w.locate(s).tolist() == at.tolist()
        assert w.rank(s, 1234) == (at < 1234).sum()
        assert [w.select(s, k) for k in range(len(at))] == at.tolist() and w.select(s, len(at)) == -1


def brute_sentences(text):
    return [m for m in re.split(r"(?<=[.!?])[ \t\n\r\x0b\x0c]+|[ \t\r\x0b\x0c]*\n[ \t\n\r\x0b\x0c]*", text.strip(" \t\n\r\x0b\x0c")) if m]


@pytest.mark.parametrize("least", [0, 20])
def test_op2_spans(docs, rows, empty, least):
    def spans(s):
        n, out = [len(re.findall(r"[^ \t\n\r\x0b\x0c]+", x)) for x in s], set()
        if not least:  # every run of two sentences or more
            return [(i, j) for i in range(len(s)) for j in range(i + 1, min(len(s), i + 9))]
        for i in range(len(s)):
            j = next((j for j in range(i + 1, len(s)) if sum(n[i:j + 1]) >= least), None)
            k = next((k for k in range(i - 1, -1, -1) if sum(n[k:i + 1]) >= least), None)
            out |= {(i, j)} if j is not None else set()
            out |= {(k, i)} if k is not None else set()
        return sorted(out)
    key = lambda s: tuple(re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in s)
    first = {}
    ids = lambda i: -math.inf if i is None else i
    split = [(r[0], brute_sentences(r[1] or "")) for r in rows]
    for i, s in split:
        for a, b in spans(s):
            k = key(s[a:b + 1])
            first[k] = min(first.get(k, math.inf), ids(i))
    want = []
    for i, s in split:
        gone, seen = set(), set()
        for a, b in spans(s):
            k = key(s[a:b + 1])
            if first[k] < ids(i) or k in seen:
                gone |= set(range(a, b + 1))
            seen.add(k)
        want.append((i, len(s), len(gone), [x for n, x in enumerate(s) if n not in gone]))
    out = sentence_spans.remove_repeated_spans(docs, least)
    left = [(r["doc_id"], r["n_sentences"], r["n_removed"], brute_sentences(r["text"])) for r in out.collect()]
    assert [x[:3] for x in sorted(left, key=repr)] == [x[:3] for x in sorted(want, key=repr)]
    # What is left is the sentences that stay, also after they have moved together.
    joined = lambda xs: sorted((i, "".join("".join(s).split())) for i, *_, s in xs if i is not None)
    assert joined(left) == joined(want)
    clean = {r["doc_id"]: r["text"] for r in out.where("n_removed = 0 and doc_id < 40").collect()}
    assert all(clean[r[0]] == r[1] for r in rows if r[0] in clean and r[0] != 3)
    assert sentence_spans.remove_repeated_spans(empty, least).count() == 0


def test_op2_short_sentences(spark):
    docs = spark.createDataFrame([(1, "Click here now. Buy one today."), (2, "Own words. Click here now. Buy one today. More."),
                                  (3, "click here NOW.  Buy one today.")], "doc_id long, text string")
    out = {r["doc_id"]: (r["n_removed"], r["text"]) for r in sentence_spans.remove_repeated_spans(docs).collect()}
    assert out == {1: (0, "Click here now. Buy one today."), 2: (2, "Own words. More."), 3: (2, "")}


def brute_substrings(rows):
    seen, ids = {}, lambda i: -math.inf if i is None else i
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for i, t in texts:
        for k in range(len(t) - 49):
            seen[t[k:k + 50]] = min(seen.get(t[k:k + 50], math.inf), ids(i))
    want = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - 49):
            if seen[t[k:k + 50]] < ids(i):
                gone[k:k + 50] = True
        gone = gone[:len(t)]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        want.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(want, key=repr)


def test_op3_substrings(docs, rows, empty):
    out = deep_shallow.remove_repeats(docs)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_substrings(rows)
    assert deep_shallow.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("owner", [32 << 20, 1 << 12])
def test_op3_reused_ids_and_long_neighbours(spark, monkeypatch, owner):
    """Other texts of an id that also holds a copy; long texts of near ids; many owners."""
    monkeypatch.setattr(deep_shallow, "OWNER_BYTES", owner)
    a, b, c = prose(40, 1), prose(40, 2), prose(40, 3)
    rows = [(1, a), (5, a), (5, b), (5, b), (None, c), (None, c), (6, c), (7, b[:120] + c), (5, a)]
    rows += [(100 + k, prose(6000, 50 + k % 3)) for k in range(6)] + [(200 + k, prose(12, k)) for k in range(40)]
    out = deep_shallow.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_substrings(rows)


@pytest.mark.parametrize("letters", [1, 2, 20])
def test_deep_shallow_sort(letters):
    r = np.random.default_rng(letters)
    t = r.integers(97, 97 + letters, 2000).astype(np.uint8)
    t[1000:1300] = t[200:500]
    starts = r.permutation(1900)[:900]
    order, cls = deep_shallow.deep_shallow_sort(t, starts)
    s = [t[i:i + 50].tobytes() for i in starts[order]]
    assert s == sorted(s) and [a != b for a, b in zip(s, s[1:])] == (np.diff(cls) > 0).tolist()


def multiset(text):
    w = re.findall(SHINGLE_PATTERN, (text or "").lower())
    return Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def test_op4_near_duplicates(docs, rows, empty):
    sets = [(r[0], multiset(r[1])) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in sets:
        for j, b in sets:
            if i < j and (a == b or sum((a & b).values()) >= .8 * sum((a | b).values())):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    want = sorted((i, find(i)) for i, _ in sets)
    assert sorted(got(bagminhash.near_duplicates(docs), "doc_id", "class_id")) == want
    assert bagminhash.near_duplicates(empty).count() == 0


def test_op4_blocks_of_a_large_group(spark, monkeypatch):
    # One group of 40 members, each a class of its own; pairs (i, i + 20) agree.
    monkeypatch.setattr(bagminhash, "BLOCK", 3)
    r = np.random.default_rng(5)
    sign = r.integers(0, 1 << 32, (20, bagminhash.SLOTS), np.uint32)
    full = b"\xff" * bagminhash.CELLS
    # All meet in bands 0 and 1; each pair is told by band 0 only.
    members = spark.createDataFrame([(band, 0, 40, i, i, 100, sign[i % 20].tobytes(), full) for i in range(40) for band in (0, 1)],
                                    "band int, hash long, n long, doc_id long, class_id long, size long, signature binary, cells binary")
    assert sorted(got(bagminhash._apart(members, 0.8), "a", "b")) == [(i, i + 20) for i in range(20)]


def test_op4_cells_of_very_long_texts(spark):
    # Sizes beyond what 255 in every cell can bound.
    sign = np.arange(bagminhash.SLOTS, dtype=np.uint32).tobytes()
    members = spark.createDataFrame([(0, 0, 3, i, i, 700_000, sign, b"\xff" * bagminhash.CELLS) for i in (1, 2)],
                                    "band int, hash long, n long, doc_id long, class_id long, size long, signature binary, cells binary")
    assert got(bagminhash._apart(members, 0.8), "a", "b") == [(1, 2)]


def test_bagminhash_estimates_weighted_jaccard():
    r = np.random.default_rng(2)
    keys = r.integers(1, 1 << 62, 60).astype(np.uint64)
    a, b = r.integers(0, 9, 60), r.integers(0, 9, 60)
    doc = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
    sign = bagminhash.signatures(doc, np.r_[keys[a > 0], keys[b > 0]], np.r_[a[a > 0], b[b > 0]], 2, slots=4000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sign[0] == sign[1]).mean() - true) < 0.04 and np.isfinite(sign).all()


def test_op5_importance(spark, empty):
    rows = [(i, prose(40, i) + (" vile rotten" if i % 3 == 0 else ""), 1) for i in range(600)] + [(9000, None, 1), (9001, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(0, 600, 2)] + [(5, None, None)],
                                   "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r["selected"] for r in importance.select_documents(docs, labels).collect()}
    odd = [i for i in range(600) if i % 2]  # not labelled
    assert not any(out[i] for i in odd if i % 3 == 0) and all(out[i] for i in odd if i % 3) and out[9000]
    kept = importance.keep_selected(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in out.items() if s}
    no_labels = labels.limit(0)
    assert importance.select_documents(docs, no_labels).where("selected").count() == len(rows)
    assert importance.select_documents(empty, labels).count() == 0
    values = spark.createDataFrame([(float(v),) for v in [3, 1, 2, 2, -5, 2, 1e9]], "v double")
    assert [importance.kth_largest(values, "v", k) for k in (1, 2, 3, 5, 7)] == [1e9, 3, 2, 2, -5]


def test_op5_repeats(spark):
    # Good and bad texts hold a doubled word and "mm"; only bad ones one word many times in a row, or "mm" often.
    def text(i):
        w = prose(60, 7000 + i).split(" ")
        word = "".join(random.Random(i).choices("qrstuvw", k=6))
        bad = [(word + " ") * (12 + i % 9), " ".join(f"mm {x}" for x in w[:20])][i % 2]
        return f"{' '.join(w)} {word} {word} mm {bad if i % 3 == 0 else ''}"
    docs = spark.createDataFrame([(i, text(i)) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r["selected"] for r in importance.select_documents(docs, labels).collect()}
    assert [i for i in range(400, 600) if out[i]] == [i for i in range(400, 600) if i % 3]  # not labelled


def test_op6_licences(spark):
    files = spark.createDataFrame([
        (1, "a/LICENSE", "Some words\nReleased under the MIT License.", "x"), (2, "a/b/c/x.py", "nothing here", "x"),
        (3, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0.", "x"), (4, "a/y.py", None, "x"),
        (5, "q/z.py", "# Licensed under CC BY-NC 4.0.\ncode", "x"), (6, "q/w.py", "the license of the version", "x"),
        (7, None, "", "x"), (2, "a/b/c/x.py", "nothing here", "x")], "file_id long, path string, text string, row string")
    out = got(licences.scan(files), "file_id", "licence", "how", "from_dir")
    assert out == sorted([(1, "MIT", "file", None), (2, "Apache-2.0", "inherited", "a/b"), (2, "Apache-2.0", "inherited", "a/b"),
                          (3, "Apache-2.0", "file", None), (4, "MIT", "inherited", "a"), (5, "CC-BY-NC-4.0", "header", None),
                          (6, None, "none", None), (7, None, "none", None)], key=repr)
    assert licences.scan(files.limit(0)).count() == 0
    plan = licences.scan(files)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_op6_statements_among_words(spark):
    said = ["Released under the MIT License. See the LICENSE file for details.", "Copyright (c) 2020 Foo Inc. Released under the MIT License.",
            "# foo bar.  Released\n# under the MIT\n# License. Go on", "This project is licensed under the MIT License.",
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance.',
            "# This library, foo, is licensed under the GNU Lesser\n# General Public License, version 3, or later"]
    plain = [(100 + i, f"{prose(30, 900 + i)} the use of this project is under all work and foo", "x/y") for i in range(100)]
    files = spark.createDataFrame([(i, t, "x/y") for i, t in enumerate(said)] + plain, "file_id long, text string, path string")
    assert got(licences.scan(files).where("how <> 'none'"), "file_id", "licence", "how") == sorted(
        [(i, x, "header") for i, x in enumerate(["MIT", "MIT", "MIT", "MIT", "Apache-2.0", "LGPL-3.0"])], key=repr)


def test_op6_counts_all_terms(spark):
    # The same five words beside a licence's: common ones leave the cosine of the line high, rare ones don't.
    line = "released under the mit license alpha beta gamma delta epsilon"
    def cosine(common):
        files = spark.createDataFrame([(1, line + ".", "a")] + [(i, "alpha beta gamma delta epsilon" if common else "zeta", "b")
                                                                for i in range(2, 200)], "file_id long, text string, path string")
        whole = {"X": "released under the mit license and nothing else whatever follows it here"}
        return licences.scan(files, 0.1, whole).where("file_id = 1").first()["cosine"]
    assert cosine(True) > cosine(False) + 0.1


def brute_tiling(text, item, least=5):
    t, w, marked = list(text), list(item), 0
    while True:
        best = [(k, -j, -i) for i in range(len(t)) for j in range(len(w))
                for k in [next((k for k in range(min(len(t) - i, len(w) - j)) if t[i + k] != w[j + k]), min(len(t) - i, len(w) - j))]]
        k, j, i = max(best, default=(0, 0, 0))
        if k < least:
            return marked
        t[-i:-i + k], w[-j:-j + k] = [object() for _ in range(k)], [object() for _ in range(k)]
        marked += k


def test_op7_tiling(spark, docs, empty):
    items = [(i, prose(40, 5000 + i)) for i in range(4)] + [(9, None), (10, "too short")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    w = items[0][1].split(" ")
    extra = [(900, items[1][1]), (901, prose(50, 1) + " " + " ".join(w[20:] + ["qq"] + w[:20]) + " tail"),
             (902, " ".join(w[:10]) + prose(60, 8)), (902, None)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    out = {(r["doc_id"], r["contaminated"], r["item_id"], r["covered"]) for r in tiling.contamination(both, bench).collect() if r["doc_id"]}
    n1 = len(re.findall(SHINGLE_PATTERN, items[1][1]))
    assert {x for x in out if x[1]} == {(900, True, 1, n1), (901, True, 0, len(re.findall(SHINGLE_PATTERN, items[0][1])))}
    assert tiling.contamination(both, bench).count() == both.count()
    assert {r["doc_id"] for r in both.exceptAll(tiling.keep_clean(both, bench)).collect()} == {900, 901}
    assert tiling.contamination(empty, bench).count() == 0 and not tiling.contamination(docs, bench.limit(0)).where("contaminated").count()
    r = random.Random(1)
    for _ in range(30):
        a, b = [r.randint(1, 3) for _ in range(40)], [r.randint(1, 3) for _ in range(25)]
        assert tiling.tile(np.array(a, np.uint64) << np.uint64(60), np.array(b, np.uint64) << np.uint64(60), 5) >= 0.8 * brute_tiling(a, b)


def test_op8_kneser_ney(docs, rows, empty):
    toks = lambda t: re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + [None]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    bi, uni = Counter(), Counter()
    for r in rows:
        if not held(r[0]):
            w = toks(r[1])
            uni.update(w)
            bi.update(zip(["<s>"] + w, w))
    total, vocab = sum(uni.values()), len(uni)
    cont, follow, ctx = Counter(v for _, v in bi), {}, Counter()
    for (u, v), c in bi.items():
        follow.setdefault(u, Counter())[min(c, 3)] += 1
        ctx[u] += c
    t = lambda c: [sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]
    d2, d1 = kneser_ney.discounts(t(bi)), kneser_ney.discounts(t(cont))
    spare = sum(d1[min(c, 3)] for c in cont.values()) / len(bi)
    low = lambda v: (cont[v] - d1[min(cont[v], 3)]) / len(bi) + spare / (vocab + 1)

    def p(u, v):
        if not ctx[u]:
            return low(v)
        return (bi[u, v] - d2[min(bi[u, v], 3)]) / ctx[u] + sum(d2[k] * n for k, n in follow[u].items()) / ctx[u] * low(v)
    assert abs(sum(p("<s>", v) for v in uni) + p("<s>", b"never seen") - 1) < 1e-9
    want = sorted(((r[0], held(r[0]), len(w), sum(uni[x] > 0 for x in w), total,
                    round(sum(math.log10((uni[x] + 1) / ((total + 1) * (vocab + 1))) for x in w), 6),
                    round(sum(math.log10(p(u, v)) for u, v in zip(["<s>"] + w, w)), 6))
                   for r in rows for w in [toks(r[1])]), key=repr)
    out = sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in kneser_ney.train_and_score(docs).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=repr)
    assert [x[:5] for x in out] == [x[:5] for x in want]
    for a, b in zip(out, want):
        assert a[5:] == pytest.approx(b[5:], abs=1e-5)
    assert kneser_ney.train_and_score(empty).count() == 0


def test_op9_pieces(docs, rows, empty):
    lib = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    want = []
    for r in rows:
        ids = lib.encode(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    out = pieces.piece_digests(docs, queries.PIECE_BPE)
    assert got(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert pieces.encode_documents(docs, queries.PIECE_BPE).count() == len(rows)
    assert pieces.piece_digests(empty, queries.PIECE_BPE).count() == 0
    m = pieces.model(queries.PIECE_BPE)
    r = random.Random(4)
    parts = ["a", "b", " ", "  ", "\n", "▁", "é", "漢", "😀", "\x00", "ing", "The ", "aaaa", "=", "www", " "]
    for _ in range(60):
        some = ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(20)]
        data = np.frombuffer("".join(some).encode(), np.uint8)
        n, ids = m.encode(data, np.r_[0, np.cumsum([len(s.encode()) for s in some])])
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == lib.encode(some)
        assert [x.decode() for x in m.decode(n, ids)] == [lib.decode(x) for x in lib.encode(some)]


def test_op10_exact_groups(docs, rows, empty):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    want = [(r[0], keep, len(g), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest())
            for r in rows for g in [groups[r[1] or ""]] for keep in [max((i for i in g if i is not None), default=None)]]
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got(extendible.exact_groups(docs, capacity=4), *cols) == sorted(want, key=repr)
    kept = extendible.keep_documents(docs.where("doc_id is not null"))
    assert kept.columns == docs.columns
    assert kept.count() == len({r[1] or "" for r in rows if r[0] is not None})
    assert extendible.exact_groups(empty).count() == 0
    index, directory, depth = extendible.build_index(docs, capacity=4)
    assert index.groupBy("bucket").count().agg({"count": "max"}).first()[0] <= 4
    assert directory.count() == 1 << depth


def test_pipeline(spark, sf):
    import corpus_pipeline
    docs = read(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
    texts = [r["text"] for r in extendible.keep_documents(docs).select("text").collect()]
    assert len(texts) == len(set(texts)) == len({r["text"] for r in docs.collect()})
    final = corpus_pipeline.run(spark, sf)
    assert final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and final.count() > 0
