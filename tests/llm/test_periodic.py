"""Operator 13 against a brute-force search over all lags."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm import periodic, queries


def brute_runs(words, least_words=24, least_periods=3):
    """All maximal stretches of each lag; the smallest lag of a stretch."""
    out = {}
    for q in range(1, len(words) // least_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least_words, least_periods * q):
                out.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, re.findall("[^ \t\n\x0b\x0c\r]+", text or ""))
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def found(words, *least):
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    a, b, q = periodic.find_runs(ids, np.array([0, len(ids)]), *least)
    return [(int(x), int(y - x), int(z)) for x, y, z in zip(a, b, q)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=7),
       st.integers(3, 4), st.sampled_from([1, 6, 24]))
def test_runs_of_random_powers(parts, periods, words):
    seq = [w for block, times in parts for w in block * times]
    assert found(seq, words, periods) == brute_runs(seq, words, periods)


def thue_morse(k):
    return [bin(i).count("1") & 1 for i in range(1 << k)]


@pytest.mark.parametrize("words", [
    [0] * 500, thue_morse(12), thue_morse(11) * 3, [1, 0] * 300 + [2] + [1, 0] * 300,
    [i % 7 for i in range(100)] + [i % 5 for i in range(100)], list(range(40)) * 3, list(range(24)), [0] * 23])
def test_runs_of_special_sequences(words):
    assert found(words) == brute_runs(words)


def test_splitting_recurses():
    # "x" is rare only after "r" has split the text, and so on inwards.
    words = [0, 1] * 20 + [9] + [0, 2, 2, 2] * 1 + [9] + [3] * 30
    ids = np.array(words)
    a, b = periodic.split_segments(ids, np.array([0]), np.array([len(ids)]))
    assert [(int(x), int(y)) for x, y in zip(a, b)] == [(0, 40), (46, 76)]
    assert found(words) == [(0, 40, 2), (46, 30, 1)]


def fixture_rows():
    r = random.Random(13)
    vocabulary = ["w%d" % i for i in range(60)] + ["É", "漢", "a,b"]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.randint(1, 300)))) for i in range(1, 160)]
    rows += [(200 + i, "\t\n".join(["go", "on", "and"][:1 + i % 3] * (30 + i)) + "\x0b end") for i in range(20)]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "a"), (303, "a"), (None, "b " * 40), (None, None),
             (304, " ".join(r.choices(vocabulary[:9], k=4000)) + " x y z" * 200), (305, "nbsp in " * 30)]
    return [(i, t, "clash", [1], 3) for i, t in rows]


def test_query_digests(spark, tmp_path):
    rows = fixture_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, runs array<int>, n_runs int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op13_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((expected(i, t) for i, t, *_ in rows), key=repr)
    assert any(r[1] for r in map(tuple, out.collect()))


def test_operator_outputs(spark):
    docs = spark.createDataFrame([(1, "so " + "la la di " * 20 + "end"), (2, None)], "doc_id long, text string")
    first, second = periodic.collapse_runs(docs).orderBy("doc_id").collect()
    assert first["text"] == "so la la di end" and [tuple(r) for r in first["runs"]] == [(1, 60, 3)]
    assert (second["n_words"], second["runs"], second["text"]) == (0, [], "")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.run_digests(periodic.collapse_runs(periodic.with_planted_loops(empty))).count() == 0
