"""Operator 12 against brute force; the perfect hash by itself."""

import hashlib
import random
import re

import numpy as np

from orderlake.llm import line_hash, queries
from orderlake.session import checkpoint_root

BLANK = " \t\n\x0b\x0c\r"


def keys(n, seed):
    return np.random.default_rng(seed).integers(0, 1 << 64, (2, n), dtype=np.uint64)


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 63, 64, 65, 1000, 50_000):
        high, low = keys(n, n)
        if n > 10:
            high[: n // 2] = high[0]  # keys that differ in one half only
        h = line_hash.PerfectHash.build(high, low)
        assert sorted(h.find(high, low).tolist()) == list(range(n))
        other = h.find(*keys(500, 7_000 + n))
        assert other.min(initial=-1) >= -1 and other.max(initial=-1) < max(n, 1)
    # about 2 * e^0.5 slots a key at two slots a key and level, and the ranks
    assert 8 * (h.bits.nbytes + h.ranks.nbytes) / n < 4


def test_index_probe(tmp_path):
    high, low = keys(3000, 1)
    docs = np.r_[np.full(1000, 2), np.full(1000, 254), np.arange(255, 1255)]
    last = np.arange(3000) * 7
    shard = high % np.uint64(3)
    for s in range(3):
        at = shard == s
        line_hash._write(f"{tmp_path}/lines-{s:07d}", line_hash.shard_arrays(high[at], low[at], docs[at], last[at]))
    index = line_hash.LineIndex(str(tmp_path), 3)
    got = index.probe(high, low)
    assert (got[0] == docs).all() and (got[1] == last).all()
    assert not index.probe(*keys(3000, 2))[0].any()
    assert not line_hash.LineIndex(str(tmp_path / "none"), 2).probe(high, low)[0].any()


def expected(rows, least_chars=40, least_docs=5):
    ids = lambda i: -1 << 63 if i is None else i
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))
    holders = {}
    for n, (i, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            holders.setdefault(k, []).append(ids(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines for k in [key(x)]
                if len(k) < least_chars or len(holders[k]) < least_docs or max(holders[k]) == ids(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def fixture_rows():
    r = random.Random(12)
    common = ["Common line number %d with quite some words in it" % i for i in range(30)]
    common += ["É" * 39 + " ", "É" * 40, "x" * 40, "y" * 39, "  " + "z" * 38 + "  ", "漢字" * 25, " " + "q" * 39]
    rows = []
    for i in range(200):
        lines = r.choices(common, k=r.randint(0, 8)) + ["line of its own %d %d %s" % (i, j, "w" * 30) for j in range(3)]
        lines = [r.choice([x, x.upper(), "\t" + x + "\r", " " + x + " \x0b"]) if x.isascii() else x for x in lines]
        r.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    only = common[0]
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, only), (503, only + "\n" + only), (None, only), (None, None),
             (504, "\n".join(common * 300)), (505, "Cafİ " * 20), (506, "cafİ " * 20), (-5, only)]
    return rows


def test_lines(spark):
    rows = fixture_rows()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, high int, last string")
    for least_docs, shard_keys in ((5, 1 << 18), (2, 7)):
        out = line_hash.remove_repeated_lines(docs.repartition(3), least_docs=least_docs, shard_keys=shard_keys)
        got = [tuple(r) for r in out.collect()]
        assert sorted(got, key=repr) == sorted(expected(rows, least_docs=least_docs), key=repr)
    empty = line_hash.remove_repeated_lines(docs.where("false"))
    assert empty.count() == 0


def test_shards_follow_the_entries(spark):
    rows = fixture_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    checkpoint_root(spark)
    assert line_hash.build_index(docs, shard_keys=5).shards > 3
    assert line_hash.build_index(docs).shards == 1


def test_query_digests(spark, tmp_path):
    rows = fixture_rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op12_line_hash(spark, str(tmp_path))
    want = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in expected(rows)]
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
