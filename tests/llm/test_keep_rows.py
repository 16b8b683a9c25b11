"""Rows with reused, null and repeated ids and clashing columns in the stages that keep documents."""

import random

import numpy as np
import pytest

from orderlake.llm import bagminhash, extendible, importance, tiling

from test_corpus import brute_tiling, multiset, prose

CLASHING = ("doc_id long, text string, row__ int, dropped__ int, log_weight__ int, name int, sha int, gone int, gone_id int, "
            "`count` int, hash long, bucket int, class int, own_id int")


def table(spark, rows):
    return spark.createDataFrame([(i, t, *range(12)) for i, t in rows], CLASHING)


def left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_exact_dedup_of_reused_ids(spark):
    rows = [(7, "A"), (7, "B"), (9, "A"), (None, "C"), (None, "C"), (9, "A"), (1, None), (2, ""), (4, "B"), (None, "A")]
    docs = table(spark, rows)
    out = extendible.keep_documents(docs, capacity=1)
    assert out.columns == docs.columns
    assert left(out) == sorted([(7, "B"), (9, "A"), (None, "C"), (2, "")], key=repr)
    assert extendible.keep_documents(docs.limit(0)).count() == 0


def test_index_decides(spark):
    docs = table(spark, [(i, f"text {i % 5}") for i in range(40)])
    index, directory, depth = extendible.build_index(docs, capacity=1)
    assert index.count() == 5 and {r["group_size"] for r in index.collect()} == {8}
    keys = index.select("hash", "text_sha256")
    assert extendible.look_up(keys, index, directory, depth).count() == 5
    assert extendible.look_up(keys, index, directory.where("false"), depth).count() == 0


def test_exact_dedup_is_native(spark, capsys):
    extendible.exact_groups(table(spark, [(1, "a"), (2, "a")])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_near_dedup_of_reused_ids(spark):
    a, b = prose(60, 1), prose(60, 2)
    docs = table(spark, [(1, a), (7, a), (7, b), (None, a), (5, None), (6, ""), (1, a)])
    out = bagminhash.keep_one(docs)
    assert out.columns == docs.columns
    assert left(out) == sorted([(1, a), (7, b), (None, a), (5, None), (6, "")], key=repr)
    found = sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in bagminhash.near_duplicates(docs).collect())
    assert found == [(1, 1, 3), (1, 1, 3), (5, 5, 2), (6, 5, 2), (7, 1, 3), (7, 7, 1)]


@pytest.mark.parametrize("block", [2000, 7])
def test_near_dedup_of_one_large_open_group(spark, monkeypatch, block):
    """Near copies of one text, some links of which fall just short."""
    monkeypatch.setattr(bagminhash, "BLOCK", block)
    r = random.Random(8)
    base = prose(120, 9).split()
    rows = []
    for i in range(70):
        words = list(base)
        for k in r.sample(range(len(words)), 1 + i % 6):
            words[k] = f"w{r.randrange(10 ** 9)}"
        rows.append((i, " ".join(words)))
    sets = [multiset(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sum((sets[i] & sets[j]).values()) >= .8 * sum((sets[i] | sets[j]).values()):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    want = [(i, find(i)) for i in range(len(rows))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((x["doc_id"], x["class_id"]) for x in bagminhash.near_duplicates(docs).collect()) == want


def test_rounds_after_failed_pairs(spark):
    """Two classes of three: a round tells a pair that has not failed before, until none is left."""
    sign = np.arange(bagminhash.SLOTS, dtype=np.uint32).tobytes()
    full = b"\xff" * bagminhash.CELLS
    members = spark.createDataFrame([(0, 0, 6, i, i % 2, 100, sign, full) for i in range(6)],
                                    "band int, hash long, n long, doc_id long, class_id long, size long, signature binary, cells binary")
    failed, seen = None, set()
    for most, n in ((1, 1), (2, 2), (100, 6), (100, 0)):
        told = bagminhash._apart(members, 0.8, failed, most)
        pairs = {(r["a"], r["b"]) for r in told.collect()}
        assert len(pairs) == n and not pairs & seen and all((b - a) % 2 for a, b in pairs)
        seen |= pairs
        failed = spark.createDataFrame([(0, 0, 0, 0, a, b) for a, b in seen], told.schema)
    assert len(seen) == 9


def test_decontamination_of_short_items(spark):
    bench = spark.createDataFrame([(1, "four words of it"), (2, "Alone"), (3, ""), (4, None), (5, prose(30, 4))],
                                  "item_id long, text string")
    docs = table(spark, [(1, "four words of it"), (2, "Here are: FOUR words, of it."), (3, "words of it four"), (3, "all alone here"),
                         (4, None), (5, ""), (None, "x " + prose(30, 4)), (6, "four words it of"), (6, "four words it of")])
    out = tiling.keep_clean(docs, bench)
    assert out.columns == docs.columns
    assert left(out) == sorted([(3, "words of it four"), (4, None), (5, ""), (6, "four words it of"), (6, "four words it of")], key=repr)
    found = {(r["doc_id"], r["item_id"], r["covered"]) for r in tiling.contamination(docs, bench).where("contaminated").collect()}
    assert {x[:2] for x in found} == {(1, 1), (2, 1), (3, 2), (None, 5)} and (1, 1, 4) in found and (3, 2, 1) in found


@pytest.mark.parametrize("least", [1, 3, 5])
def test_tiling_of_distinct_words(least):
    """Without repeated words greedy tiling has one result."""
    r = random.Random(least)
    for _ in range(40):
        a, b = r.sample(range(1, 60), 30), r.sample(range(1, 60), 20)
        at = r.randrange(20)
        b[5:5 + at] = a[3:3 + at]
        b = list(dict.fromkeys(b))
        wide = lambda x: np.array(x, np.uint64) << np.uint64(50)
        assert tiling.tile(wide(a), wide(b), least) == brute_tiling(a, b, least)


def test_quality_of_clashing_columns(spark):
    docs = table(spark, [(i, prose(20, i)) for i in range(20)] + [(3, prose(20, 99)), (None, None), (5, "")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    out = importance.keep_selected(docs, labels)
    assert out.columns == docs.columns
    # No n-gram tells the labels apart: all weigh the same and all stay.
    assert left(out) == left(docs)
