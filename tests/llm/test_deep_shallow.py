"""The passes of remove_repeats over the chunks, and what they carry on."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from test_corpus import brute_substrings, got, prose

from orderlake.llm import deep_shallow as ds

BUCKETS = 3


def repeats():
    """Texts that share passages at varying places, within and across chunks."""
    r = random.Random(9)
    passages = [prose(40, 500 + k) for k in range(4)]
    rows = []
    for i in range(24):
        own = [prose(15, 600 + 2 * i), prose(15, 601 + 2 * i)]
        rows.append((i, own[0][r.randrange(9):] + r.choice(passages)[r.randrange(60):] + own[1] + r.choice(passages)))
    return rows + [(24, "z" * 300), (25, ""), (26, "y" + "z" * 120), (26, passages[0]), (27, "short")]


def owners(kind, sizes, answer, questions):
    asked = pa.concat_tables(questions)
    return pa.concat_tables([ds._owner(kind, sizes, answer)((b,), asked.filter(pc.equal(asked["bucket"], b)))
                             for b in pc.unique(asked["bucket"])])


def test_windows_are_found_and_sorted_once(monkeypatch):
    """The last pass neither finds nor sorts windows again; each earlier one finds them once, and only one sorts."""
    calls = []
    for name in ("window_runs", "deep_shallow_sort"):
        monkeypatch.setattr(ds, name, lambda *a, name=name, f=getattr(ds, name): (calls.append(name), f(*a))[1])
    rows = repeats()
    none = pa.Table.from_pylist([], schema=ds._ANSWER)
    cuts = [rows[:9], rows[9:20], rows[20:]]
    docs = [pa.table({"doc_id": [i for i, _ in c], "text": [t.encode() for _, t in c]}) for c in cuts]

    def chunk(k, answers):
        return ds._Chunk(docs[k], answers.filter(pc.equal(answers["chunk"], k)), BUCKETS)

    codes = owners(ds.CODES, (5, 5), ds._codes, [chunk(k, none).questions(k) for k in range(3)])
    assert calls == ["window_runs"] * 3
    early = owners(ds.EARLIER, (8, 4), ds._earlier, [chunk(k, codes).fingerprints(k) for k in range(3)])
    assert calls == ["window_runs"] * 3 + ["window_runs", "deep_shallow_sort"] * 3
    assert any(row["kind"] == ds.EARLIER for row in early.to_pylist())
    calls.clear()
    out = pa.concat_tables([chunk(k, early).result() for k in range(3)])
    assert calls == []
    want = brute_substrings(rows)
    assert sorted((tuple(r.values()) for r in out.to_pylist()), key=repr) == want
    assert sum(n for _, _, n, *_ in want) > 1000


def test_chunks_on_spark(spark):
    rows = repeats() + [(None, prose(40, 500)), (None, None)]
    out = ds.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_substrings(rows)


@pytest.mark.parametrize("clash", [False, True])
def test_marks(monkeypatch, clash):
    """Fingerprints are told by both hashes, in the order of the buckets."""
    data = np.frombuffer((prose(60, 7) + prose(60, 8) + prose(60, 7)).encode(), np.uint8)
    starts = np.arange(len(data) - ds.LENGTH + 1)
    if clash:
        real = ds.span_hash_blocks
        monkeypatch.setattr(ds, "span_hash_blocks", lambda *a: (real(*a)[0] & np.uint64(7 << 61), real(*a)[1]))
    bucket, mark, mark2, of = ds._marks(data, starts, BUCKETS)
    assert (np.diff(bucket) >= 0).all() and set(bucket.tolist()) == set(range(BUCKETS))
    assert len(set(zip(mark.tolist(), mark2.tolist()))) == len(mark)
    strings = [data[s:s + ds.LENGTH].tobytes() for s in starts]
    assert len(set(zip(strings, of.tolist()))) == len(set(strings)) == len(mark)


def test_window_runs_end_within_documents():
    lengths = [0, 49, 50, 51, 0, 200, 3, 0]
    data = np.frombuffer(prose(200, 4).encode(), np.uint8)[:sum(lengths)]
    offsets = np.r_[0, np.cumsum(lengths)]
    lo, hi, _, _, doc = ds.window_runs(data, offsets)
    starts = [(d, s) for a, b, d in zip(lo, hi, doc) for s in range(a, b + 1)]
    assert starts == [(d, offsets[d] + k) for d, n in enumerate(lengths) for k in range(n - 49)]
