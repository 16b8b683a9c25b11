"""The base score of op8: (c + 1) / (N + 1 * (V + 1)) for every token."""

import math
import re
import zlib
from collections import Counter

import pytest

from orderlake.llm import queries

ODD = [None, "", " \t\n\v\f\r ", "a", "A a\u00c4 \u0130 i\u0307", "x\x00y \x1c \x85 \u00a0 \u2028z", "the The THE cat",
       "one two\nthree  four", "the cat sat", "unseen words here", "\u3000 \U0001f600 e\u0301", "k" * 5000 + " end", "0 -1 00"]


def words(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0d]+", lower) + [None]


def expected(rows):
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return sorted((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n,
                   sum(math.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in ws))
                  for i, t in rows for ws in [words(t)])


@pytest.mark.parametrize("rows", [
    [(i, ODD[i % len(ODD)]) for i in range(-9, 60)] + [(3, "a b c"), (3, "a b c")],
    [(i, "all held out Text") for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2],
], ids=["odd", "none_to_train_on"])
def test_base_score_follows_its_contract(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["op8_kneser_ney"](spark, str(tmp_path)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()
    for got, want in zip(sorted(map(tuple, out)), expected(rows), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], rel=1e-9, abs=1e-9)
