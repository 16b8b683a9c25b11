"""Operator 11 against a dense eigensolver and exact integer arithmetic."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm import queries, spectrum
from orderlake.llm.common import read


def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    a = (q * np.asarray(values, float)) @ q.T
    return (a + a.T) / 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-50, 50), min_size=1, max_size=12), st.floats(-60, 60), st.integers(0, 9))
def test_counts_are_the_inertia(values, shift, seed):
    if min(abs(v - shift) for v in values) > 1e-6:
        assert spectrum.count_above(symmetric(values, seed), shift) == sum(v > shift for v in values)


def test_count_needs_two_by_two_pivots():
    assert spectrum.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert spectrum.count_above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40), np.geomspace(1e-6, 1e6, 30), [5.0] * 7, [3, 3, 3, 2, 1, 1, 0, 0], [9.0], [0.0, 0.0],
    1 + 1e-7 * np.arange(12), [1e9, 1, 1 + 1e-12, 1e-3]])
def test_leading_pairs(values):
    v = symmetric(values, 5)
    e, x = spectrum.leading_pairs(v, 6)
    top = np.sort(np.asarray(values, float))[::-1]
    top = top[top > 1e-9 * max(top.max(), 1e-300)][:6]
    assert len(e) >= len(top)
    e, x = e[:len(top)], x[:, :len(top)]
    scale = max(map(abs, values), default=0)
    assert np.allclose(e, top, rtol=0, atol=1e-12 * scale * len(values) + 1e-300)
    assert np.allclose(x.T @ x, np.eye(len(top)), atol=1e-5)
    assert np.allclose(v @ x, x * e, atol=1e-9 * scale)


def test_slices_hold_one_value_each():
    values = np.sort(np.random.default_rng(3).uniform(0, 10, 30))[::-1]
    found = spectrum.slices(symmetric(values, 1), 12, 1e-9)
    assert [(s.first, s.last) for s in found] == [(i, i) for i in range(1, 13)]
    assert all(s.low < values[s.first - 1] <= s.high for s in found)


def brute(rows, components=32):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * np.float32(c).astype(float)) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    out = {}
    for r, (i, _) in enumerate(kept):
        deviation = sum((n * c - s) ** 2 for c, s in zip(x[r], sums))
        for k in range(min(components, 6)):
            if e[k] > 1e-9 * e[0]:
                out.setdefault((i, k + 1), []).append((n, deviation, y[r] @ q[:, k] / e[k] ** 0.5, e[k] / np.trace(cov)))
    return out


def fixture_rows():
    g = np.random.default_rng(11)
    rows = [(i, [float(np.float32(c)) for c in g.normal(size=6) * [3, 2, 1, 1, .5, .1] + [9, 0, 0, -4, 0, 0]])
            for i in range(300)]
    rows += [(400, None), (401, [None] * 6), (402, [1.0, float("nan")] + [0.0] * 4), (403, [float("inf")] + [0.0] * 5),
             (404, []), (405, [1.0, 2.0]), (7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]
    return rows


def test_query(spark, tmp_path):
    rows = fixture_rows()
    spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows],
                          "vec_id long, embedding array<float>, whitened double, component int") \
        .repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = queries.op11_spectrum_slicing(spark, str(tmp_path))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = {}
    for r in out.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    want = brute(rows)
    assert got.keys() == want.keys()
    sign = {}
    for key, expected in want.items():
        for r, w in zip(sorted(got[key], key=lambda r: r["deviation"]), sorted(expected, key=lambda w: w[1])):
            assert (r["n"], r["deviation"]) == w[:2]
            s = sign.setdefault(key[1], 1 if r["whitened"] * w[2] > 0 else -1)
            assert math.isclose(r["whitened"], s * w[2], rel_tol=1e-8, abs_tol=1e-8)
            assert math.isclose(r["explained"], w[3], rel_tol=1e-9) and r["identity_error"] < 1e-9


def test_whole_table(spark, sf):
    vectors = spectrum.fixed_point(read(spark, sf, "embeddings"))
    out = spectrum.whiten(vectors).toPandas()
    x = np.array([r["x"] for r in vectors.orderBy("vec_id").collect()], float)
    y = x - x.mean(0)
    e = np.linalg.eigvalsh(y.T @ y / len(y))[::-1]
    assert np.allclose(out.groupby("component").explained.first(), e[:32] / e.sum(), rtol=1e-10)
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-10
    wide = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(wide.T @ wide / len(wide), np.eye(32), atol=1e-9)


def test_degenerate_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [3.0]), (2, [3.0])]):
        assert spectrum.whiten(spectrum.fixed_point(spark.createDataFrame(rows, schema))).count() == 0
    # Huge entries: sums stay exact, a deviation beyond 64 bits is null.
    big = spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 5.0]), (4, [1e30, 0.0])],
                                "vec_id long, embedding array<double>")
    out = spectrum.whiten(spectrum.fixed_point(big)).collect()
    assert {r["vec_id"] for r in out} == {1, 2, 3} and {r["deviation"] for r in out if r["vec_id"] == 1} == {None}
    assert all(r["n"] == 3 for r in out)
