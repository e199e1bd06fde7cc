"""Whitening against a plain eigendecomposition."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlab.llm import whitening

SF = "/root/testdata/sf0.001"


def _check(d, q, v):
    want = q @ np.diag(d) @ q.T + np.outer(v, v)
    e, u = whitening.rank_one_update(d, q, v)
    scale = max(1e-300, np.abs(want).max())
    assert (np.diff(e) >= -1e-12 * scale).all()
    assert np.abs(u.T @ u - np.eye(len(d))).max() < 1e-12
    assert np.abs(u @ np.diag(e) @ u.T - want).max() < 1e-12 * scale


@given(st.integers(1, 12), st.integers(0, 2 ** 32 - 1), st.lists(st.sampled_from([0.0, 1.0, 1.0 + 1e-15, 2.0, 1e-9, 1e9]), min_size=12, max_size=12),
       st.lists(st.sampled_from([0.0, 1e-20, 1e-8, 1.0, -3.0, 1e6]), min_size=12, max_size=12))
@settings(max_examples=300, deadline=None)
def test_rank_one_updates_with_ties_and_deflation(m, seed, d, z):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(m, m)))[0]
    _check(np.sort(np.array(d[:m])), q, q @ np.array(z[:m]))


def test_spectra_of_blocks_and_merges():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 20)) @ rng.normal(size=(20, 20)) + rng.normal(size=20) * 50
    parts = []
    for a, b in ((0, 1), (1, 12), (12, 1500), (1500, 3000)):
        s = whitening.Spectrum(20)
        for at in range(a, b, 700):
            s.add(x[at:min(b, at + 700)])
        parts.append(whitening.Spectrum.from_array(s.to_array(), 20))
    whole = parts[0]
    for p in parts[1:]:
        whole.merge(p)
    c = x - x.mean(axis=0)
    assert whole.n == 3000 and np.allclose(whole.mean, x.mean(axis=0), rtol=1e-12)
    assert np.abs(whole.vectors @ np.diag(whole.values) @ whole.vectors.T - c.T @ c).max() < 1e-9 * np.abs(c.T @ c).max()


def _brute(vectors, components=16):
    """vec_id -> [(component, n, deviation, |whitened|, explained)]"""
    rows = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in rows}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    mean = np.array([s / n for s in sums])
    c = fit - mean
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for i, x in rows:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = (np.array(x) - mean) @ u[:, :components] / np.sqrt(e[:components])
        out += [(i, k + 1, n, dev, abs(w[k]), e[k] / e.sum()) for k in range(len(w))]
    return out


def _compare(got, want):
    assert len(got) == len(want)
    for r, w in zip(sorted(got, key=lambda r: (r.vec_id, r.component)), sorted(want)):
        assert (r.vec_id, r.component, r.n, r.deviation) == w[:4]
        assert abs(r.whitened) == pytest.approx(w[4], abs=1e-6) and r.explained == pytest.approx(w[5], rel=1e-9)
        assert r.identity_error < 1e-9


def test_query_against_brute_force(spark):
    import __spark_entry__
    got = __spark_entry__.queries()["op11_whitening"](spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    _compare(got, _brute([(r.vec_id, r.embedding) for r in rows]))
    signs = {}
    for r in got:
        signs.setdefault(r.component, []).append(r.whitened)
    assert len(signs) == 16


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(4)
    good = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0]), (102, [nan, 0.0, 0.0]), (103, [0.0, inf, 0.0]), (104, [1e30, 0.0, 0.0]),
           (105, []), (106, [1.0]), (107, [1.0, 2.0])]
    copies = [(200 + i, good[0][1]) for i in range(30)] + [(7, good[7][1])]
    df = spark.createDataFrame(good + bad + copies, "vec_id bigint, embedding array<double>").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("x", "n", "component", "part", "data", "__c")])
    _compare(whitening.whiten(df, components=16).collect(), _brute(good + copies))
    assert whitening.whiten(df.filter("vec_id between 100 and 105")).collect() == []


def test_no_variance_and_one_flat_direction(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id int, embedding array<float>")
    got = whitening.whiten(df).collect()
    assert len(got) == 6 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, 0.0) for r in got)
    flat = spark.createDataFrame([(1, [0.0, 2.0]), (2, [3.0, 2.0])], "vec_id int, embedding array<float>")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(flat).collect()}
    assert got[1, 1].whitened == -1.0 and got[2, 1].whitened == 1.0 and got[1, 1].explained == 1.0
    assert got[1, 2].whitened is None and got[1, 2].explained == 0.0 and got[1, 1].deviation == 192 ** 2


@pytest.mark.parametrize("step", [2 ** 20, 2 ** 38])
def test_large_entries_stay_exact(spark, step):
    rows = [(i, [float(step * (i - 1)), float(i % 3)]) for i in range(4)]
    got = [r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).collect() if r.component == 1]
    with np.errstate(invalid="ignore"):
        want = {w[0]: w[3] for w in _brute(rows)}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 2 ** 63 else None for i, d in want.items()}
    assert len(set(want.values()) & {r.deviation for r in got}) == (3 if step < 2 ** 30 else 0)
