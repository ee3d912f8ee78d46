"""Nearest neighbours and whitening against direct computations."""

import math

import numpy as np
import pytest

from layerhouse.llm import nearest as near, registry, whitening

NAN = float("nan")


def usable(rows):
    return [(i, np.array(v, float)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def brute(rows, k=5):
    rows = [(i, v) for i, v in usable(rows) if v.any()]
    out = []
    for q, (name, v) in enumerate(rows):
        if name is None or name % 50:
            continue
        scored = sorted(((-float(near.cosines(v[None], w[None])[0]), i is None, i or 0) for c, (i, w) in enumerate(rows) if c != q))
        out += [(name, rank, None if missing else i, -s) for rank, (s, missing, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()), key=str)


def wide(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, score string, block string").repartition(3)


def test_nearest_registered(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, expected = found(registry.QUERIES["op12_nearest"](spark, folder)), brute(rows)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], rtol=1e-14)


@pytest.mark.parametrize("small", [False, True])
def test_nearest_with_copies_ties_and_bad_vectors(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(near, "BLOCK_ROWS", 7)
        monkeypatch.setattr(near, "QUERIES", 3)
    draw = np.random.default_rng(1)
    rows = [(i, draw.integers(-2, 3, 4).astype(float).tolist()) for i in range(300)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(300, 420)] + [(50, [1.0, 2.0, 0.0, 1.0])] * 2
    rows += [(None, [0.0, 1.0, 0.0, 0.0]), (1000, None), (1050, []), (1100, [0.0] * 4), (1150, [1.0, NAN, 0.0, 0.0]),
             (1200, [1.0, None, 0.0, 0.0]), (1250, [float("inf"), 0.0, 0.0, 0.0]), (1300, [1e30, 1e-30, 0.0, 0.0])]
    df = wide(spark, rows)
    kept = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert found(near.nearest(df, round_bytes=200 if small else near.ROUND_BYTES)) == brute(kept)


def test_nearest_of_few_and_none(spark):
    df = wide(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])])
    assert found(near.nearest(df)) == brute([(0, [1.0, 2.0]), (1, [2.0, 1.0])])
    assert near.nearest(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        near.nearest(wide(spark, [(0, [1.0]), (1, [1.0, 2.0])]))


def test_int8_bounds():
    draw = np.random.default_rng(2)
    one, other = near.units(draw.normal(size=(200, 30)))[0], near.units(draw.standard_cauchy(size=(300, 30)))[0]
    (a, sa, ra), (b, sb, rb) = near.quantised(one), near.quantised(other)
    product = (a.astype(float) * sa[:, None]) @ (b.astype(float) * sb[:, None]).T
    assert (np.abs(product - one @ other.T) <= ra[:, None] + (1 + ra[:, None]) * rb + near.SLACK).all()


@pytest.mark.parametrize("kind", ["spread", "low rank", "repeated", "equal", "zero"])
@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_components(kind, size):
    draw = np.random.default_rng(size)
    turn = np.linalg.qr(draw.normal(size=(size, size)))[0]
    values = {"spread": draw.exponential(size=size) * 1e3, "low rank": np.where(np.arange(size) < size // 2, 5.0 + np.arange(size), 0.0),
              "repeated": np.repeat(draw.exponential(size=size), 2)[:size], "equal": np.full(size, 3.0), "zero": np.zeros(size)}[kind]
    a = turn @ np.diag(values) @ turn.T
    a = (a + a.T) / 2
    found_values, vectors = whitening.components(a)
    scale = max(np.linalg.norm(a), 1e-300)
    assert np.abs(found_values - np.sort(values)[::-1]).max() <= 1e-13 * size * scale
    assert np.linalg.norm(a @ vectors - vectors * found_values) <= 1e-13 * size * scale
    assert np.linalg.norm(vectors.T @ vectors - np.eye(size)) <= 1e-13 * size


def check_whitening(df, rows):
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in usable(rows)]
    fit = np.array(sorted({tuple(v) for _, v in x}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(float) / n
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1]
    got = df.collect()
    most = min(16, fit.shape[1])
    assert len(got) == most * len(x)
    assert {r["n"] for r in got} == {n}
    for r in got:
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) <= 1e-9
        assert r["identity_error"] <= 1e-9
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], set()).add(r["whitened"])
    expected = {i: int(((np.array(v, object) * n - sums) ** 2).sum()) for i, v in x}
    assert {r["vec_id"]: r["deviation"] for r in got} == expected
    names = [i for i, _ in x]
    w = np.array([[next(iter(by[i][c])) for c in range(1, most + 1)] for i in names])
    far = np.array([(np.array(v, object) * n - sums).astype(float) / n for _, v in x])
    reference = np.linalg.eigh(covariance)[1][:, ::-1][:, :most]
    direct = far @ reference / np.sqrt(values[:most])
    signs = np.sign((direct * w).sum(axis=0))
    assert np.abs(direct * signs - w).max() < 1e-6


def test_whitening_registered(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(registry.QUERIES["op13_whitening"](spark, folder), rows)


def test_whitening_edges(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=5) * [9, 5, 3, 2, 1]).tolist()) for i in range(60)] + [(i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(100, 160)]
    bad = [(900, None), (901, []), (902, [1.0, NAN, 0.0, 0.0, 0.0]), (903, [1.0, None, 0.0, 0.0, 0.0]), (904, [float("-inf")] + [0.0] * 4)]
    check_whitening(whitening.whiten(wide(spark, rows + bad)), rows)
    assert whitening.whiten(wide(spark, rows).limit(0)).collect() == []
    lone = whitening.whiten(wide(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(lone) == 6 and all(r["whitened"] is None and r["deviation"] == 0 and r["n"] == 1 and r["explained"] is None for r in lone)
    flat = whitening.whiten(wide(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert [r["whitened"] is None for r in sorted(flat, key=lambda r: r["component"])] == [False, False, True, True]
    far = whitening.whiten(spark.createDataFrame([(1, [1e300, 1.0]), (2, [0.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in far} == {None} and {r["n"] for r in far} == {2}


def test_large_entries_are_summed_exactly(spark):
    draw = np.random.default_rng(4)
    x = [[int(v) for v in row] for row in draw.integers(-10**12, 10**12, (40, 3))]
    n, sums, covariance = whitening.moments(spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(40))
    big = np.array(x, object) * n - np.array(sums, object)
    assert sums == [sum(c) for c in zip(*x, strict=True)]
    assert covariance.tolist() == [[int(v) / n**3 for v in row] for row in big.T @ big]
