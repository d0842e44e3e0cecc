"""Contour eigenvectors and whitened rows against a dense eigensolver and plain arithmetic."""

import math

import numpy as np
import pytest

import oreflow.llm.feast as feast
from oreflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def spectrum_matrix(values, seed=1):
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (turn * values) @ turn.T


SPECTRA = {
    "spread": np.geomspace(1e4, 1e-2, 40),
    "close": np.concatenate([[100.0, 100.0 + 1e-7, 99.9], np.linspace(50, 51, 20), np.full(9, 1e-3)]),
    "equal": np.concatenate([np.full(12, 7.0), np.full(5, 3.0)]),
    "deficient": np.concatenate([np.arange(1.0, 9.0), np.zeros(24)]),
    "dense": np.linspace(60.0, 70.0, 64) + 0.02 * np.sin(np.arange(64)),
    "one": np.array([4.0]),
    "two": np.array([4.0, 0.5]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia_counts(name):
    values = SPECTRA[name]
    matrix = spectrum_matrix(values)
    shifts = np.array([-1.0, 1e-5, 0.7, 3.5, 50.5, 99.95, 2e4])
    want = [(values > s).sum() for s in shifts]
    assert feast.above(*feast.tridiagonal(matrix), shifts).tolist() == want


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("wanted", [5, 32])
def test_principal_components(spark, name, wanted):
    values = np.sort(SPECTRA[name])[::-1]
    matrix = spectrum_matrix(values)
    got, vectors = feast.principal(spark, matrix, wanted)
    known = values[values > 1e-12 * values[0]][:wanted]
    assert len(got) == len(known) and np.abs(got - known).max() <= 1e-10 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-6
    assert np.abs(matrix @ vectors - vectors * got).max() <= 1e-10 * values[0]


def test_no_eigenvalue_is_missed_between_intervals():
    values = np.random.default_rng(3).exponential(size=64)
    cut = feast.intervals(*feast.tridiagonal(spectrum_matrix(values)), 32)
    assert [i.rank for i in cut] == np.cumsum([0] + [i.count for i in cut])[:-1].tolist()
    assert sum(i.count for i in cut) >= 32 and max(i.count for i in cut) <= feast.IN_INTERVAL
    for i in cut:
        assert ((values > i.low) & (values <= i.high)).sum() == i.count


def test_a_wrong_count_raises():
    matrix = spectrum_matrix(np.arange(1.0, 9.0))
    with pytest.raises(ArithmeticError):
        feast.contour_vectors(matrix, feast.Interval(2.5, 4.5, 3, 0))


def test_query_against_dense_solver(spark):
    rows = QUERIES["op12_feast_whitening"](spark, SF).toPandas()
    given = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x = {
        r.vec_id: [math.floor(64 * float(c)) + 1000000 for c in r.embedding]
        for r in given.itertuples()
        if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)
    }
    n, sums = len(x), [sum(c) for c in zip(*x.values())]
    centred = np.array(list(x.values())) - np.array(sums) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(32, len(values))
    assert len(rows) == n * count and rows.n.unique().tolist() == [n] and rows.identity_error.nunique() == 1
    assert rows.identity_error.iloc[0] <= 1e-10
    for vec_id, deviation in rows.groupby("vec_id").deviation.first().items():
        assert deviation == sum((n * a - s) ** 2 for a, s in zip(x[vec_id], sums))
    place = {v: i for i, v in enumerate(x)}
    for component, part in rows.groupby("component"):
        assert abs(part.explained.iloc[0] - values[component - 1] / np.trace(cov)) < 1e-12
        want = centred @ vectors[:, component - 1] / math.sqrt(values[component - 1])
        got = np.empty(n)
        got[[place[v] for v in part.vec_id]] = part.whitened
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6


ODD = "vec_id long, embedding array<float>, n long, whitened string"


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    good = [(i % 30, [float(c) for c in rng.standard_normal(3)]) for i in range(40)] + [(None, [0.5, 1.0, -2.0])]
    bad = [(50, None), (51, []), (52, [1.0, nan, 0.0]), (53, [1.0, None, 0.0]), (54, [inf, 0.0, 0.0]), (55, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 7, "x") for r in good + bad], ODD)
    got = feast.by_component(feast.whiten(df)).collect()
    assert len(got) == 3 * len(good) and {r.n for r in got} == {len(good)}
    assert sorted(str(r.vec_id) for r in got if r.component == 1) == sorted(str(i) for i, _ in good)
    assert abs(sum(r.explained for r in got) / len(good) - 1) < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], ODD)
    out = feast.by_component(feast.whiten(df))
    assert out.count() == 0
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_constant_dimensions_give_fewer_components(spark):
    rows = [(i, [float(i), 5.0, float(i % 3)], 7, "x") for i in range(20)]
    got = feast.by_component(feast.whiten(spark.createDataFrame(rows, ODD))).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
