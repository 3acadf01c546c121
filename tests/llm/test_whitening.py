"""Whitening against plain numpy and exact fractions, and eigenvectors of matrices with known spectra."""

from fractions import Fraction

import numpy as np
import pytest

from riskweave.llm.whitening import eigenvectors, op12_whiten, solve_cluster, whiten


def _orthogonal(n: int, seed: int) -> np.ndarray:
    x = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal in the higher precision too
        x = x @ (3 * np.eye(n) - x.T @ x) / 2
    return x


def _integers(vector) -> list[int]:
    return [int(np.floor(64 * float(c))) + 1_000_000 for c in vector]


def _plain(vectors) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    xs = [_integers(v) for v in vectors]
    n, sums = len(xs), [sum(c) for c in zip(*xs)]
    centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)] for x in xs])
    return n, sums, centred, centred.T @ centred / n


@pytest.mark.parametrize("gaps", [None, 1e-6, 1e-9, 0.0])
def test_eigenvectors_of_known_spectra(gaps):
    n = 24
    values = np.linspace(1, 9, n)[::-1].astype(np.longdouble)
    if gaps is not None:
        values[4:8] = values[4] - np.arange(4) * np.longdouble(gaps)
    frame = _orthogonal(n, 3)
    a = (frame * values) @ frame.T
    found, x = eigenvectors((a + a.T) / 2)
    assert np.allclose(found, values.astype(float), rtol=1e-14)
    assert np.abs(x.T @ x - np.eye(n)).max() < 1e-14
    assert np.abs(a.astype(float) @ x - x * found).max() < 1e-13
    if gaps is None or gaps:
        same = np.abs((x * frame.astype(float)).sum(0))
        assert np.abs(same - 1).max() < (1e-12 if gaps != 1e-9 else 1e-9)


def test_single_precision_alone_would_not_do():
    frame = _orthogonal(16, 5)
    values = np.linspace(1, 2, 16)[::-1].astype(np.longdouble)
    values[3] = values[2] - np.longdouble(1e-8)
    a = (frame * values) @ frame.T
    coarse = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    off = lambda x: np.abs(a.astype(float) @ x - x * (x * (a.astype(float) @ x)).sum(0)).max()
    assert off(coarse.astype(float)) > 1e-9 > off(eigenvectors(a)[1]) * 1e3


def test_a_cluster_is_solved_inside_its_span():
    frame = _orthogonal(6, 1)
    values = np.array([3, 2 + 1e-9, 2, 2 - 1e-9, 1, 0.5], np.longdouble)
    a = (frame * values) @ frame.T
    turn = _orthogonal(3, 9)
    x = solve_cluster(a, frame[:, 1:4] @ turn, np.longdouble(2))
    inner = (x.T @ a @ x).astype(float)
    assert np.abs(inner - np.diag(np.diag(inner))).max() < 1e-15


def test_zero_and_diagonal_matrices():
    assert not eigenvectors(np.zeros((3, 3), np.longdouble))[0].any()
    values, x = eigenvectors(np.diag([1, 5, 5, 2]).astype(np.longdouble))
    assert values.tolist() == [5, 5, 2, 1] and np.abs(x.T @ x - np.eye(4)).max() < 1e-15


def _compare(rows, vectors: dict[int, list[float]], components: int):
    n, sums, centred, covariance = _plain(vectors.values())
    values, frame = np.linalg.eigh(covariance)
    values, frame = values[::-1], frame[:, ::-1]
    assert len(rows) == n * components
    got = {(r["vec_id"], r["component"]): r for r in rows}
    for k in range(components):
        white = centred @ frame[:, k] / np.sqrt(values[k])
        mine = np.array([got[i, k + 1]["whitened"] for i in vectors])
        assert min(np.abs(mine - white).max(), np.abs(mine + white).max()) < 1e-7
        assert got[next(iter(vectors)), k + 1]["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-10)
    for i, v in vectors.items():
        exact = sum((n * x - s) ** 2 for x, s in zip(_integers(v), sums))
        assert {got[i, k + 1]["deviation"] for k in range(components)} == {exact}
    assert {r["n"] for r in rows} == {n} and all(r["identity_error"] < 1e-9 for r in rows)


def test_query_against_numpy(spark):
    rows = op12_whiten(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    _compare(rows, {r["vec_id"]: r["embedding"] for r in table}, 32)


def test_odd_vectors_take_no_part(spark):
    rng = np.random.default_rng(2)
    good = {i: rng.normal(size=4).tolist() for i in range(50)}
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan"), 0.0, 0.0, 0.0]), (103, [float("inf")] * 4)]
    df = spark.createDataFrame([*good.items(), *bad], "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "2 AS id", "3 AS vec")
    _compare(whiten(df).collect(), good, 4)


def test_short_vectors_count_as_zeros_behind(spark):
    rng = np.random.default_rng(4)
    good = {i: rng.normal(size=3 if i % 7 else 2).tolist() for i in range(60)}
    rows = whiten(spark.createDataFrame([*good.items()], "vec_id long, embedding array<double>").repartition(5)).collect()
    _compare(rows, {i: v + [0.0] * (3 - len(v)) for i, v in good.items()}, 3)


def test_large_numbers_stay_exact(spark):
    good = {1: [1e9, 5.0], 2: [-1e9, 2.0], 3: [3e8, -1.0], 4: [7e7, 0.5]}
    rows = whiten(spark.createDataFrame([*good.items()], "vec_id long, embedding array<double>")).collect()
    n, sums, _, _ = _plain(good.values())
    for r in rows:
        exact = sum((n * x - s) ** 2 for x, s in zip(_integers(good[r["vec_id"]]), sums))
        assert r["deviation"] == (exact if exact < 2**63 else None)
    assert {r["component"] for r in rows} == {1} and len(rows) == 4  # the other has 1e-17 of the variance


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)] + [(3, [3.0, 6.0, 7.0]), (None, [1.0, 2.0, 7.0])]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 22


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0]), (2, [2.0])]])
def test_nothing_to_scale_gives_no_rows(spark, rows):
    df = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert df.collect() == [] and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
