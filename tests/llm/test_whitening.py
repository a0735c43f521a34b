"""Whitening against numpy's dense solver, and the solver by itself."""

import math

import numpy as np
import pytest

from ledgerlane.llm import whitening
from ledgerlane.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n int, x int"


def check(rows, found, components=8):
    """``rows`` are the vectors that remain, as (id, entries)."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], np.int64)
    n, size = x.shape
    sums = x.sum(axis=0)
    deviation = [int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums))) for row in x]
    y = x - sums / n
    values = np.linalg.eigvalsh(y.T @ y / n)[::-1][: min(components, size)]
    trace = float(np.trace(y.T @ y / n))
    assert len(found) == n * len(values)
    by = {}
    for r in found:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert sorted({r.component for r in found}) == list(range(1, len(values) + 1))
    table = np.full((n, len(values)), np.nan)
    seen = {}
    for k, (i, _) in enumerate(rows):
        place = seen[i] = seen.get(i, -1) + 1
        for c in range(len(values)):
            same = sorted(by[i, c + 1], key=lambda r: (r.deviation, r.whitened is not None, r.whitened or 0))
            table[k, c] = np.nan if same[place].whitened is None else same[place].whitened
            assert same[place].n == n
        assert deviation[k] in {r.deviation for r in by[i, 1]}
    real = values > 1e-9 * max(trace, 1e-300)
    for c, e in enumerate(values):
        share = found[c].explained if found[c].component == c + 1 else by[rows[0][0], c + 1][0].explained
        if trace:
            assert abs(share - e / trace) <= 1e-9
    if real.any() and len({i for i, _ in rows}) == n:
        z = table[:, real]
        assert np.abs(z.T @ z / n - np.eye(int(real.sum()))).max() < 1e-9 and max(r.identity_error for r in found) < 1e-9
        # Each component lies along its eigenvector: the vectors' products with it give back the eigenvalue.
        axes = y.T @ z / n / np.sqrt(values[real])
        assert np.abs((y.T @ (y @ axes) / n) - axes * values[real]).max() < 1e-7 * values[0]


@pytest.mark.parametrize("n,size", [(400, 12), (50, 64), (5, 3), (30, 1), (3, 20)])
def test_equals_dense_solver(spark, n, size):
    random = np.random.default_rng(n)
    base = random.normal(size=(n, size)).astype(np.float32) * np.linspace(1, 3, size).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA).repartition(3)
    check(rows, whitening.whiten(df).collect())


def test_dropped_rows_ties_and_long_lengths(spark):
    good = [(k, [float(k % 5), -1.5 * k, 0.25]) for k in range(20)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 1.0]), (103, [float("inf"), 1.0, 1.0]), (104, [1.0]), (105, []), (106, [3e38, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, None, 5) for i, v in good + bad], SCHEMA)
    check(good, whitening.whiten(df).collect())
    again = good + good + [(None, [1.0, 2.0, 3.0])]
    found = whitening.whiten(spark.createDataFrame([(i, v, 0, 0) for i, v in again], SCHEMA)).collect()
    assert len(found) == 41 * 3 and {r.n for r in found} == {41} and sum(r.vec_id is None for r in found) == 3


def test_nothing_and_no_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [], 0, 0), (2, None, 0, 0)], SCHEMA)).count() == 0
    for rows in ([(1, [2.0, 3.0], 0, 0)], [(k, [2.0, 3.0], 0, 0) for k in range(4)]):
        found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
        assert len(found) == 2 * len(rows) and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in found)
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0], 0, 0) for k in range(9)], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat) and all(r.identity_error < 1e-9 for r in flat)


def test_large_numbers_stay_exact(spark):
    rows = [(k, [float(1 << 40) * k, 1.0]) for k in range(3)]
    found = whitening.whiten(spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA.replace("float", "double"))).collect()
    x = [(k << 50) + 100_000 for k in range(3)]
    assert all(r.deviation == (d if (d := (3 * x[r.vec_id] - sum(x)) ** 2) < 1 << 63 else None) for r in found)


@pytest.mark.parametrize("values", [[5.0] * 4 + [1.0] * 30, list(np.linspace(1, 1.001, 90)), [1e12, *np.linspace(1, 2, 40)], [3.0] * 20, [7.0, 1.0] + [0.0] * 30, [2.0 ** -k for k in range(60)]])
def test_solver(values):
    random = np.random.default_rng(len(values))
    turn = np.linalg.qr(random.normal(size=(len(values), len(values))))[0]
    matrix = (turn * np.array(values)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, axes = whitening.largest_pairs(lambda w: matrix @ w, len(values), 8)
    assert np.abs(found - np.sort(values)[::-1][:8]).max() < 1e-13 * max(values)
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-12 and np.linalg.norm(matrix @ axes - axes * found, axis=0).max() < 1e-12 * max(values)


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = QUERIES["op12_embedding_whitening"](spark, SF)
    assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, found.collect())
