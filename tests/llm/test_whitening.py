import math
import random
from fractions import Fraction

import numpy as np
import pytest
from fixtures import SMALL
from paperloom.llm import exact, whitening
from paperloom.llm.queries import QUERIES

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(rows, count=16):
    """{vec_id: (deviation, whitened without sign)} and shares, by exact sums and numpy's eigh."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept]
    fit = sorted({tuple(v) for v in x})
    n, size = len(fit), len(fit[0])
    total = [sum(v[k] for v in fit) for k in range(size)]
    centred = np.array([[float(Fraction(v[k]) - Fraction(total[k], n)) for k in range(size)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    good = [k for k in range(min(count, size)) if values[k] > 1e-9 * values[0]]
    found = {}
    for (i, _), v in zip(kept, x):
        deviation = sum((n * v[k] - total[k]) ** 2 for k in range(size))
        z = np.array([float(Fraction(v[k]) - Fraction(total[k], n)) for k in range(size)])
        found.setdefault(i, []).append((deviation, [abs(z @ vectors[:, k]) / math.sqrt(values[k]) for k in good]))
    return n, found, [values[k] / values.sum() for k in good]


def compare(frame, rows):
    assert frame.columns == COLUMNS
    n, expected, shares = brute(rows)
    got = {}
    for r in frame.collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-9)
        got.setdefault(r["vec_id"], []).append((r["deviation"], r["component"], abs(r["whitened"])))
    assert set(got) == set(expected)
    for i, each in expected.items():
        flat = sorted((d, k + 1, z) for d, zs in each for k, z in enumerate(zs))
        assert [g[:2] for g in sorted(got[i])] == [f[:2] for f in flat]
        assert [g[2] for g in sorted(got[i])] == pytest.approx([f[2] for f in flat], abs=1e-7)


def test_query_equals_plain_algebra(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    compare(QUERIES["op12_embedding_whitening"](spark, SMALL), rows)


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)]) for i in range(40)]
    rows += [(100, None), (101, [None] * 5), (102, [1.0, float("nan"), 0.0, 0.0, 0.0]), (103, [float("inf")] + [0.0] * 4)]
    rows += [(104, []), (105, [1.0, 2.0]), (None, [0.5] * 5), (7, rows[7][1]), (7, [0.25] * 5)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # copies count once in the fit
    frame = frame_of(spark, rows)
    for name in ("x", "size", "component", "vector", "whitened"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    plain = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if i not in (100, 101, 102, 103, 104, 105)]
    compare(whitening.whitened(frame), plain)


def test_equal_variances_have_an_orthonormal_basis(spark):
    """A root of multiplicity three: any basis of its space will do, but it must be one."""
    rows = [(2 * k + s, [(1.0 if s else -1.0) * (j == k) for j in range(3)]) for k in range(3) for s in (0, 1)]
    found = whitening.whitened(frame_of(spark, rows)).collect()
    assert len(found) == 18 and all(r["identity_error"] < 1e-12 for r in found)
    assert all(r["explained"] == pytest.approx(1 / 3) for r in found)
    z = {(r["vec_id"], r["component"]): r["whitened"] for r in found}
    for i in range(6):
        assert sum(z[i, c] ** 2 for c in (1, 2, 3)) == pytest.approx(3.0)


def test_directions_without_variance_have_no_component(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    found = whitening.whitened(frame_of(spark, rows)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 9
    assert whitening.whitened(frame_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_no_rows_and_no_vectors(spark):
    assert whitening.whitened(frame_of(spark, [])).columns == COLUMNS
    assert whitening.whitened(frame_of(spark, [(1, None), (2, []), (3, [float("nan")])])).count() == 0


def test_entries_beyond_doubles_and_longs(spark):
    rows = [(0, [3e38, 0.0]), (1, [-3e38, 1.0]), (2, [2.0**40, 2.0]), (3, [0.0, 3.5])]
    found = whitening.whitened(frame_of(spark, rows)).collect()
    assert {(r["vec_id"], r["component"]) for r in found} == {(i, c) for i in range(4) for c in (1, 2)}
    assert all(r["identity_error"] < 1e-4 and r["deviation"] is None for r in found)


def test_gram_is_exact_at_every_size():
    rng = np.random.default_rng(0)
    for bound in (100, 1 << 24, 1 << 30, 1 << 40):
        y = rng.integers(-bound, bound, (300, 4))
        wide = y.astype(object)
        assert (whitening.exact_gram(y) == wide.T @ wide).all()


def test_polynomial_by_primes_equals_plain_expansion():
    """Against Faddeev and Le Verrier's recurrence in integers."""
    rng = random.Random(9)
    for size in (1, 2, 3, 6, 9):
        rows = [[rng.randint(-9, 9) for _ in range(size)] for _ in range(size + 1)]
        m = [[sum(r[i] * r[j] for r in rows) for j in range(size)] for i in range(size)]
        primes = exact.primes_below(exact.PRIME_LIMIT, exact.primes_needed(size, sum(m[i][i] for i in range(size))))
        got = exact.remaindered([exact.polynomial_mod(m, p) for p in primes], primes)
        a, work = np.array(m, dtype=object), np.zeros((size, size), dtype=object)
        coefficients, eye = [1], np.eye(size, dtype=int).astype(object)
        for k in range(1, size + 1):
            work = a @ work + coefficients[-1] * eye
            coefficients.append(-sum((a @ work)[i][i] for i in range(size)) // k)
        assert got == coefficients[::-1]


def test_roots_with_multiplicity_and_zeros():
    # (x - 2)^2 (x - 5) x
    polynomial = [0, -20, 24, -9, 1]
    assert [r / 2**64 for r in exact.largest_roots(polynomial, 16, 64)] == [5.0, 2.0, 2.0]
    near = [10**30 * (10**30 + 1), -(2 * 10**30 + 1), 1]  # two roots one apart
    assert exact.largest_roots(near, 2, 8) == [(10**30 + 1) << 8, 10**30 << 8]


def test_primes():
    assert exact.primes_below(100, 3) == [97, 89, 83]
    assert exact.primes_below(1 << 31, 1) == [2147483647]
