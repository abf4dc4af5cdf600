"""Whitened embeddings against eigenvectors of the covariance."""

import math

import numpy as np
import pytest

from plantroom.llm import queries, whitening


def numbers(vectors):
    return [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]


def checked(found, ids, vectors, components=8):
    """Compares everything with plain integers and numpy's eigenvectors."""
    x = numbers(vectors)
    n, dims = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x, strict=True)]
    scaled = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    centred = np.array([[c / n for c in row] for row in scaled])
    _, singular, axes = np.linalg.svd(centred, full_matrices=False)
    values, axes = singular**2 / n, axes.T
    shown = min(components, dims)
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(found) == n * shown and by_id.keys() == set(ids)
    assert {r["n"] for r in found} == {n}
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] <= 1e-9
    for place, i in enumerate(ids):
        assert {r["deviation"] for r in by_id[i].values()} == {exact if (exact := sum(c * c for c in scaled[place])) < 2**63 else None}
    for k in range(1, shown + 1):
        got = np.array([by_id[i][k]["whitened"] for i in ids])
        true = centred @ axes[:, k - 1] / math.sqrt(values[k - 1])
        gap = min(abs(values[j] - values[k - 1]) for j in range(dims) if j != k - 1)
        if gap > 1e-6 * values[k - 1]:
            assert min(np.abs(got - true).max(), np.abs(got + true).max()) < 1e-8
        share = {by_id[i][k]["explained"] for i in ids}
        assert len(share) == 1 and abs(share.pop() - values[k - 1] / values.sum()) < 1e-10


def table(spark, ids, vectors, parts=3):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, whitened string").repartition(parts)


def test_given_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    found = queries.op11_lanczos_whitening(spark, "/root/testdata/sf0.01").collect()
    checked(found, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


@pytest.mark.parametrize("decay", [1.0, 0.6])
def test_falling_deviations(spark, decay):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 40)) * decay ** np.arange(40) * 50 @ np.linalg.qr(rng.standard_normal((40, 40)))[0]
    checked(whitening.whitened(table(spark, range(300), vectors)).collect(), list(range(300)), vectors)


def test_steep_deviations_stop_early(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((400, 100)) * np.concatenate([2.0 ** np.arange(14, 4, -1), np.full(90, 0.01)])
    df = table(spark, range(400), vectors).select("embedding")
    count, *sums = (int(x) for x in whitening._summed(df, 101, whitening._sums, 100, exact=True))
    products = whitening.Products(df, 100, whitening.Centre(count, tuple(sums)))
    values, _ = whitening.bidiagonalised(products, 8)
    centred = np.array(numbers(vectors), dtype=float)
    centred -= centred.mean(axis=0)
    assert np.allclose(values, np.linalg.svd(centred, compute_uv=False)[:8], rtol=1e-12)
    assert products.passes < 2 * (100 // 8)


def test_equal_deviations(spark):
    vectors = [sign * 3.0 * row for row in np.eye(12) for sign in (1, -1)]
    found = whitening.whitened(table(spark, range(24), vectors)).collect()
    checked(found, list(range(24)), vectors)
    assert all(abs(r["explained"] - 1 / 12) < 1e-12 for r in found)


def test_sizes_that_differ_by_much(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((200, 9)) * np.array([1e6, 1e5, 1e3, 1e2, 10, 1, 1, 1, 0.0])
    checked(whitening.whitened(table(spark, range(200), vectors)).collect(), list(range(200)), vectors)


def test_left_out_rows_and_lengths(spark):
    rng = np.random.default_rng(7)
    good = rng.standard_normal((30, 5))
    bad = [None, [1.0, None, 1, 1, 1], [1.0, float("nan"), 1, 1, 1], [1.0, float("inf"), 1, 1, 1], []]
    df = table(spark, [*range(30), 100, 101, 102, 103, 104], [*good, *bad])
    checked(whitening.whitened(df).collect(), list(range(30)), good)
    pairs = rng.standard_normal((6, 2))
    both = whitening.whitened(df.unionByName(table(spark, range(200, 206), pairs))).collect()
    checked([r for r in both if r["vec_id"] < 100], list(range(30)), good)
    checked([r for r in both if r["vec_id"] >= 200], list(range(200, 206)), pairs)


def test_rows_that_do_not_spread(spark):
    assert whitening.whitened(table(spark, [], [])).collect() == []
    for vectors in ([[0.5, 1.0, 2.0]], [[0.0, 0.0, 0.0]] * 4):
        found = whitening.whitened(table(spark, [7] * len(vectors), vectors)).collect()
        assert len(found) == 3 * len(vectors)
        assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in found} == {(None, 0.0, None, 0)}
    line = [[i * 1.0, 2.0 * i, 5.0] for i in range(6)]
    found = whitening.whitened(table(spark, range(6), line)).collect()
    assert all(r["explained"] == pytest.approx(1.0) for r in found if r["component"] == 1)
    assert all(r["whitened"] is None and r["explained"] == 0.0 for r in found if r["component"] > 1)
    assert found[0]["identity_error"] < 1e-9


def test_null_and_repeated_ids(spark):
    vectors = [[1.0, 2.0], [3.0, 4.5], [3.0, 4.5], [0.0, 9.0]]
    found = whitening.whitened(table(spark, [None, 1, 1, None], vectors)).collect()
    assert sorted((r["vec_id"] is None, r["component"]) for r in found) == [(False, 1), (False, 1), (False, 2), (False, 2), (True, 1), (True, 1), (True, 2), (True, 2)]


def test_huge_entries(spark):
    vectors = [[1e300, 1.0], [-1e300, 2.0], [3.0, 1e9]]
    found = whitening.whitened(table(spark, range(3), vectors)).collect()
    assert len(found) == 6 and {r["deviation"] for r in found} == {None}
    assert all(math.isfinite(r["whitened"]) for r in found if r["component"] == 1)
