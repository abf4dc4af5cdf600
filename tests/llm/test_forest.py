"""Nearest neighbours against all pairs."""

import numpy as np
import pytest

from plantroom.llm import forest, queries


def brute(ids, vectors, k, every):
    out = {}
    for i, v in zip(ids, vectors, strict=True):
        if i % every == 0:
            scores = vectors @ v
            order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-scores[j], ids[j]))[:k]
            out[i] = [(ids[j], scores[j]) for j in order]
    return out


def recall(found, truth, k):
    """Share of the true k nearest that are found, any of equal scores counting."""
    by_query = {}
    for r in found:
        by_query.setdefault(r["query_id"], []).append(r)
    hits = total = 0
    for query, best in truth.items():
        rows = sorted(by_query[query], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(best) + 1))
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        hits += sum(r["score"] >= best[-1][1] - 1e-12 for r in rows)
        total += len(best)
    return hits / total


def table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v], 1) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>, block int")


def test_given_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows])
    found = queries.op2_hash_prefix_forest(spark, "/root/testdata/sf0.1").collect()
    truth = brute(ids, vectors, 20, 20)
    assert {r["query_id"] for r in found} == truth.keys()
    assert recall(found, truth, 20) >= 0.9
    place = {i: n for n, i in enumerate(ids)}
    assert all(abs(r["score"] - float(vectors[place[r["query_id"]]] @ vectors[place[r["vec_id"]]])) < 1e-12 for r in found)


def test_blocks_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_ROWS", 700)
    monkeypatch.setattr(forest, "BLOCK_QUERIES", 60)
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((3000, 24)) * rng.gamma(2.0, 1.0, (3000, 1))).astype(np.float32).astype(float)
    found = forest.nearest(table(spark, range(3000), vectors), k=10, every=20).collect()
    assert recall(found, brute(list(range(3000)), vectors, 10, 20), 10) >= 0.9


def test_equal_vectors_and_few_candidates(spark):
    vectors = np.ones((50, 4))
    found = forest.nearest(table(spark, range(50), vectors), k=20, every=20).collect()
    assert {q: [r["vec_id"] for r in found if r["query_id"] == q] for q in (0, 20, 40)} == {
        0: list(range(1, 21)), 20: list(range(20)), 40: list(range(20)),
    }
    few = forest.nearest(table(spark, [0, 5, 7], np.eye(3)), k=20, every=20).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(few, key=lambda r: r["rank"])] == [(5, 0.0), (7, 0.0)]


def test_repeated_ids_are_rows_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_ROWS", 16)
    monkeypatch.setattr(forest, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(9)
    ids = [0, 0, 20, 20, 20, *range(1, 56)]
    vectors = rng.standard_normal((60, 6))
    vectors[1] = vectors[0]
    found = forest.nearest(table(spark, ids, vectors.astype(np.float32).astype(float)), k=10, reach=forest.TREES).collect()
    exact = vectors.astype(np.float32).astype(float)
    expected = []
    for q, i in enumerate(ids):
        if i % 20 == 0:
            scores = [float(np.sum(exact[j] * exact[q])) for j in range(60)]
            best = sorted((j for j in range(60) if j != q), key=lambda j: (-scores[j], ids[j]))[:10]
            expected += [(i, rank, ids[j], scores[j]) for rank, j in enumerate(best, 1)]
    assert sorted(tuple(r) for r in found) == sorted(expected)
    assert sum(q == 0 for q, *_ in expected) == 20 and any(q == j == 0 for q, _, j, _ in expected)


def test_vectors_of_several_lengths_are_several_tables(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(3 if i % 3 else 5)]) for i in range(200)] + [(999, [1.0] * 7)]
    found = forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5, reach=forest.TREES).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append(r["vec_id"])
    vectors = dict(rows)
    for q, v in rows:
        if q % 20 == 0:
            same = [j for j, w in rows if j != q and len(w) == len(v)]
            assert by_query.pop(q) == sorted(same, key=lambda j: (-float(np.sum(np.multiply(vectors[j], v))), j))[:5]
    assert not by_query


def test_close_scores_of_long_vectors(spark):
    """Products as large as 1e12 whose last digits differ by the order of additions."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal(64) * 1e6
    vectors = np.array([np.concatenate([np.roll(base[:32], i % 7), base[32:]]) for i in range(300)])
    queries = np.ones((1, 64)) * 1e6
    truth = [float(np.sum(v * queries[0])) for v in vectors]
    got = next(forest._best(np.array([-1]), queries, np.arange(300), np.arange(300), vectors, np.linalg.norm(vectors, axis=1).max(), 20, forest.TREES))
    assert list(got[1]) == sorted(range(300), key=lambda j: (-truth[j], j))[:20]


@pytest.mark.parametrize("bad", [None, [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [], [1.0]])
def test_rows_that_take_no_part(spark, bad):
    rows = [(0, [1.0, 0.0]), (20, bad), (3, [0.5, 0.5]), (None, [1.0, 1.0])]
    found = forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [(r["query_id"], r["vec_id"]) for r in found] == [(0, 3)]


def test_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.nearest(empty).collect() == []
    assert forest.nearest(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")).collect() == []


def test_a_query_ascends_until_there_is_enough():
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((500, 16))
    made = forest.Forest(vectors, 9.0)
    strings = forest.hash_strings(vectors[:20], np.zeros(20))
    for enough in (1, 100, 5000, 10**9):
        low, high = made.ranges(strings, enough)
        assert ((high - low).sum(axis=1) >= min(enough, 500 * forest.TREES)).all()
    rows = made.candidates(low[0], high[0])
    assert len(rows) == 500
