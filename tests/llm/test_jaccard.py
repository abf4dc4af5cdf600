"""The n-gram Jaccard join against all pairs in plain Python."""

import random

import numpy as np
import pytest

from plantroom.llm import jaccard, queries
from plantroom.llm.components import components


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def check(spark, rows, size, percent):
    documents = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, component string").repartition(3)
    found = [tuple(r) for r in jaccard.classes(documents, size, percent).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows, size, percent), key=repr)


def changed(words, rng, share):
    return [rng.choice("pqrstuv") + str(rng.randrange(99)) if rng.random() < share else w for w in words]


def family(rng, start, size, share, length):
    words = [f"w{rng.randrange(400)}" for _ in range(length)]
    return [(start + i, " ".join(changed(words, rng, share) if i else words)) for i in range(size)]


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_families(spark, size, percent):
    rng = random.Random(size)
    rows = [r for f in range(25) for r in family(rng, 100 * f, rng.randrange(1, 9), rng.choice([0.005, 0.02, 0.04]), rng.randrange(3, 300))]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(5000 + i, " ".join(f"u{rng.randrange(5000)}" for _ in range(150)) + " " + passage) for i in range(40)]
    rows += [(6000 + i, rows[0][1].upper() + "\n") for i in range(30)]
    # a chain: each step is near enough, the ends are not
    chain = [f"c{i}" for i in range(200)]
    rows += [(7000 + i, " ".join(chain[5 * i : 5 * i + 150])) for i in range(10)]
    rng.shuffle(rows)
    check(spark, rows, size, percent)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (6, "one two"), (None, "one two"), (None, "alone here"), (None, "all null"), (None, "all null")]
    rows += [(9, "x " * 30000), (8, "x " * 20000), (10, "É a b c d"), (11, "é a b c d"), (12, "a\u00a0b c d e")]
    check(spark, rows, 4, 85)
    documents = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, label string")
    kept = jaccard.one_of_each(documents, 4, 85)
    assert kept.columns == documents.columns
    ids = sorted((str(r["doc_id"]) for r in kept.collect()), key=str)
    assert ids == sorted(["1", "2", "3", "4", "6", "None", "None", "8", "10", "11", "12"])
    assert jaccard.classes(documents.where("false")).collect() == [] and jaccard.one_of_each(documents.where("false")).collect() == []


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = [tuple(r) for r in queries.op3_signature_trees(spark, "/root/testdata/sf0.01").collect()]
    assert sorted(found) == sorted(brute(rows, 4, 85))


def test_bounds_hold_for_every_linked_pair():
    rng = random.Random(3)
    for _ in range(3000):
        n, percent = rng.randrange(1, 60), rng.choice([80, 85, 100])
        universe = rng.sample(range(1, 10**6), n + 12)
        a = np.array(sorted(universe[:n]), dtype=np.uint64)
        drop = rng.randrange(0, max(1, n // 4 + 1))
        b = np.array(sorted(universe[drop : n + rng.randrange(0, 9)]), dtype=np.uint64)
        exact = len(b) and 100 * len(set(a) & set(b)) >= percent * len(set(a) | set(b))
        if len(b):
            assert jaccard.linked(a, b, percent) == exact
        if exact:
            first = [set(x[: jaccard.long_prefix(len(x), percent)]) for x in (a, b)]
            assert all(len(first[0] & first[1]) >= jaccard.least_shared(len(x), percent) for x in (a, b))
            assert set(a[: jaccard.prefix_length(len(a), percent)]) & set(b[: jaccard.prefix_length(len(b), percent)])
            for longs in (4, jaccard.LONG):
                differ = sum(bin(int(x) & (2**64 - 1)).count("1") for x in jaccard.parity(a, longs) ^ jaccard.parity(b, longs))
                assert (100 - percent) * (len(a) + len(b)) >= (100 + percent) * differ
            assert jaccard._possible(jaccard.build([a]), jaccard.build([b]), percent)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (600, 600)], "a long, b long")
    found = dict((r["v"], r["component"]) for r in components(links).collect())
    assert found == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_long_documents_that_share_a_passage(spark, monkeypatch):
    rng = random.Random(8)
    passages = [[f"p{k}_{i}" for i in range(70)] for k in range(3)]
    rows = []
    for i in range(120):
        own = [f"u{rng.randrange(50_000)}" for _ in range(rng.randrange(150, 900))]
        at = rng.randrange(len(own))
        rows.append((i, " ".join(own[:at] + passages[i % 3] + own[at:])))
    # near copies of some, which only the completion finds where blocks are cut small
    rows += [(1000 + i, " ".join(changed(rows[i][1].split(), rng, 0.01))) for i in range(0, 120, 4)]
    pairs = {}
    stored = jaccard.stored
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    monkeypatch.setattr(jaccard, "stored", lambda df, name, *a: pairs.setdefault(name, stored(df, name, *a)))
    check(spark, rows, 5, 80)
    # the passages make no candidates: a shared passage is not among a document's rarest shingles
    assert pairs["pairs"].count() < 2 * len(rows)


def test_rarest_first_keeps_every_link():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, jaccard.CELLS)
    for percent in (80, 85):
        for _ in range(300):
            n = int(rng.integers(1, 200))
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) > rng.random() * 0.2], rng.integers(0, 2**64, int(rng.integers(0, 20)), dtype=np.uint64)]))
            if len(b) and jaccard.linked(a, b, percent):
                first = [jaccard.rarest(x, counts, percent) for x in (a, b)]
                common = np.intersect1d(*first)
                assert len(common)
                # at the first common shingle the places leave room for the least overlap
                i, j = (min(int(np.flatnonzero(f == c)[0]) for c in common) for f in first)
                assert (100 + percent) * min(len(a) - i, len(b) - j) >= percent * (len(a) + len(b))
