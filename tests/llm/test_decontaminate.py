"""Leaks against every window of every text in plain Python."""

import random
from collections import Counter

import numpy as np

from plantroom.llm import decontaminate, queries


def counts(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(documents, benchmark):
    out = []
    for doc_id, text in documents:
        words = (text or "").encode().lower().split()
        for item_id, item in benchmark:
            own = (item or "").encode().lower().split()
            size, n = min(5, len(own)), min(len(own), len(words))
            if not own or len(words) < size:
                continue
            best = None
            for start in range(len(words) - n + 1):
                common, all_ = decontaminate.similarity(counts(words[start : start + n], size), counts(own, size))
                if 100 * common >= 80 * all_ and (best is None or common / all_ > best[1]):
                    best = (start, common / all_)
            if best:
                out.append((doc_id, item_id, best[0], n, round(best[1], 9)))
    return sorted(out, key=repr)


def found(spark, documents, benchmark, **blocks):
    left = spark.createDataFrame([(*r, 1, "x") for r in documents], "doc_id long, text string, item_id int, _leak_id string")
    right = spark.createDataFrame([(*r, "x") for r in benchmark], "item_id long, text string, doc_id string")
    rows = decontaminate.leaks(left.repartition(3), right).collect()
    assert all(r["distance"] <= decontaminate.RADIUS for r in rows)
    kept = decontaminate.without_leaks(left, right)
    assert kept.columns == left.columns
    assert kept.count() == sum(1 for d in documents if d[0] not in {r["doc_id"] for r in rows})
    return sorted(((r["doc_id"], r["item_id"], r["start_word"], r["n_words"], round(r["similarity"], 9)) for r in rows), key=repr)


def corpus():
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    items = [(i, " ".join(fresh(rng.choice([1, 2, 3, 4, 5, 6, 9, 15, 30, 60])))) for i in range(60)]
    items += [(900, None), (901, " "), (902, "of the " * 12), (903, items[20][1]), (None, items[21][1] + " end")]
    documents = []
    for i in range(160):
        words = fresh(rng.randrange(0, 90))
        for _ in range(rng.randrange(0, 3)):
            leak = rng.choice([t for _, t in items if t]).split()
            for _ in range(rng.randrange(0, 3)):
                change = rng.randrange(3)
                at = rng.randrange(len(leak)) if leak else 0
                leak = leak[:at] + ([] if change == 0 else ["changed"] if change == 1 else ["put", leak[at] if leak else ""]) + leak[at + 1 :]
            place = rng.randrange(len(words) + 1)
            words[place:place] = leak
        documents.append((i, " ".join(words)))
    documents += [(500, None), (501, ""), (502, "of the " * 3000), (503, items[25][1].upper()), (504, " ".join(items[-3][1].split()[:11]))]
    return documents, items


def test_all_windows(spark):
    documents, items = corpus()
    expected = brute(documents, items)
    assert len(expected) > 100
    assert found(spark, documents, items) == expected


def test_blocks_of_a_larger_benchmark(spark, monkeypatch):
    documents, items = corpus()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert found(spark, documents[:60], items) == brute(documents[:60], items)


def test_nothing(spark):
    documents, items = corpus()
    assert found(spark, documents[:5], []) == []
    left = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.leaks(left, spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_multi_index_misses_nothing_within_the_radius():
    rng = np.random.default_rng(0)
    sized = decontaminate.Sized(9, [(i, rng.integers(0, 2**63, 9).astype(np.uint64)) for i in range(50)])
    prints = sized.prints[rng.integers(0, 50, 4000)]
    flips = np.packbits(rng.random((4000, 64)) < rng.random((4000, 1)) * 0.6, axis=1)
    prints = prints ^ flips
    expected = {(w, i) for w in range(4000) for i in range(50) if decontaminate._POPCOUNT[prints[w] ^ sized.prints[i]].sum() <= decontaminate.RADIUS}
    assert {(w, i) for w, i, _ in sized.within(prints)} == expected


def test_query(spark):
    rows = {t: [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id"))}
    result = queries.op5_simhash_windows(spark, "/root/testdata/sf0.001").collect()
    exact = {(d, i) for d, t in rows["documents"] for i, item in rows["benchmark"] if " ".join(item.lower().split()) in " ".join((t or "").lower().split())}
    assert {(r["doc_id"], r["item_id"]) for r in result} >= exact
