"""Language-model scores against counts and sums over all state paths in plain Python."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np

from plantroom.llm import hmm


def brute_base(rows):
    split = lambda t: (t or "").encode().lower().split()
    learned = Counter()
    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            learned.update([*split(t), None])
    n, v = sum(learned.values()), len(learned)
    out = []
    for i, t in rows:
        words = [*split(t), None]
        score = sum(math.log10((learned[w] + 1) / (n + v + 1)) for w in words)
        out.append((i, len(words), sum(learned[w] > 0 for w in words), n, round(score, 6)))
    return out


def check(spark, rows, documents):
    found = hmm.scored(documents).collect()
    key = lambda x: (str(x[0]), x[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found), key=key) == sorted(brute_base(rows), key=key)
    return found


def test_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = check(spark, rows, documents)
    held = [r for r in found if r["held_out"]]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in found} == {True}
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held), "the latent states explain unseen texts better than counts alone"


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "a b\tA\x0bb"), (2, "a a a"), (2, "a a a"), (15, "é É a b " * 2000), (3, " \n")]
    documents = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, part string")
    check(spark, rows, documents)
    assert hmm.scored(documents.where("false")).collect() == []


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(i, "a b") for i in ids]
    found = check(spark, rows, spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["base_score"] for r in found} == {0.0}


def _model(states=2, symbols=3):
    noise = np.random.default_rng(1)
    draw = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(noise.random(shape) + 0.1)
    return draw(states), draw(states, states), draw(states, symbols)


def _paths(symbols, model):
    start, move, emit = model
    for path in itertools.product(range(len(start)), repeat=len(symbols)):
        p = start[path[0]] * emit[path[0], symbols[0]]
        for a, b, s in zip(path, path[1:], symbols[1:], strict=False):
            p *= move[a, b] * emit[b, s]
        yield path, p


def test_forward_and_counts_are_sums_over_paths():
    model = _model()
    sequences = [np.array(s) for s in ([0, 1, 2, 1, 0], [2], [1, 1], [0, 2, 2, 1])]
    likelihoods = [sum(p for _, p in _paths(s, model)) for s in sequences]
    assert np.allclose(hmm.forward(sequences, model), np.log10(likelihoods))
    starts, moves, emitted = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 3))
    for s, total in zip(sequences, likelihoods, strict=True):
        for path, p in _paths(s, model):
            starts[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] += p / total
            for a, x in zip(path, s, strict=True):
                emitted[a, x] += p / total
    for found, expected in zip(hmm.expected_counts(sequences, model), (starts, moves, emitted), strict=True):
        assert np.allclose(found, expected)


def test_states_form_for_what_begins_behind_a_licence(spark):
    noise = np.random.default_rng(3)
    licence = " ".join(f"licence{k}" for k in range(70))
    rows = [(i, f"{licence} " + " ".join(f"{'ab'[i % 2]}{k}" for k in noise.integers(0, 20, 130))) for i in range(210)]
    found = hmm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # told apart, 70 words of a licence and 130 of one topic gain this much over counts of all words alone
    ideal = 70 * math.log10(200 / 70) + 130 * math.log10(200 / 130 * 40 / 20)
    gained = [r["score"] - r["base_score"] for r in found if r["held_out"]]
    assert min(gained) > 0.9 * ideal, (ideal, gained[:5])
