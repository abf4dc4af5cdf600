"""The manifest against hashes computed one by one."""

import binascii
import random
from hashlib import sha256

import duckdb
import pytest

from plantroom.llm import merkle, queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(hashes):
    """The root of some hashes, and the siblings of each, level by level."""
    proofs, places, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for n, place in enumerate(places):
            run = runs[place // 3]
            proofs[n].append((run[: place % 3], run[place % 3 + 1 :]))
            places[n] = place // 3
        level = [digest(*run) for run in runs]
    return level[0], proofs


def expected(docs):
    by_source = {}
    for row in docs:
        by_source.setdefault(row["source"], []).append(row)
    groups = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    climbed = []
    for source in groups:
        by_source[source].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        climbed.append(climb([leaf(r, r["text"]) for r in by_source[source]]))
    root, above = climb([subroot for subroot, _ in climbed])
    out = []
    for source, (subroot, proofs), up in zip(groups, climbed, above, strict=True):
        for row, proof in zip(by_source[source], proofs, strict=True):
            text = row["text"]
            hit = row["doc_id"] is not None and binascii.crc32(str(row["doc_id"]).encode()) % 2 == 0
            node = leaf(row, text.replace("\n", "") if hit and text is not None else text)
            for before, after in proof + up:
                node = digest(*before, node, *after)
            siblings = [h for before, after in proof + up for h in before + after]
            out.append((row["doc_id"], leaf(row, text), subroot, root, digest(*siblings), node, node == root))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def small(n, sources, seed=5):
    pick = random.Random(seed)
    texts = ["", "a\nb", "lines\n\n\n", "no line", None, "é\n\U0001f600", "x" * 50_000 + "\n"]
    return [
        {"doc_id": i, "text": pick.choice(texts), "lang": pick.choice(["en", None]), "source": pick.choice(sources), "n_chars": pick.choice([i, None])}
        for i in range(n)
    ]


def table(spark, docs):
    return spark.createDataFrame([tuple(d[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for d in docs], COLUMNS).repartition(5)


def test_given_documents(spark):
    docs = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows = found(queries.op13_nested_rollup(spark, "/root/testdata/sf0.01"))
    assert rows == expected(docs)
    assert {r[-1] for r in rows} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_sizes_of_one_source(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "DIGITS", 2)
    docs = small(n, ["one"])
    assert found(merkle.manifest(table(spark, docs))) == expected(docs)


def test_several_blocks_and_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 2)
    docs = small(400, ["hot"] * 10 + [None, "", "z", "é", "\U0001f600", "￿", *[f"s{i}" for i in range(20)]])
    assert found(merkle.manifest(table(spark, docs))) == expected(docs)


def test_nulls_ties_and_repeated_rows(spark):
    docs = small(20, ["a", None]) + small(20, ["a", None])
    docs += [{"doc_id": None, "text": t, "lang": None, "source": s, "n_chars": None} for t in ("b\n", None, "b\n") for s in ("a", None)]
    docs += [{"doc_id": 3, "text": f"other {i}\n", "lang": "en", "source": "a", "n_chars": 1} for i in range(5)]
    assert found(merkle.manifest(table(spark, docs))) == expected(docs)


def test_empty_table_and_clashing_columns(spark):
    docs = small(30, ["a", "b"])
    df = table(spark, docs)
    assert found(merkle.manifest(df.limit(0))) == []
    names = ["rank", "hash", "path", "tree", "below", "block", "d0", "part", "local", "leaf", "root", "subroot", "all", "place", "child"]
    for name in names:
        df = df.selectExpr("*", f"'x' as `{name}`")
    assert found(merkle.manifest(df)) == expected(docs)


def test_all_rows_alike(spark):
    docs = [{"doc_id": 1, "text": "a\n", "lang": "en", "source": "s", "n_chars": 2}] * 50
    assert found(merkle.manifest(table(spark, docs))) == expected(docs)


def test_sql_climbs_higher_levels():
    docs = small(300, ["a"] * 5 + ["b", None, ""])
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [[d[c] for c in ("doc_id", "text", "lang", "source", "n_chars")] for d in docs])
    assert sorted(con.execute(queries.ORACLES["op13_nested_rollup"]).fetchall(), key=repr) == expected(docs)
