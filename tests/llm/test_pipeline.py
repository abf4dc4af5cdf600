"""Each stage of the pipeline against a brute-force version, on what the stage before kept."""

import duckdb
import pytest
import test_decontaminate
import test_jaccard
import test_pii

import corpus_pipeline
from plantroom.llm import mixing, queries, toxicity
from plantroom.llm.shared import stored

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        kept.append(docs)
    return kept


def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def test_columns_and_order(stages):
    names = stages[0].columns
    assert [s.columns for s in stages[1:-1]] == [names] * 4
    assert stages[-1].columns == [*names, "domain", "n_tokens", "epochs", "part_tokens"]


def test_toxicity(spark, stages):
    found = toxicity.classified(stages[0], spark.read.parquet(f"{SF_DIR}/labels.parquet")).where("predicted = 0")
    assert texts(stages[1]).keys() == {r["doc_id"] for r in found.collect()}


def test_near_duplicates(stages):
    rows = sorted(texts(stages[1]).items())
    assert set(texts(stages[2])) == {component for _, n, component in test_jaccard.brute(rows, 5, 80)}


def test_decontamination(spark, stages):
    before = texts(stages[2])
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    # only texts that share a shingle with an item can be near one
    shingles = set().union(*(test_jaccard.shingle_set(t, 5) for _, t in benchmark))
    possible = [(i, t) for i, t in before.items() if test_jaccard.shingle_set(t, 5) & shingles]
    leaked = {d for d, *_ in test_decontaminate.brute(possible, benchmark)}
    assert leaked and texts(stages[3]).keys() == before.keys() - leaked


def test_personal_data(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        spans = test_pii.base_spans(text)
        assert (before[i] == after[i]) or spans or "[SECRET]" in after[i] or "[PHONE]" in after[i]
        assert not any(s.startswith(("email", "ip", "card")) for s in test_pii.base_spans(after[i]))
        if not spans and "[" not in after[i]:
            assert before[i] == after[i]
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect() if "[" in r["text"])


def test_mixing(stages):
    docs = stages[4].toPandas()  # noqa: F841
    expected = duckdb.sql(queries.mix_sql("docs", mixing.Mix())).fetchall()
    expected = {r[0]: r[4:7] for r in expected if r[7] > 0}
    assert {r["doc_id"]: (r["n_tokens"], r["epochs"], r["part_tokens"]) for r in stages[5].collect()} == expected
    assert {r["doc_id"]: r["text"] for r in stages[5].collect()}.items() <= texts(stages[4]).items()


def test_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", "s", None), (1, "", None, None, 0), (None, "a b c", "en", "s", 5), (2, "x y " * 60000, "de", "s", 9), (3, "x y", "de", "s", 3), (3, "x y", "de", "s", 3)]
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in result} <= {None, 2, 3} and len(result) <= 3
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
