"""Mixing: budgets against a plain water-filling, documents against SQL."""

import random
from fractions import Fraction

import duckdb
import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from plantroom.llm import mixing, queries


def pour(budget, children):
    """Real-valued shares of a budget among (weight, cap): equal levels, none above its cap."""
    shares, open_ = [Fraction(0)] * len(children), list(range(len(children)))
    left = Fraction(budget)
    while open_:
        weight = sum(children[i][0] for i in open_)
        full = [i for i in open_ if children[i][1] * weight <= left * children[i][0]]
        if not full:
            for i in open_:
                shares[i] = left * children[i][0] / weight
            break
        for i in full:
            shares[i] = Fraction(children[i][1])
        left -= sum(children[i][1] for i in full)
        open_ = [i for i in open_ if i not in full]
    return shares


@pytest.mark.parametrize("seed", range(4))
def test_siblings_share_by_weight(spark, seed):
    rng = random.Random(seed)
    children = [(f"n{i}", rng.randrange(1, 6), rng.choice([0, rng.randrange(1, 50), rng.randrange(10**9)])) for i in range(12)]
    budget = rng.randrange(sum(c for *_, c in children) + 1)
    weights = {n: w for n, w, _ in children}
    nodes = spark.createDataFrame([(1, n, c, budget) for n, _, c in children], "root int, name string, cap long, budget long")
    found = {r["name"]: r["part"] for r in mixing.share_out(nodes, ["root"], "name", weights, 1).collect()}
    assert sum(found.values()) == budget
    for (n, _, cap), share in zip(children, pour(budget, [(w, c) for _, w, c in children]), strict=True):
        assert found[n] <= cap and abs(found[n] - share) <= 1


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("domain0", "en", "a", 100), ("domain0", "en", "b", 1000), ("domain0", "de", "c", 1000), ("domain1", "en", "d", 1000)],
        "domain string, lang string, source string, tokens long",
    )
    mix = mixing.Mix(domains={}, langs={}, share=(1000, 3100), max_epochs=1)
    found = {r["source"]: r["budget"] for r in mixing.leaf_budgets(leaves, mix).collect()}
    # source a lacks 25 of its 125, its sibling b takes them
    assert found == {"a": 100, "b": 150, "c": 250, "d": 500}
    short = leaves.where("source <> 'b'")
    found = {r["source"]: r["budget"] for r in mixing.leaf_budgets(short, mixing.Mix(domains={}, langs={}, share=(1000, 2100), max_epochs=1)).collect()}
    # now English as a whole lacks 150 and German makes up for them; the other domain gets no more
    assert found == {"a": 100, "c": 400, "d": 500}


def test_query_against_sql(spark):
    con = connect("/root/testdata/sf0.01")
    name = "op8_hierarchical_budgeting"
    assert spark_rows(queries.QUERIES[name](spark, "/root/testdata/sf0.01")) == duck_rows(con, queries.ORACLES[name])


def documents(spark, n=400):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(0, 30), rng.choice(["en", "de", "fr", None]), f"src{rng.choice([0, 0, 0, 1, 2, 3, 4])}", 1) for i in range(n)]
    rows += [(1, None, "en", "src0", 1), (None, "a b", None, None, 1), (7, " \n", "en", "src9", 1), (8, "x " * 100_000, "es", "src5", 1), (9, "x y z", "es", "src5", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epochs int"), rows


def test_budgets_are_met_exactly_and_sql_agrees(spark):
    docs, rows = documents(spark)
    mix = mixing.Mix(share=(3, 4), max_epochs=3)
    found = mixing.mixed(docs, mix).collect()
    assert len(found) == len(rows)
    total = sum(r["n_tokens"] for r in found)
    assert total == sum(len((t or "").encode().split()) for _, t, *_ in rows)
    assert sum(r["taken"] for r in found) == total * 3 // 4
    table = docs.drop("epochs").toArrow()  # noqa: F841
    expected = duckdb.sql(queries.mix_sql("table", mix).replace("FROM table)", "FROM \"table\")")).fetchall()
    columns = ["doc_id", "domain", "lang", "source", "n_tokens", "epochs", "part_tokens", "taken"]
    assert sorted([tuple(r[c] for c in columns) for r in found], key=repr) == sorted(expected, key=repr)


def test_selected_documents_keep_their_columns(spark):
    docs, _ = documents(spark)
    used = mixing.selected(docs)
    assert used.columns == ["doc_id", "text", "lang", "source", "domain", "n_tokens", "epochs", "part_tokens"]
    taken = mixing.mixed(docs).where("taken > 0")
    assert used.count() == taken.count() and used.where(F.col("text").isNull()).count() == 0
    assert mixing.mixed(docs.where("false")).collect() == [] and mixing.selected(docs.where("false")).collect() == []


@pytest.mark.parametrize("budget", [6, 9, 10])
def test_equal_rows_have_numbers_of_their_own(spark, budget):
    docs = spark.createDataFrame([(5, "a b c", "en", "s", 9)] * 4, "doc_id long, text string, lang string, source string, Number int")
    mix = mixing.Mix(share=(budget, 12), max_epochs=1)
    taken = sorted(r["taken"] for r in mixing.mixed(docs, mix).collect())
    used = mixing.selected(docs, mix).collect()
    assert sum(taken) == budget
    assert sorted(r["epochs"] * r["n_tokens"] + r["part_tokens"] for r in used) == [t for t in taken if t]
    assert all((r["doc_id"], r["text"], r["Number"]) == (5, "a b c", 9) for r in used)


def test_the_seed_changes_the_draw_only(spark):
    docs, _ = documents(spark)
    one, two = ([(r["doc_id"], r["taken"]) for r in mixing.mixed(docs, mixing.Mix(seed=s)).collect()] for s in (1, 2))
    assert sorted(one, key=str) != sorted(two, key=str) and sum(t for _, t in one) == sum(t for _, t in two)
