import pytest
from conftest import rows
from pyspark.sql import functions as F

from plantroom.functions import columns as C


def test_prefix_drop_and_sort_keep_dotted_names(table):
    df = table("id int, `a.b` int, flow int, Zeta int", (1, 2, 3, 4))
    out = C.sort_columns(C.drop_matching(C.prefix_columns(df, "p."), "flow"))
    assert out.columns == ["p.Zeta", "p.a.b", "p.id"]
    assert rows(out) == [(4, 2, 1)]


def test_drop_matching_case(table):
    df = table("PresValue int, keep int", (1, 2))
    assert C.drop_matching(df, "presvalue").columns == ["PresValue", "keep"]
    assert C.drop_matching(df, "presvalue", ignore_case=True).columns == ["keep"]


def test_flatten_any_depth_and_arrays_stay(table):
    df = table("id int, a struct<b: int, c: struct<d: string, e: array<int>>>", (1, (2, ("x", [1, 2]))))
    out = C.flatten(df)
    assert out.columns == ["id", "a.b", "a.c.d", "a.c.e"]
    assert rows(out) == [(1, 2, "x", [1, 2])]


def test_flatten_of_null_object_gives_nulls(table):
    df = table("id int, a struct<b: int, c: int>", (1, None))
    assert rows(C.flatten(df)) == [(1, None, None)]


def test_flatten_refuses_repeated_names(table):
    df = table("`a.b` int, a struct<b: int>", (1, (2,)))
    with pytest.raises(ValueError, match="a.b"):
        C.flatten(df)


def test_columns_to_text(table):
    df = table(
        "id int, tags array<string>, nested array<array<int>>, ok boolean",
        (1, ["a", None, "b"], [[1], [2, 3]], True),
        (2, [], None, None),
    )
    assert rows(C.columns_to_text(df)) == [("1", "a, NA, b", "1, 2, 3", "true"), ("2", "", "", None)]


def test_valid_ids():
    assert C.valid_ids([1, "2", "x", None, 2.9, "", float("nan"), 1, "9007199254740993", "9e99"]) == [1, 2, 9007199254740993]


@pytest.mark.parametrize(
    "ids, expected",
    [
        (None, [1, 2, 3]),
        (2, [2]),
        ("3", [3]),
        ([1, 1, 3], [1, 3]),
        ([2, "junk", None], [2]),
        (["junk"], []),
        ([], []),
        (range(2, 5000), [2, 3]),
    ],
)
def test_filter_by_ids(table, ids, expected):
    df = table("id int", (1,), (2,), (3,), (None,))
    found = sorted(row.id for row in C.filter_by_ids(df, "id", ids).where("id is not null").collect())
    assert found == expected


def test_filter_by_ids_can_mean_all(table):
    df = table("id int", (1,), (2,))
    assert C.filter_by_ids(df, "id", ["junk"], "all").count() == 2
    assert C.filter_by_ids(df, "id", table("x string", ("junk",)), "all").count() == 2
    with pytest.raises(ValueError):
        C.filter_by_ids(df, "id", [1], "none")


def test_filter_by_a_table_of_ids(table):
    df = table("id bigint, v string", (1, "a"), (2, "b"), (None, "c"))
    wanted = table("x string", ("1",), ("1",), ("junk",), (None,))
    assert rows(C.filter_by_ids(df, "id", wanted)) == [(1, "a")]


def test_full_join_matches_null_with_null_and_keeps_both_sides(table):
    left = table("l.k int, lv string".replace("l.k", "lk"), (1, "a"), (None, "b"), (7, "c"), (1, "d"))
    right = table("rk int, rv string", (1, "x"), (None, "y"), (9, "z"))
    out = C.full_join(left, right, "lk", "rk")
    assert out.columns == ["lk", "lv", "rv"]
    assert rows(out) == sorted(
        [(1, "a", "x"), (1, "d", "x"), (None, "b", "y"), (7, "c", None), (9, None, "z")], key=repr
    )


def test_full_join_equals_the_built_in_one(spark):
    left = spark.range(500).select((F.col("id") % 40).alias("lk"), F.col("id").alias("lv"))
    left = left.withColumn("lk", F.when(F.col("lk") > 3, F.col("lk")))
    right = spark.range(60).select(F.when(F.col("id") != 5, F.col("id")).alias("rk"), (F.col("id") * 2).alias("rv"))
    built_in = left.join(right, F.col("lk").eqNullSafe(F.col("rk")), "full").select(
        F.coalesce("lk", "rk").alias("lk"), "lv", "rv"
    )
    assert rows(C.full_join(left, right, "lk", "rk")) == rows(built_in)


def test_full_join_refuses_shared_names(table):
    with pytest.raises(ValueError):
        C.full_join(table("k int, v int", (1, 1)), table("r int, v int", (1, 1)), "k", "r")


def test_inline_if_few(spark, monkeypatch):
    assert sorted(C.inline_if_few(spark.range(3).union(spark.range(3)))) == [0, 1, 2]
    monkeypatch.setattr(C, "INLINE_ID_LIMIT", 2)
    many = spark.range(3)
    assert C.inline_if_few(many) is many
