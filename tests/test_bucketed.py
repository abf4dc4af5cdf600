"""Tables in buckets: the metadata of the plain join, without a shuffle."""

import pytest
from conftest import rows

from plantroom.operators import bucketed
from plantroom.operators.bucketed import keep_bucketed, metadata_bucketed, open_bucketed
from plantroom.operators.metadata import assemble_metadata

EQUIPMENT = "id bigint, equip_id string, building_id int, equip_type_tag string, parent_equip bigint, extra string"
POINTS = (
    "id bigint, type string, equip_id bigint, building_id int, units string, tagged_units string,"
    " first_updated bigint, last_updated bigint, extra string"
)


def gear(table):
    """Equipment of two buildings: one repeated, one nobody asks for, one without id, one with id 0."""
    return table(
        EQUIPMENT,
        (1, "hot", 1, "ahu", None, "x"),
        (2, "quiet", 1, "vav", 1, None),
        (3, "twin", 1, "vav", 1, "a"),
        (3, "twin", 1, "vav", 1, "b"),
        (None, "nameless", 2, "ahu", 99, None),
        (0, "zero", 2, "ahu", 1, ""),
        (7, "unasked", 2, "fan", None, None),
    )


def hot_points(spark, count=400):
    """Half of the points on equipment 1, all in building 2; a quarter without equipment; the rest on 0, 2, 3 and nothing known."""
    key = "case when id % 4 < 2 then 1 when id % 4 = 2 then null else array(0, 2, 3, 55)[int(id / 4) % 4] end"
    return spark.range(count).selectExpr(
        "id", "'sensor' as type", f"cast({key} as bigint) as equip_id",
        "case when id % 4 < 2 then 2 else int(id % 2) + 1 end as building_id", "'k' as units",
        "cast(null as string) as tagged_units", "1500000000 + id as first_updated", "cast(null as bigint) as last_updated",
        "'p' as extra",
    )


@pytest.fixture
def merged(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_same_rows_as_the_plain_join(spark, table, tmp_path):
    kept = keep_bucketed(gear(table), hot_points(spark), str(tmp_path), 8)
    expected = assemble_metadata(gear(table), hot_points(spark))
    found = metadata_bucketed(kept)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


@pytest.mark.parametrize("wanted", [[1], [2], [1, 2], [9]])
def test_some_buildings(spark, table, tmp_path, wanted):
    """Building 1 has the hot equipment without any of its points: it stands once and alone."""
    equipment, points = gear(table), hot_points(spark)
    found = metadata_bucketed(keep_bucketed(equipment, points, str(tmp_path), 8), wanted)
    expected = assemble_metadata(*[df.where(df.building_id.isin(wanted)) for df in (equipment, points)])
    # parents are looked up in the kept tables, in all buildings
    others = [f"`{name}`" for name in expected.columns if name != "e.parent"]
    assert rows(found, *others) == rows(expected, *others)
    if wanted == [1]:
        assert [r["p.point_id"] for r in found.where("`e.equip_id` = 'hot'").collect()] == [None]
    if wanted == [2]:
        assert {r["e.parent"] for r in found.where("`e.equip_id` = 'zero'").collect()} == {"hot"}


def test_no_shuffle(spark, table, tmp_path, merged):
    kept = keep_bucketed(gear(table), hot_points(spark), str(tmp_path), 8)
    plan = plan_of(metadata_bucketed(kept))
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    filtered = plan_of(metadata_bucketed(kept, [1]))
    assert filtered.count("SortMergeJoin") == 2
    # only the hot keys that have points are counted anew
    assert filtered.count("Exchange hashpartitioning") == 1


def test_hot_keys_are_dealt_over_buckets(spark, table, tmp_path):
    """Half of the points hang on one equipment and a quarter on none; each part holds a bucket's share."""
    points = hot_points(spark, 8000)
    kept = keep_bucketed(gear(table), points, str(tmp_path), 16)
    parts = dict(
        kept.points.where("equip_id = 1 or equip_id is null").groupBy("equip_id").agg({bucketed.PART: "count"}).collect()
    )
    assert parts == {1: 4000, None: 2000}
    by_part = [r["count"] for r in kept.points.where("equip_id = 1").groupBy(bucketed.PART).count().collect()]
    assert len(by_part) == 8 and max(by_part) <= 1.2 * 4000 / 8
    assert kept.points.count() == 8000


def test_another_session_opens_them(spark, table, tmp_path, merged):
    kept = keep_bucketed(gear(table), hot_points(spark), str(tmp_path), 8)
    opened = open_bucketed(spark.newSession(), str(tmp_path), 8)
    assert rows(metadata_bucketed(opened)) == rows(metadata_bucketed(kept))
    again = open_bucketed(spark, str(tmp_path), 8)
    assert "Exchange" not in plan_of(metadata_bucketed(again))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        open_bucketed(spark, str(tmp_path), 16)


def test_empty_tables_and_taken_names(spark, table, tmp_path):
    no_points, no_gear = table(POINTS), table(EQUIPMENT)
    alone = metadata_bucketed(keep_bucketed(gear(table), no_points, str(tmp_path / "a"), 4))
    assert rows(alone) == rows(assemble_metadata(gear(table), no_points)) and alone.count() == 7
    bare = metadata_bucketed(keep_bucketed(no_gear, hot_points(spark, 40), str(tmp_path / "b"), 4))
    assert rows(bare) == rows(assemble_metadata(no_gear, hot_points(spark, 40))) and bare.count() == 40
    assert metadata_bucketed(keep_bucketed(no_gear, no_points, str(tmp_path / "c"), 4)).count() == 0
    with pytest.raises(ValueError, match="bucket__key"):
        keep_bucketed(gear(table).withColumnRenamed("extra", "Bucket__KEY"), no_points, str(tmp_path / "d"), 4)
