import pytest
from conftest import rows

from plantroom.operators import selection as S


@pytest.fixture
def site(table):
    buildings = table("id int, name string, org_id int", (1, "Lab", 7), (2, "Tower", 7), (3, "1", 8))
    equipment = table(
        "id bigint, equip_id string, building_id int, equip_type_tag string",
        (10, "AHU-1", 1, "ahu"), (11, "VAV-1", 1, "vav"), (12, "AHU-2", 2, "ahu"), (13, "AHU-3", 1, "ahu"),
    )
    points = table(
        "id bigint, name string, topic string, type string, topic_hash string, equip_id string, building_id int, last_updated bigint",
        (100, "sat", "t/100", "Supply Air Temperature", "h0", "10", 1, 1600000000000),
        (101, "ssp", "t/101", "Static Pressure", "h1", "10", 1, 1600000100000),
        (102, "zt", "t/102", "Zone Temperature", "h2", "11", 1, None),
        (103, "sat", "t/103", "Supply Air Temperature", "h3", "12", 2, 1600000200000),
        (104, "x", "t/104", "Supply Air Temperature", "h4", None, 2, 1600000300000),
        (105, "y", "t/105", "Supply Air Temperature", "h5", "junk", 3, 1600000300000),
    )
    return points, equipment, buildings


def chosen(site, **criteria):
    found = S.select_points(S.PointSelector(**criteria), *site)
    return [r.id for r in found.points.orderBy("id").collect()], [r.id for r in found.equipment.orderBy("id").collect()]


@pytest.mark.parametrize(
    "criteria, points, equipment",
    [
        ({}, [100, 101, 102, 103, 104, 105], [10, 11, 12, 13]),
        ({"buildings": 1}, [100, 101, 102, 105], [10, 11, 13]),
        ({"buildings": "Lab"}, [100, 101, 102], [10, 11, 13]),
        ({"orgs": [7]}, [100, 101, 102, 103, 104], [10, 11, 12, 13]),
        ({"orgs": 7, "buildings": "Tower"}, [103, 104], [12]),
        ({"equipment_types": "ahu"}, [100, 101, 103], [10, 12, 13]),
        ({"equipment": ["AHU-1", 12]}, [100, 101, 103], [10, 12]),
        ({"point_types": ["Supply Air Temperature"]}, [100, 103, 104, 105], [10, 12]),
        ({"buildings": 2, "equipment_types": "ahu", "point_types": ["Supply Air Temperature", "Static Pressure"]}, [103], [12]),
        ({"point_ids": ["100", 104]}, [100, 104], [10]),
        ({"point_names": "sat", "point_hashes": "h3"}, [103], [12]),
        ({"point_topics": ["t/102"]}, [102], [11]),
        ({"updated_since": "2020-09-13T12:28:20"}, [101, 103, 104, 105], [10, 12]),
        ({"updated_since": 1600000200}, [103, 104, 105], [12]),
        ({"point_names": "", "buildings": ["", None]}, [100, 101, 102, 103, 104, 105], [10, 11, 12, 13]),
        ({"point_names": "absent"}, [], []),
    ],
)
def test_criteria(site, criteria, points, equipment):
    assert chosen(site, **criteria) == (points, equipment)


def test_a_mapping_works_and_unknown_fields_do_not(site):
    found = S.select_points({"orgs": "", "buildings": 2}, *site)
    assert rows(found.buildings) == [(2,)] and rows(found.orgs) == [(7,)]
    with pytest.raises(ValueError, match="colour"):
        S.select_points({"colour": "red"}, *site)


def test_ids_are_distinct(site):
    points, equipment, buildings = site
    found = S.select_points({}, points.union(points), equipment, buildings)
    assert found.points.count() == 6


def test_points_and_equipment_by_ids(site, table):
    points, equipment, _ = site
    assert rows(S.points_by_ids(points, [100, 100, 105]), "id") == [(100,), (105,)]
    assert S.points_by_ids(points, []).columns == points.columns
    assert S.points_by_ids(points, []).count() == 0 and S.points_by_ids(points, None).count() == 0
    assert rows(S.points_by_ids(points, range(100, 3000)), "id")[0] == (100,)
    assert rows(S.equipment_by_ids(equipment, table("id int", (10,), (10,), (99,))), "id") == [(10,)]


def test_a_kept_selection_no_longer_depends_on_the_tables(site):
    found = S.select_points({"buildings": 2}, *site).kept()
    assert rows(found.points) == [(103,), (104,)] and rows(found.equipment) == [(12,)]
    assert "Join" not in found.points._jdf.queryExecution().optimizedPlan().toString()


def test_a_selection_is_kept_by_one_write(site, spark):
    found = S.select_points({"equipment_types": "ahu"}, *site)
    spark.sparkContext.setJobGroup("kept", "kept")
    found.kept()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("kept"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one write, and the broadcasts and shuffles adaptive execution runs ahead of it
    assert jobs <= 8


def test_long_lists_are_semi_joins(site):
    many = [f"t/{no}" for no in range(100, 1500)]
    found = S.select_points({"point_topics": many}, *site)
    plan = found.points._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and len(plan) < 20_000
    assert rows(found.points) == [(no,) for no in range(100, 106)]
    by_ids = S.select_points({"buildings": [*range(1, 1500), "Tower"], "point_ids": list(range(102, 3000))}, *site)
    assert rows(by_ids.points) == [(102,), (103,), (104,), (105,)]


@pytest.mark.parametrize("since", [1599999999, 1600000100, 1600000100.5, 1600000101, 1, 99999999999])
def test_updated_since_is_pushed_and_exact(site, spark, tmp_path, since):
    points, equipment, buildings = site
    values = [None, 0, 5, 1599999999, 1600000100, 1600000101, 16000001005, 1600000100499, 1600000100500, 1600000101000,
              1600000100999999, 1600000101000000, 9223372036854775807, -1600000101000]
    path = f"{tmp_path}/points"
    points.limit(1).drop("id", "last_updated").crossJoin(
        spark.createDataFrame([(no, v) for no, v in enumerate(values)], "id long, last_updated long")
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    found = S.select_points({"updated_since": since}, stored, equipment, buildings)
    seconds = lambda v: None if v is None else int(str(v)[:10])
    expected = {no for no, v in enumerate(values) if v is not None and seconds(v) >= since}
    assert {r.id for r in found.points.collect()} == expected
    if 10**9 <= since < 10**10:
        plan = found.points._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [Or(" in plan or "GreaterThanOrEqual(last_updated" in plan


def test_ids_listed_over_and_over_collapse_before_the_join(site, spark):
    points, _, _ = site
    plan = S.points_by_ids(points, spark.range(10))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan
