"""The documented user journeys, through the workspace."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plantroom import PointSelector, Workspace
from plantroom.operators import staging
from plantroom.sources.tables import write_new


@pytest.fixture
def tables(table):
    return {
        "organizations": table("id int, name string", (1, "Org")),
        "buildings": table("id int, name string, org_id int", (427, "Office", 1), (428, "Laboratory", 1)),
        "roles": table("id int, name string", (1, "admin")),
        "users": table(
            "id int, org_id int, org_name string, roles array<int>, email string, username string, first_name string, "
            "last_name string, last_login bigint, created bigint, password_reset bigint, active boolean",
            (1, 1, "Org", [1], "e", "u", "f", "l", 1666000000000, None, None, True),
        ),
        "deployments": table("id int, org_id int, last_heartbeat bigint", (1, 1, 1666000000000)),
        "equipment_types": table("id int, sub_types string, flow_order int, active boolean", (1, "s", 1, True)),
        "point_types": table("id int, tag_name string, measurement_id int, tags array<string>", (1, "sat", 1, ["air"])),
        "measurements": table(
            "id int, name string, units_convertible boolean, qudt_type string, "
            "units array<struct<name_long: string, name_abbr: string, data_type: string>>",
            (1, "temperature", True, "q", [("Celsius", "c", "Continuous")]),
        ),
        "units": table("id int, name_long string", (1, "Celsius")),
        "tags": table("id int, name string", (1, "air")),
        "points": table(
            "id bigint, name string, topic string, type string, equip_id bigint, building_id int, measurement string, "
            "units string, tagged_units string, first_updated bigint, last_updated bigint, state_text struct<`0`: string>",
            (290631, "sat", "t1", "Supply Air Temperature", 10, 427, "temperature", "c", None, 1666000000000, 1666000000000, None),
            (290643, "ssp", "t2", "Supply Air Static Pressure", 10, 427, "pressure", "pa", "kpa", None, None, ("on",)),
            (290700, "zt", "t3", "Zone Temperature", 20, 428, "temperature", "c", None, None, None, None),
        ),
        "equipment": table(
            "id bigint, equip_id string, building_id int, equip_type_tag string, parent_equip bigint",
            (10, "AHU-1", 427, "ahu", None), (11, "VAV-1", 427, "vav", 10), (20, "AHU-2", 428, "ahu", None),
        ),
        "readings": table(
            "time timestamp_ntz, raw double, unit double, point_id bigint, topic string, display string",
            (datetime(2024, 1, 1, 0, 0, 0, 5), 1.0, 1.0, 290631, "t1", "sat"),
            (datetime(2024, 1, 1, 0, 0, 0, 9), 2.0, 2.0, 290643, "t2", "ssp"),
            (datetime(2024, 1, 1, 5, 0, 0), 3.0, 3.0, 290631, "t1", "sat"),
        ),
        "unit_conversions": table(
            "measurement string, from_unit string, to_unit string, scale double, offset double",
            ("temperature", "c", "k", 1.0, 273.0),
        ),
        "staging_points": table(
            "topic string, equip_ids array<string>, device_id string, building_id int, data struct<name: string>",
            ("t1", ["AHU-1"], "d1", 427, ("n1",)), ("t9", ["AHU-1"], "d1", 427, ("n9",)), ("t8", [], "d1", 427, ("n8",)),
        ),
        "staging_equipment": table("equip_id string, building_id int", ("AHU-1", 427)),
        "staging_devices": table("device_id string, building_id int", ("d1", 427)),
    }


@pytest.fixture
def site(tables):
    return Workspace(tables)


def test_catalog(site):
    assert rows(site.get_orgs(1)) == [(1, "Org")]
    assert rows(site.get_buildings(427), "name") == [("Office",)]
    assert rows(site.get_building_info([428, "Office"])) == [(427, "Office"), (428, "Laboratory")]
    assert rows(site.get_users(), "username", "role") == [("u", "admin")]
    assert site.get_deployments(1).count() == 1
    assert rows(site.get_equip_types()) == [(1,)]
    assert rows(site.get_point_types()) == [(1, "sat", "temperature", "c", "Continuous", "air")]
    assert site.get_tags().count() == site.get_all_units().count() == site.get_all_measurements().count() == 1


def test_selection_metadata_and_time_series(site):
    query = PointSelector(buildings=427, equipment_types="ahu")
    query.point_types = ["Supply Air Temperature", "Supply Air Static Pressure"]
    selection = site.select_points(query)
    assert rows(site.get_points_by_ids(selection.points), "id") == [(290631,), (290643,)]
    assert rows(site.get_equipment_by_ids(selection.equipment), "equip_id") == [("AHU-1",)]
    metadata = site.get_metadata(selection=selection)
    assert rows(metadata, "`p.point_id`", "`p.tagged_units`", "`p.state_text`") == [(290631, "c", ""), (290643, "kpa", "on")]

    six_hours = ("2024-01-01T00:00:00Z", "2024-01-01T06:00:00Z")
    assert site.get_timeseries_raw(*six_hours, [290631]).count() == 2
    wide = site.get_timeseries(*six_hours, selection.points, {"temperature": "k"})
    assert wide.columns == ["time", "sat", "ssp"]
    assert rows(wide, "sat", "ssp") == sorted([(274.0, 2.0), (276.0, None)], key=repr)
    four_hours = site.get_timeseries("2024-01-01", "2024-01-01T04:00:00", selection.points, unit_type="raw")
    assert rows(four_hours, "sat", "ssp") == [(1.0, 2.0)]
    lists = site.get_timeseries_lists(*six_hours, selection.points, {"temperature": "k"})
    assert rows(lists, "segment", "sat", "ssp") == sorted([(0, [274.0], [2.0]), (0, [276.0], None)], key=repr)


def test_metadata_by_id_and_name(site):
    out = site.get_metadata(buildings=[427, "Laboratory"])
    assert rows(out, "`p.point_id`", "`e.equip_id`", "`e.parent`") == sorted(
        [(290631, "AHU-1", None), (290643, "AHU-1", None), (None, "VAV-1", "AHU-1"), (290700, "AHU-2", None)], key=repr
    )
    for wrong in ({}, {"buildings": 427, "selection": {"points": [1]}}):
        with pytest.raises(ValueError, match="either"):
            site.get_metadata(**wrong)
    with pytest.raises(TypeError):
        site.get_metadata({"points": [1]})


def test_staging_round(site, table):
    assert site.get_staging_points(427).count() == 3
    assert site.get_staging_equip(427).count() == site.get_staging_devices(427).count() == 1
    data = site.get_staging_data("Office")
    assert data.columns == ["d.building_id", "e.building_id", "p.building_id", "p.data.name", "p.device_id", "p.equip_ids", "p.topic"]
    result = site.upload_staging(427, table("`p.topic` string, `e.equip_id` string", ("t8", "__SKIP__"), (None, "x")))
    assert rows(result.staged, "`p.topic`", "`e.equip_id`") == sorted(
        [("t1", "AHU-1"), ("t8", "__SKIP__"), ("t9", "AHU-1"), (None, "x")], key=repr
    )
    assert result.errors.count() == 0
    live = table("`p.topic` string, `p.point_id` int", ("t1", 290631))
    promoted = site.promote_data(427, live)
    assert rows(promoted.live, "`p.topic`", "`p.point_id`") == [("t1", 290631), ("t9", None)]
    assert promoted.errors.count() == 0
    left = site.unpromote_data(427, table("`p.point_id` bigint", (290631,), (290700,)))
    assert rows(left.points, "id") == [(290643,)] and left.equipment.count() == 2
    assert rows(left.relationships) == [(10, 290643)]
    pairs = site.relationships().where(F.col("equipment_id") == 10)
    assert pairs.count() == 2


def test_csv_upload(site, tmp_path):
    path = tmp_path / "batch.csv"
    path.write_text("p.topic,e.equip_id\nt8,VAV-9\nt9\n")
    result = site.upload_staging_csv("Office", str(path), "`p.topic` string, `e.equip_id` string")
    assert rows(result.staged, "`p.topic`", "`e.equip_id`") == [("t1", "AHU-1"), ("t8", "VAV-9"), ("t9", "AHU-1")]
    assert rows(result.errors, "error") == [("does not parse: t9",)]


def test_a_shared_building_name_is_refused(tables, table):
    tables["buildings"] = table("id int, name string, org_id int", (427, "Annex", 1), (428, "Annex", 1))
    site, rows_ = Workspace(tables), table("`p.topic` string, `e.equip_id` string, `p.point_id` bigint", ("t1", "A", 1))
    for call in (
        lambda: site.get_staging_data("Annex"), lambda: site.upload_staging("Annex", rows_),
        lambda: site.promote_data("Annex", rows_), lambda: site.unpromote_data("Annex", rows_),
    ):
        with pytest.raises(ValueError, match="several buildings"):
            call()


def test_readings_in_days_are_pruned(tables, spark, tmp_path):
    write_new(tables["readings"].withColumn("day", F.to_date("time")), f"{tmp_path}/readings", ["day"])
    site = Workspace.open(spark, str(tmp_path), {"readings": "time timestamp_ntz, raw double, unit double, point_id bigint, topic string, display string, day date"})
    out = site.get_timeseries_raw("2024-01-01", "2024-01-02", [290631], date_column="day")
    assert out.count() == 2
    assert "PartitionFilters: [isnotnull(day" in out._jdf.queryExecution().executedPlan().toString()


def test_tables_on_storage(tables, spark, tmp_path):
    root = str(tmp_path)
    for entity in ("buildings", "points", "equipment"):
        write_new(tables[entity], f"{root}/{entity}")
    site = Workspace.open(spark, root)
    assert site.get_buildings().count() == 2
    assert site.get_metadata(buildings="Office").count() == 3
    with pytest.raises(KeyError):
        Workspace({}).table("points")


def test_a_building_is_written_back(spark, tables, tmp_path):
    root = str(tmp_path)
    write_new(tables["buildings"], f"{root}/buildings")
    live = spark.createDataFrame([("t1", "old", 427), ("t2", "old", 428)], "`p.topic` string, `p.status` string, building_id int")
    write_new(live, f"{root}/live", ["building_id"])
    site = Workspace.open(spark, root)
    staged = spark.createDataFrame([("t1", "AHU-1", "new"), ("t9", "AHU-1", "new")], "`p.topic` string, `e.equip_id` string, `p.status` string")
    promote = lambda: staging.promote(staged, site.read_building("live", "Office")).live
    for _ in range(2):
        site.write_building("live", "Office", promote())
        assert rows(site.table("live"), "`p.topic`", "`p.status`", "building_id") == [("t1", "new", 427), ("t2", "old", 428), ("t9", "new", 427)]
    assert rows(site.read_building("live", 428), "`p.topic`") == [("t2",)]
    site.write_building("live", 428, site.read_building("live", 428).where("false"))
    assert rows(site.table("live"), "`p.topic`") == [("t1",), ("t9",)]
    with pytest.raises(ValueError, match="kept by building"):
        site.write_building("points", 427, live)
    with pytest.raises(ValueError, match="not on storage"):
        Workspace(tables).write_building("live", 427, live)


def test_metadata_in_buckets(tables, tmp_path):
    site = Workspace(tables)
    kept = site.keep_bucketed(str(tmp_path), 4)
    assert rows(site.get_metadata_bucketed(kept, 427)) == rows(site.get_metadata(buildings=427))
    whole = rows(site.get_metadata_bucketed(kept), "`p.point_id`")
    assert whole == rows(site.get_metadata_bucketed(kept, [427, "Laboratory"]), "`p.point_id`")
