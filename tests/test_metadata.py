from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plantroom.operators import metadata as M
from plantroom.operators.selection import PointSelector, select_points

EQUIPMENT = "id bigint, equip_id string, building_id int, equip_type_tag string, parent_equip string, " \
            "child_equip string, flow_order int, points string, tags string, year int, note string"
POINTS = "id bigint, type string, equip_id string, building_id int, units string, tagged_units string, " \
         "first_updated bigint, last_updated bigint, `state_text.1` string, `state_text.0` string, raw_unit_id int, " \
         "topic_hash string, measurement_id int, point_type_name string, name string, topic string"


@pytest.fixture
def equipment(table):
    return table(
        EQUIPMENT,
        (1, "AHU-1", 5, "ahu", None, "c", 1, "p", "t", 2000, "n1"),
        (2, "VAV-1", 5, "vav", "1", "c", 1, "p", "t", 2000, "n2"),
        (3, "VAV-2", 6, "vav", "99", "c", 1, "p", "t", 2000, "n3"),
        (4, "FAN-1", 6, "fan", "junk", "c", 1, "p", "t", 2000, "n4"),
    )


def point(no, equip, building=5, tagged=None, text1=None, text0=None):
    return (no, "Zone", equip, building, "degc", tagged, 1666000000000, None, text1, text0, 1, "h", 1, "z", "n", "t")


@pytest.fixture
def points(table):
    return table(
        POINTS,
        point(10, "1", text1="on", text0="off"), point(11, "2", tagged="k"), point(12, None), point(13, "77"),
        point(14, "2", 6, text0="off"), point(15, "junk"),
    )


def test_columns_and_rows(equipment, points):
    out = M.assemble_metadata(equipment, points)
    assert out.columns == [
        "building_id", "e.equip_id", "e.equip_type", "e.equipment_id", "e.note", "e.parent", "p.first_updated",
        "p.last_updated", "p.name", "p.point_id", "p.point_type", "p.state_text", "p.tagged_units", "p.topic", "p.units",
    ]
    assert rows(out, "`p.point_id`", "`e.equipment_id`", "building_id", "`e.parent`") == sorted(
        [
            (10, 1, 5, None), (11, 2, 5, "AHU-1"), (14, 2, 5, "AHU-1"), (12, None, None, None), (15, None, None, None),
            (13, 77, None, None), (None, 3, 6, None), (None, 4, 6, None),
        ],
        key=repr,
    )


def test_state_texts_units_and_epochs(equipment, points):
    out = M.assemble_metadata(equipment, points)
    texts = {r["p.point_id"]: r["p.state_text"] for r in out.collect()}
    assert texts == {10: "on, off", 11: "", 12: "", 13: "", 14: "off", 15: "", None: ""}
    units = {r["p.point_id"]: r["p.tagged_units"] for r in out.collect()}
    assert units[10] == "degc" and units[11] == "k"
    first = out.where("`p.point_id` = 10").select(F.col("`p.first_updated`").cast("timestamp_ntz"), "`p.last_updated`")
    assert tuple(first.first()) == (datetime(2022, 10, 17, 9, 46, 40), None)


def test_no_state_texts_no_column(equipment, points):
    plain = points.drop("state_text.0", "state_text.1")
    assert "p.state_text" not in M.assemble_metadata(equipment, plain).columns


def test_broadcast_only_below_the_limit(equipment, points, monkeypatch):
    def plan(**options):
        return M.assemble_metadata(equipment, points, **options)._jdf.queryExecution().optimizedPlan().toString()

    monkeypatch.setattr(M, "likely_small", lambda df, times: True)
    assert "rightHint=(strategy=broadcast)" in plan()
    assert "strategy=broadcast" not in plan(broadcast=False)
    monkeypatch.setattr(M, "likely_small", lambda df, times: False)
    assert "strategy=broadcast" not in plan()
    assert rows(M.assemble_metadata(equipment, points)) == rows(M.assemble_metadata(equipment, points, broadcast=False))


def test_broadcast_by_bytes_and_without_a_job(equipment, points, spark, tmp_path):
    equipment.write.parquet(f"{tmp_path}/e")
    stored = spark.read.parquet(f"{tmp_path}/e")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        assert M.likely_small(stored, 2)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
        assert not M.likely_small(stored, 2)
        M.assemble_metadata(stored, points)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_add_up(equipment, points):
    out = M.assemble_metadata(equipment, points)
    matched = out.where("`p.point_id` is not null and building_id is not null").count()
    point_only = out.where("building_id is null").count()
    equipment_only = out.where("`p.point_id` is null").count()
    assert (matched, point_only, equipment_only) == (3, 3, 2) and out.count() == 8


def test_by_building(equipment, points, table):
    buildings = table("id int, name string", (5, "Lab"), (6, "Tower"))
    out = M.metadata_by_building(["Tower", "Tower"], buildings, equipment, points)
    # Point 14 belongs to the tower, its equipment does not.
    assert rows(out, "`p.point_id`", "`e.equipment_id`") == sorted([(14, 2), (None, 3), (None, 4)], key=repr)
    with pytest.raises(ValueError):
        M.metadata_by_building("Nowhere", buildings, equipment, points)


def test_by_selection(equipment, points, table):
    out = M.metadata_by_selection({"points": [10, 12], "equipment": [1]}, equipment, points)
    assert rows(out, "`p.point_id`", "`e.equipment_id`") == sorted([(10, 1), (12, None)], key=repr)
    buildings = table("id int, name string, org_id int", (5, "Lab", 1), (6, "Tower", 1))
    found = select_points(PointSelector(buildings="Lab", equipment_types="vav"), points, equipment, buildings)
    out = M.metadata_by_selection(found, equipment, points)
    assert rows(out, "`p.point_id`", "`e.parent`") == [(11, None)]


def test_selection_errors(equipment, points, spark):
    for nothing in ({"points": []}, {"equipment": [1]}, {}):
        with pytest.raises(ValueError, match="no metadata"):
            M.metadata_by_selection(nothing, equipment, points)
    for wrong in ([1, 2], 5, "x"):
        with pytest.raises(ValueError, match="mapping"):
            M.metadata_by_selection(wrong, equipment, points)


def test_missing_columns_are_named(equipment, points):
    with pytest.raises(ValueError, match="last_updated"):
        M.assemble_metadata(equipment, points.drop("last_updated"))
