from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from plantroom.operators import catalog


@pytest.fixture
def sites(table):
    return table(
        "id int, name string, org_id int",
        (1, "Laboratory", 10), (2, "3", 10), (3, "Tower", 11), (4, "Twin", 11), (5, "Twin", 11), (6, None, 12),
    )


def test_orgs_and_buildings_by_id(sites):
    assert rows(catalog.buildings(sites, [1, 3, 3]), "id") == [(1,), (3,)]
    assert catalog.buildings(sites).count() == 6
    assert catalog.organizations(sites, ["x"]).count() == 0
    assert catalog.organizations(sites, ["x"], if_no_valid_id="all").count() == 6


def test_building_info_takes_names_before_ids_in_request_order(sites):
    found = catalog.building_info(sites, ["Tower", 3, 1, "Tower", "Twin"])
    assert [tuple(r) for r in found.collect()] == [
        (3, "Tower"), (2, "3"), (1, "Laboratory"), (3, "Tower"), (4, "Twin"), (5, "Twin"),
    ]


def test_building_without_name_does_not_disturb(sites):
    assert rows(catalog.building_info(sites, 6)) == [(6, None)]


def test_unknown_building(sites):
    with pytest.raises(ValueError, match="Nowhere"):
        catalog.building_info(sites, [1, "Nowhere"])
    assert rows(catalog.building_info(sites, [1, "Nowhere"], check=False)) == [(1, "Laboratory")]
    with pytest.raises(ValueError):
        catalog.building_info(sites, [])


def test_building_ids_are_text_compared(sites):
    with pytest.raises(ValueError):
        catalog.building_info(sites, "01")
    assert sorted(catalog.building_ids(sites, ["Twin", 3, 1])) == [1, 2, 4, 5]


USER = "id int, org_id int, org_name string, roles array<int>, email string, username string, first_name string, " \
       "last_name string, last_login bigint, created double, password_reset string, active boolean"


def user(no, roles):
    return (no, 1, "org", roles, "e", "u", "f", "l", 1666000000000, 1666000000000.0, "junk", True)


def test_users_one_row_per_role(table):
    people = table(
        USER, user(1, []), user(2, [1]), user(3, [1, 2, 3]), user(4, [1, 3, 9]), user(5, [1, 2, 3, 1, 2, 3]), user(6, None)
    )
    roles = table("id int, name string", (1, "one"), (2, "two"), (3, "three"))
    out = catalog.users(people, roles)
    assert out.columns == list(catalog.USER_COLUMNS)
    assert rows(out, "id", "role") == sorted(
        [(1, None), (2, "one"), (3, "one"), (3, "two"), (3, "three"), (4, "one"), (4, "three"), (4, None), (6, None)]
        + [(5, r) for r in ("one", "two", "three")] * 2,
        key=repr,
    )
    first = out.select(F.col("last_login").cast("timestamp_ntz"), F.col("created").cast("timestamp_ntz"), "password_reset")
    assert tuple(first.first()) == (datetime(2022, 10, 17, 9, 46, 40), datetime(2022, 10, 17, 9, 46, 40), None)
    assert catalog.users(people, roles, ids=[5], max_roles=4).count() == 4
    assert catalog.users(people, roles, ids=["x"]).count() == 0


def test_deployments(table):
    df = table("id int, org_id int, last_heartbeat bigint", (1, 7, 1666000000000), (2, 8, None))
    out = catalog.deployments(df, [7]).select("id", F.col("last_heartbeat").cast("timestamp_ntz"))
    assert rows(out) == [(1, datetime(2022, 10, 17, 9, 46, 40))]
    assert rows(catalog.deployments(df), "id", "last_heartbeat")[1] == (2, None)


def test_equipment_types(table):
    df = table(
        "id int, tag_name string, sub_types array<int>, flow_order int, active boolean",
        (1, "ahu", [1], 1, True), (2, "vav", [], 2, False), (3, "fan", None, 3, None),
    )
    out = catalog.equipment_types(df)
    assert out.columns == ["id", "tag_name"] and rows(out) == [(1, "ahu")]


MEASUREMENTS = "id int, name string, units_convertible boolean, qudt_type string, " \
               "units array<struct<name_long: string, name_abbr: string, data_type: string>>"


def test_point_types(table):
    types = table(
        "id int, tag_name string, measurement_id int, tags array<string>",
        (1, "air temp", 10, ["air", "temp(1)"]), (2, "mode", 11, []), (3, "lost", 99, None), (4, "none", None, ["a"]),
    )
    measurements = table(
        MEASUREMENTS,
        (10, "temperature", True, "q", [("Celsius", "c", "Continuous"), ("Kelvin", "k", "Continuous")]),
        (11, "mode", False, "q", []),
    )
    expected = sorted(
        [
            (1, "air temp", "temperature", "c", "Continuous", "air, temp(1)"),
            (1, "air temp", "temperature", "k", "Continuous", "air, temp(1)"),
            (2, "mode", "mode", None, None, ""),
            (3, "lost", None, None, None, ""),
            (4, "none", None, None, None, "a"),
        ],
        key=repr,
    )
    assert rows(catalog.point_types(types, measurements)) == expected
    units = measurements.select(F.col("id").alias("measurement_id"), F.inline("units"))
    assert rows(catalog.point_types(types, measurements.drop("units"), units)) == expected
    assert catalog.point_types(types, measurements, tags_as_text=False).schema["tags"].dataType.simpleString() == "array<string>"
