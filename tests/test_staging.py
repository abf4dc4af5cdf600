import pytest
from conftest import rows
from pyspark.sql import functions as F

from plantroom.operators import staging as S


@pytest.fixture
def area(table):
    points = table(
        "topic string, equip_ids array<string>, device_id string, building_id int, `data.name` string, "
        "`data.presValue` string, `data.e.x` string, tags string, priority string",
        ("t1", ["A"], "d1", 1, "n1", "x", "x", "x", "x"), ("t2", [], "d1", 1, "n2", "x", "x", "x", "x"),
        ("t3", ["A", "B"], None, 1, "n3", "x", "x", "x", "x"), ("t4", ["Z"], "d9", 1, "n4", "x", "x", "x", "x"),
        ("t5", ["C"], "d2", 2, "n5", "x", "x", "x", "x"), ("t6", None, "d1", 1, "n6", "x", "x", "x", "x"),
    )
    equipment = table(
        "equip_id string, building_id int, kind string, Priority string, `data.check` string",
        ("A", 1, "ahu", "keep", "x"), ("B", 1, "vav", "keep", "x"), ("C", 2, "fan", "keep", "x"),
    )
    devices = table(
        "device_id string, building_id int, label string, VendorID int", ("d1", 1, "one", 5), ("d3", 1, "three", 5)
    )
    buildings = table("id int, name string", (1, "Lab"), (2, "Tower"), (3, "Empty"))
    return buildings, points, equipment, devices


def view(area, building="Lab", **options):
    return S.staging_data(building, *area, **options)


def test_listings(area):
    assert rows(S.staged_in(area[1], 2), "topic") == [("t5",)]
    assert S.staged_in(area[2], 1).columns == area[2].columns


def test_columns(area):
    assert view(area).columns == [
        "d.building_id", "d.label", "e.Priority", "e.building_id", "e.kind", "p.building_id", "p.data.name",
        "p.device_id", "p.equip_ids", "p.topic",
    ]


def test_rows(area):
    assert rows(view(area), "`p.topic`", "`p.equip_ids`", "`e.kind`", "`p.device_id`", "`d.label`") == sorted(
        [
            ("t1", "A", "ahu", "d1", "one"), ("t2", None, None, "d1", "one"), ("t3", "A, B", None, None, None),
            ("t4", "Z", None, "d9", None), ("t6", None, None, "d1", "one"), (None, "B", "vav", None, None),
            (None, None, None, "d3", "three"),
        ],
        key=repr,
    )


def test_several_equipment_exploded(area):
    out = view(area, multi_equip="explode")
    assert rows(out.where("`p.topic` = 't3'"), "`p.equip_ids`", "`e.kind`") == [("A", "ahu"), ("B", "vav")]
    assert out.where("`p.topic` in ('t2', 't6') and `p.equip_ids` is null").count() == 2
    assert out.where("`p.topic` is null and `p.device_id` is null").count() == 0
    with pytest.raises(ValueError):
        view(area, multi_equip="some")


def test_several_equipment_never_meet_one_of_that_name(area, table):
    buildings, points, _, devices = area
    odd = table("equip_id string, building_id int, kind string", ("A, B", 1, "odd"))
    out = S.staging_data(1, buildings, points, odd, devices)
    assert rows(out.where("`p.equip_ids` = 'A, B'"), "`p.topic`", "`e.kind`") == sorted([("t3", None), (None, "odd")], key=repr)


def test_no_devices_adds_no_row(area):
    buildings, points, equipment, devices = area
    out = S.staging_data(1, buildings, points, equipment, devices.where("false"))
    assert out.count() == 6 and out.where("`p.device_id` = 'NA'").count() == 0


def test_device_without_id_meets_equipment_without_points(area, table):
    buildings, points, equipment, _ = area
    odd = table("device_id string, building_id int, label string", (None, 1, "odd"))
    out = S.staging_data(1, buildings, points.where("topic = 't1'"), equipment, odd)
    # Equipment B has no point, hence no device: null meets null.
    assert rows(out, "`p.topic`", "`p.equip_ids`", "`d.label`") == sorted([("t1", "A", None), (None, "B", "odd")], key=repr)


def test_a_name_of_several_buildings_is_refused(area, table):
    _, points, equipment, devices = area
    annexes = table("id int, name string", (1, "Annex"), (2, "Annex"))
    with pytest.raises(ValueError, match="several buildings"):
        S.staging_data("Annex", annexes, points, equipment, devices)
    assert S.staging_data(2, annexes, points, equipment, devices).count() > 0


def test_one_building_with_points(area):
    for wrong in (["Lab", "Tower"], [], "Nowhere", "Empty"):
        with pytest.raises(ValueError):
            view(area, wrong)
    assert view(area, ["Tower"]).count() == 1


STAGED = "`p.topic` string, `e.equip_id` string, `p.note` string"


@pytest.fixture
def staged(table):
    return table(STAGED, ("t1", "A", "n1"), ("t2", "B", "n2"), ("t3", "B", "n3"), (None, "C", "n0"))


def test_upload_changes_adds_and_refuses(staged, table):
    new = table(
        "`p.topic` string, `e.equip_id` string, `p.extra` int",
        ("t1", "__SKIP__", 1), ("t9", "N", 2), (None, "X", 3), ("t2", "P", 4), ("t2", "Q", 4), ("t9", "N", 2), ("t3", None, None),
    )
    result = S.upload(staged, new)
    assert result.staged.columns == ["p.topic", "e.equip_id", "p.note", "p.extra"]
    assert rows(result.staged) == sorted(
        [
            ("t1", "__SKIP__", "n1", 1), ("t2", "B", "n2", None), ("t3", None, "n3", None), (None, "C", "n0", None),
            ("t9", "N", None, 2), (None, "X", None, None),
        ],
        key=repr,
    )
    assert rows(result.errors) == sorted(
        [
            ("t2", "P", 4, "conflicting rows for p.topic"),
            ("t2", "Q", 4, "conflicting rows for p.topic"),
        ],
        key=repr,
    )


def test_rows_without_topic_are_matched_by_equipment(staged, table):
    new = table(
        "`p.topic` string, `e.equip_id` string, `e.kind` string, `p.note` string",
        (None, "B", "fan", "not for points"), (None, "C", "ahu", None), ("t1", "A", "vav", "n9"), (None, None, "x", "y"),
        (None, "D", "a", None), (None, "D", "b", None),
    )
    result = S.upload(staged, new)
    assert rows(result.staged) == sorted(
        [("t1", "A", "n9", "vav"), ("t2", "B", "n2", "fan"), ("t3", "B", "n3", "fan"), (None, "C", "n0", "ahu")], key=repr
    )
    assert rows(result.errors, "`e.equip_id`", "error") == sorted(
        [(None, "missing p.topic or e.equip_id")] + [("D", "conflicting rows for e.equip_id")] * 2, key=repr
    )
    assert rows(S.upload(result.staged, new).staged) == rows(result.staged)


def test_upload_twice_changes_nothing(staged, table):
    new = table(STAGED, ("t1", "Z", "z"), ("t8", "Z", "z"))
    once = S.upload(staged, new)
    assert once.errors.count() == 0
    assert rows(S.upload(once.staged, new).staged) == rows(once.staged)


def test_upload_by_equipment(staged, table):
    result = S.upload(staged, table("`e.equip_id` string, `p.note` string", ("B", "both"), (None, "x")))
    assert rows(result.staged) == sorted([("t1", "A", "n1"), ("t2", "B", "both"), ("t3", "B", "both"), (None, "C", "n0")], key=repr)
    assert rows(result.errors) == [(None, "x", "missing e.equip_id")]


def test_upload_needs_a_key(staged, table):
    with pytest.raises(ValueError):
        S.upload(staged, table("`p.note` string", ("x",)))


LIVE = "`p.topic` string, `p.point_id` int, `p.note` string"


def test_promote_all_and_some(table):
    staged = table(
        STAGED, ("t1", "A", "new"), ("t2", "__SKIP__", "no"), ("t3", None, "no"), (None, "A", "no"), ("t5", "B", "b"),
        ("t6", "B", "x"), ("t6", "C", "y"),
    )
    live = table(LIVE, ("t1", 1, "old"), ("t7", 7, "stays"))
    result = S.promote(staged, live)
    assert rows(result.live) == sorted(
        [("t1", 1, "new", "A"), ("t7", 7, "stays", None), ("t5", None, "b", "B")], key=repr
    )
    assert rows(result.report) == sorted(
        [
            ("points", "t2", S.SKIPPED_POINTS), ("points", "t3", S.NO_VALID_EQUIPMENT), ("points", None, "Topic is missing"),
            ("points", "t6", "Topic is staged with different contents"),
        ],
        key=repr,
    )
    assert rows(result.errors, "topic") == sorted([(None,), ("t6",)], key=repr)
    some = table("`e.equip_id` string, `p.topic` string", ("B", "t5"), ("__SKIP__", "t2"), (None, "t3"), ("X", "t1"))
    chosen = S.promote(staged, live, some)
    assert rows(chosen.live, "`p.topic`", "`p.note`") == [("t1", "old"), ("t5", "b"), ("t7", "stays")]
    assert rows(chosen.report) == sorted([("points", "t1", S.NOT_STAGED)], key=repr)


def test_promote_then_withdraw_restores(table):
    live = table("id int, `p.topic` string, `e.equip_id` string", (1, "t1", "A"), (2, "t2", "A"))
    staged = table("id int, `p.topic` string, `e.equip_id` string", (3, "t3", "B"), (4, "t4", "B"))
    promoted = S.promote(staged, live).live
    assert promoted.count() == 4
    equipment = table("id int, equip_id string", (1, "A"))
    listed = staged.select(F.col("id").alias("p.point_id"))
    assert rows(S.unpromote(promoted, equipment, listed).points) == rows(live)


def test_promotion_errors(table):
    report = table(
        "type string, topic string, error string",
        ("building_id", "x", "bad"), ("points", "t1", S.SKIPPED_POINTS), ("equipment", "e1", S.SKIPPED_EQUIPMENT),
        ("points", "t2", f"x {S.NO_VALID_EQUIPMENT} y"), ("points", "t3", "bad"), ("equipment", "e2", "worse"),
        ("unexpected_deletes", "t4", "gone"), ("points", "t5", None),
    )
    errors = S.promotion_errors(report)
    assert rows(errors, "topic") == [("e2",), ("t3",), ("t4",), ("t5",)]
    parts = S.errors_by_section(errors)
    assert rows(parts["points"]) == [("t3", "bad"), ("t5", None)]
    assert rows(parts["equipment"]) == [("e2", "worse")]
    assert rows(parts["unexpected_deletes"]) == [("gone",)] and parts["unexpected_deletes"].columns == ["error"]


def test_melt(table):
    response = table(
        "building_id int, points map<string,string>, equipment map<string,string>, unexpected_deletes map<string,string>",
        (1, {"t1": "bad", "t2": "worse"}, {}, None),
    )
    assert rows(S.melt_report(response)) == [("points", "t1", "bad"), ("points", "t2", "worse")]
    nested = table("response map<string,map<string,string>>", ({"points": {"t": "x"}, "equipment": {"e": "y"}},))
    assert rows(S.melt_report(nested)) == [("equipment", "e", "y"), ("points", "t", "x")]
    assert rows(S.melt_report(nested, ["points"])) == [("points", "t", "x")]
    with pytest.raises(ValueError):
        S.melt_report(table("building_id int", (1,)))


def test_melt_lists_and_objects(spark, table):
    listed = table("building_id int, points map<string,string>, unexpected_deletes array<string>", (1, {"t": "bad"}, ["gone", "lost"]))
    expected = sorted([("points", "t", "bad"), ("unexpected_deletes", None, "gone"), ("unexpected_deletes", None, "lost")], key=repr)
    assert rows(S.melt_report(listed)) == expected
    text = '{"building_id": 1, "points": {"t": "bad"}, "unexpected_deletes": ["gone", "lost"], "equipment": {"e": {"why": "x"}}}'
    objects = spark.read.json(spark.sparkContext.parallelize([text, '{"building_id": 2}']))
    assert rows(S.melt_report(objects)) == sorted([*expected, ("equipment", "e", '{"why":"x"}')], key=repr)
    wrapped = table("response struct<points: map<string,string>, unexpected_deletes: array<string>>", (({"t": "bad"}, ["gone"]),))
    assert rows(S.melt_report(wrapped)) == sorted([("points", "t", "bad"), ("unexpected_deletes", None, "gone")], key=repr)


@pytest.fixture
def live(table):
    points = table("id bigint, equip_id bigint", (1, 10), (2, 10), (3, 11), (4, None))
    equipment = table("id bigint, equip_id string", (10, "A"), (11, "B"))
    return points, equipment


def test_unpromote_points(live, table):
    listed = table("`p.point_id` string, `e.equipment_id` string, other string", ("1", "10", "x"), ("1", "10", "y"), (None, "11", "z"))
    assert rows(S.withdrawal_pairs(listed)) == sorted([(1, 10), (None, 11)], key=repr)
    left = S.unpromote(*live, listed)
    assert rows(left.points, "id") == [(2,), (3,), (4,)] and left.equipment.count() == 2 and left.relationships is None


def test_unpromote_equipment(live, table):
    relationships = live[0].select(F.col("equip_id").alias("equipment_id"), F.col("id").alias("point_id"))
    alone = S.unpromote(*live, table("`e.equipment_id` bigint", (10,)), "equipment", relationships)
    assert rows(alone.equipment, "id") == [(11,)] and alone.points.count() == 4
    assert rows(alone.relationships) == sorted([(11, 3), (None, 4)], key=repr)
    both = S.unpromote(*live, table("`e.equipment_id` bigint, `p.point_id` bigint", (10, 1), (10, 3)), "equipment")
    assert rows(both.equipment, "id") == [(11,)] and rows(both.points, "id") == [(2,), (4,)]


def test_unpromote_arguments(live, table):
    listed = table("`e.equipment_id` bigint", (10,))
    with pytest.raises(ValueError, match="p.point_id"):
        S.unpromote(*live, listed, "points")
    with pytest.raises(ValueError):
        S.unpromote(*live, listed, "devices")
    with pytest.raises(ValueError, match="e.equipment_id"):
        S.unpromote(*live, table("`p.point_id` bigint", (1,)), "equipment")


def test_upload_changes(table):
    staged = table(
        "`p.topic` string, `e.equip_id` string, `p.n` int, `p.kept` int",
        ("same", "A", 1, 5), ("other", "A", 1, 5), ("null", None, None, 5), ("twice", "A", 1, 5), ("twice", "A", 2, 5), (None, "A", 1, 5),
    )
    upload = table(
        "`p.topic` string, `e.equip_id` string, `p.n` int, `p.new` string",
        ("same", "A", 1, None), ("same", "A", 1, None), ("other", "A", 2, None), ("null", None, None, None), ("twice", "A", 1, None),
        ("fresh", "B", 3, "x"), ("disputed", "A", 1, None), ("disputed", "A", 2, None), (None, "A", 1, None),
    )
    expected = [("fresh", "inserted"), ("null", "unchanged"), ("other", "changed"), ("same", "unchanged"), ("twice", "changed")]
    assert rows(S.upload_changes(staged, upload)) == expected
    left = S.changed_rows(staged, upload.where("`p.topic` is not null"))
    assert rows(left, "`p.topic`") == [("disputed",), ("disputed",), ("fresh",), ("other",), ("twice",)]
    again = S.upload(staged, upload).staged
    assert {r["change"] for r in S.upload_changes(again, upload).collect()} == {"unchanged"}
    assert rows(S.upload(staged, left).staged) == rows(S.upload(staged, upload.where("`p.topic` is not null")).staged)


def test_errors_by_topic_in_parts(spark, table):
    hot = spark.range(5000).selectExpr("'points' as type", "'hot' as topic", "'message ' || cast(id % 700 as string) as error")
    few = table("type string, topic string, error string", ("points", None, "a"), ("points", None, "a"), ("equipment", "t", None), ("equipment", "t", "b"))
    out = S.errors_by_topic(hot.unionByName(few), messages_a_row=100).collect()
    parts = [r for r in out if r["topic"] == "hot"]
    assert 5 <= len(parts) <= 7 and max(len(r["messages"]) for r in parts) < 160
    assert sum(r["errors"] for r in parts) == 5000 and len({m["error"] for r in parts for m in r["messages"]}) == 700
    small = {(r["type"], r["topic"]): (r["part"], [tuple(m) for m in r["messages"]], r["errors"]) for r in out if r["topic"] != "hot"}
    assert small == {("points", None): (0, [("a", 2)], 2), ("equipment", "t"): (0, [(None, 1), ("b", 1)], 2)}
