"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as driver
from plantroom.functions.columns import filter_by_ids, full_join
from plantroom.operators.catalog import point_types, users
from plantroom.operators.metadata import assemble_metadata
from plantroom.operators.selection import select_points
from plantroom.operators.staging import promote, staging_view, unpromote, upload, upsert
from plantroom.operators.timeseries import convert_units
from plantroom.plans import all_queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_no_cross_join_no_full_merge(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert unwanted not in plan
    # Rows are merged by unique topics in one outer join; everywhere else a key may be hot.
    assert "FullOuter" not in plan or name.startswith(("upload_", "promote_"))


def test_time_range_reaches_the_scan(spark):
    plan = plan_of(driver.queries()["ts_raw"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThanOrEqual\(ts", plan)
    assert "props" not in plan and "Exchange" not in plan


def test_few_columns_one_shuffle(spark):
    assert plan_of(driver.queries()["ts_wide_raw"](spark, SF_DIR)).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["ts_wide_raw", "ts_wide_by_point", "ts_map_by_point"])
def test_crowded_seconds_shrink_before_the_shuffle(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    first_shuffle = plan.rindex("Exchange")
    assert "partial_min_by(" in plan[first_shuffle:]


@pytest.mark.parametrize(
    "name", ["ts_wide_default", "ts_wide_raw", "ts_wide_crowded", "ts_wide_last", "ts_wide_mean", "ts_wide_by_point"]
)
def test_numbers_are_combined_by_hash(spark, name):
    plan = plan_of(driver.queries()[name](spark, "/root/testdata/sf0.01"))
    assert "Sort" not in plan.replace("sortOrder", "")


def test_many_columns_shuffle_narrow_rows(spark):
    plan = plan_of(driver.queries()["ts_wide_by_point"](spark, "/root/testdata/sf0.01"))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("pivotfirst") < plan.index("REPARTITION_BY_COL")


def test_blocks_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(driver.queries()["ts_blocks"](spark, SF_DIR))


@pytest.fixture
def eager_splitting(spark):
    """No broadcasts, and thresholds at which a few thousand rows count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def hot(spark):
    """60,000 rows: a third without key, a third with key 7, a third spread out."""
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id"))
    return spark.range(0, 60000, 1, 16).select(key.alias("lk"), F.sha2(F.col("id").cast("string"), 256).alias("lv"))


def _final_plan(df):
    """The plan after running it to its end."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


def test_hot_key_of_a_full_join_is_split(spark, eager_splitting, hot):
    right = spark.range(0, 60010, 1, 4).select(F.col("id").alias("rk"), F.col("id").cast("string").alias("rv"))
    out = full_join(hot, right, "lk", "rk")
    assert "skew=true" in _final_plan(out)
    counts = out.groupBy(F.col("lv").isNull().alias("right_only"), F.col("rv").isNull().alias("left_only")).count()
    assert rows(counts) == [(False, False, 40000), (False, True, 20000), (True, False, 60010 - 20000 - 1)]


def test_hot_point_of_a_semi_join_is_split(spark, eager_splitting, hot):
    wanted = spark.range(0, 60000, 1, 4).select((F.col("id") % 30000).alias("id"))
    out = filter_by_ids(hot, "lk", wanted)
    assert "skew=true" in _final_plan(out)
    assert out.count() == 20000 + hot.where("lk < 30000 and lk <> 7").count()


def test_hot_point_of_a_unit_conversion_is_split(spark, eager_splitting, hot):
    readings = hot.select(F.col("lk").alias("point_id"), F.lit(2.0).alias("raw"), F.lit(0.0).alias("unit"), "lv")
    factors = spark.range(0, 60000, 1, 4).select(
        F.col("id").alias("point_id"), F.lit(3.0).alias("scale"), F.lit(1.0).alias("offset")
    )
    out = convert_units(readings, factors)
    assert "skew=true" in _final_plan(out)
    assert rows(out.groupBy("unit").count()) == [(0.0, 20000), (7.0, 40000)]


def test_hot_equipment_of_an_upsert_is_split(spark, eager_splitting, hot):
    updates = spark.range(0, 60010, 1, 4).select(F.col("id").alias("lk"), F.lit("new").alias("lv"))
    out = upsert(hot, updates, "lk")
    assert "skew=true" in _final_plan(out)
    assert out.where("lv = 'new'").count() == 40000 + 60010 - 20000 - 1 and out.where("lk is null").count() == 20000


def test_hot_equipment_of_an_upload_is_split(spark, eager_splitting, hot):
    staged = hot.select(F.concat(F.lit("E"), "lk").alias("e.equip_id"), F.col("lv").alias("p.topic"))
    staged = staged.where("`e.equip_id` is not null")
    rows_up = spark.range(0, 60000, 1, 4).select(F.concat(F.lit("E"), "id").alias("e.equip_id"), F.lit(1).alias("e.n"))
    out = upload(staged, rows_up).staged
    assert "skew=true" in _final_plan(out)
    assert out.count() == 40000 + 40000 - 1


def test_hot_equipment_of_a_withdrawal_is_split(spark, eager_splitting, hot):
    relationships = hot.select(F.col("lk").alias("equipment_id"), F.monotonically_increasing_id().alias("point_id"))
    live = spark.range(10).select("id", F.lit("x").alias("name"))
    listed = spark.range(0, 60000, 1, 4).select((F.col("id") % 30000).alias("e.equipment_id"))
    left = unpromote(live, live, listed.where("`e.equipment_id` <> 7"), "equipment", relationships)
    assert "skew=true" in _final_plan(left.relationships)
    assert left.relationships.where("equipment_id = 7").count() == 20000 + 0
    assert left.relationships.where("equipment_id < 30000 and equipment_id <> 7").count() == 0


def test_hot_equipment_of_metadata_is_split(spark, eager_splitting, hot):
    points = hot.select(
        F.monotonically_increasing_id().alias("id"), F.col("lk").alias("equip_id"), F.col("lv").alias("type"),
        *[F.lit(None).cast("string").alias(n) for n in ("units", "tagged_units")],
        *[F.lit(None).cast("bigint").alias(n) for n in ("first_updated", "last_updated")],
    )
    equipment = spark.range(0, 60010, 1, 4).select(
        "id", F.col("id").cast("string").alias("equip_id"), F.lit(1).alias("building_id"),
        F.lit("ahu").alias("equip_type_tag"), F.when(F.col("id") % 3 > 0, F.lit(1)).alias("parent_equip"),
    )
    out = assemble_metadata(equipment, points)
    assert _final_plan(out).count("skew=true") >= 2
    assert out.count() == 60000 + 60010 - 20000 - 1
    assert out.where("`e.parent` = '1'").count() > 0


def test_hot_measurement_of_point_types_is_split(spark, eager_splitting, hot):
    types = hot.select(F.monotonically_increasing_id().alias("id"), F.col("lv").alias("tag_name"), F.col("lk").alias("measurement_id"), F.array("lv").alias("tags"))
    measurements = spark.range(0, 60000, 1, 4).select("id", F.col("id").cast("string").alias("name"))
    units = measurements.select(F.col("id").alias("measurement_id"), F.lit("u").alias("name_abbr"), F.lit("n").alias("name_long"), F.lit("x").alias("data_type"))
    out = point_types(types, measurements, units)
    assert _final_plan(out).count("skew=true") >= 2
    assert out.count() == 60000 and out.where("unit is null").count() == 20000


def test_hot_role_of_users_is_split(spark, eager_splitting, hot):
    times = [F.lit(None).cast("bigint").alias(n) for n in ("password_reset", "last_login", "created")]
    texts = [F.lit("x").alias(n) for n in ("org_name", "email", "username", "first_name", "last_name")]
    table = hot.select(F.monotonically_increasing_id().alias("id"), F.lit(1).alias("org_id"), F.array("lk").alias("roles"), F.lit(True).alias("active"), *texts, *times)
    roles = spark.range(0, 60000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"))
    out = users(table, roles)
    assert "skew=true" in _final_plan(out)
    assert out.count() == 60000 and out.where("role is null").count() == 20000


def test_hot_equipment_of_a_selection_is_split(spark, eager_splitting, hot):
    points = hot.select(
        F.monotonically_increasing_id().alias("id"), F.col("lk").alias("equip_id"), F.lit(1).alias("building_id"), F.col("lv").alias("name")
    )
    equipment = spark.range(0, 60000, 1, 4).select(
        "id", F.col("id").cast("string").alias("equip_id"), F.lit(1).alias("building_id"), F.lit("ahu").alias("equip_type_tag")
    )
    buildings = spark.range(3).select("id", F.lit("b").alias("name"), F.lit(1).alias("org_id"))
    found = select_points({"equipment_types": "ahu"}, points, equipment, buildings)
    assert "skew=true" in _final_plan(found.points)
    assert found.points.count() == 40000


def test_hot_device_of_the_staging_view_is_split(spark, eager_splitting, hot):
    points = hot.select(
        F.col("lv").alias("topic"), F.monotonically_increasing_id().cast("string").alias("equip_ids"), F.col("lk").cast("string").alias("device_id")
    )
    equipment = spark.range(0, 100, 1, 4).select(F.concat(F.lit("E"), "id").alias("equip_id"))
    devices = spark.range(0, 60000, 1, 4).select(F.col("id").cast("string").alias("device_id"), F.sha2(F.col("id").cast("string"), 256).alias("label"))
    out = staging_view(points, equipment, devices)
    assert "skew=true" in _final_plan(out)
    assert out.where("`p.topic` is not null").count() == 60000


def test_rows_without_topic_are_spread_in_a_promotion(spark, eager_splitting, hot):
    columns = [F.col("lv").alias("p.topic"), F.col("lk").cast("string").alias("e.equip_id")]
    staged = hot.select(*columns).where("`e.equip_id` is not null")
    live = hot.select(F.when(F.col("lk").isNull(), F.col("lv")).alias("p.topic"), F.monotonically_increasing_id().alias("p.point_id"))
    listed = hot.select(F.col("lk").cast("string").alias("e.equip_id"), F.col("lv").alias("p.topic")).where("lk = 7")
    out = promote(staged, live, listed).live
    plan = _final_plan(out)
    # each side of the merge is shuffled once, and two thirds without topic do not meet in one task
    assert "FullOuter" in plan
    assert out.count() == 60000 + 20000
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 40000


def test_uploads_and_promotions_shuffle_each_side_once(spark, eager_splitting):
    topics = spark.range(0, 5000, 1, 4).select(F.concat(F.lit("t"), "id").alias("p.topic"), F.col("id").alias("p.n"))
    equipment = topics.withColumn("e.equip_id", F.lit("A"))
    for out in (upload(topics, topics).staged, promote(equipment, topics).live):
        assert plan_of(out).count("Exchange hashpartitioning") == 2
