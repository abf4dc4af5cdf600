"""Profiles of stored readings: taken while they are written, and no job afterwards."""

import pytest
from conftest import rows

from plantroom.operators.profiles import read_profile, write_profiled
from plantroom.operators.timeseries import timeseries_wide
from plantroom.sources.layout import read_readings, write_readings

READINGS = "time string, raw string, unit string, point_id bigint, topic string, display string"


def readings(table):
    return table(
        READINGS,
        ("2024-01-01T00:00:00Z", "1", "1.5", 1, "a", "flow"),
        ("2024-01-01T00:00:01Z", "0", "NA", 1, "a", "flow"),
        ("2024-01-01T00:00:00Z", "T", "2", 2, "b", "fan"),
        ("2024-01-01T00:00:02Z", None, None, 2, "b", "fan"),
        ("2024-01-01T00:00:02Z", "off", "1e3", 3, "c", None),
    )


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    result = work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("unit_type", ["raw", "default"])
@pytest.mark.parametrize("columns", [None, ["flow"], ["fan"], ["flow", "fan"], ["absent"]])
def test_same_table_without_a_job(spark, table, tmp_path, unit_type, columns):
    write_profiled(readings(table), str(tmp_path / "r"))
    stored, profile = spark.read.schema(READINGS).parquet(str(tmp_path / "r")), read_profile(spark, str(tmp_path / "r"))
    group = f"profiled-{unit_type}-{columns}"
    wide, jobs = jobs_of(spark, group, lambda: timeseries_wide(stored, unit_type, columns, profile=profile))
    assert jobs == 0
    expected = timeseries_wide(readings(table), unit_type, columns)
    assert wide.dtypes == expected.dtypes and rows(wide) == rows(expected)


def test_profile_is_read_as_written(spark, table, tmp_path):
    written = write_profiled(readings(table), str(tmp_path / "r"))
    assert read_profile(spark, str(tmp_path / "r")) == written
    assert written.names == ("NA", "fan", "flow")
    assert written.value_type("raw", ["flow"]) == "int"
    assert written.value_type("raw", ["fan"]) == "boolean"
    assert written.value_type("raw", ["flow", "fan"]) == written.value_type("raw", ["NA"]) == "string"
    assert written.value_type("unit", written.names) == "double"


def test_part_of_the_readings_has_all_columns(spark, table, tmp_path):
    profile = write_profiled(readings(table), str(tmp_path / "r"))
    part = spark.read.parquet(str(tmp_path / "r")).where("point_id = 1")
    wide = timeseries_wide(part, "raw", profile=profile)
    assert wide.dtypes == [("time", "timestamp"), ("NA", "string"), ("fan", "string"), ("flow", "string")]
    assert rows(wide, "flow", "fan") == [("0", None), ("1", None)]


def test_typed_values_empty_tables_other_names(spark, table, tmp_path):
    typed = table("time string, unit double, point_id bigint, display string", ("2024-01-01T00:00:00Z", 2.5, 1, "flow"))
    profile = write_profiled(typed, str(tmp_path / "typed"))
    assert profile.names == ("flow",) and profile.value_type("unit", ["flow"]) is None
    assert rows(timeseries_wide(typed, profile=profile), "flow") == [(2.5,)]
    empty = write_profiled(table(READINGS), str(tmp_path / "empty"))
    assert read_profile(spark, str(tmp_path / "empty")) == empty and empty.names == ()
    assert empty.value_type("raw", empty.names) == "boolean"
    assert timeseries_wide(table(READINGS), "raw", profile=empty).columns == ["time"]
    with pytest.raises(ValueError, match="names from 'display'"):
        timeseries_wide(readings(table), "raw", names_from="topic", profile=profile)


def test_laid_out_readings_have_one_too(spark, table, tmp_path):
    path, source = str(tmp_path / "days"), readings(table)
    profile = write_profiled(source, path, names_from="topic", write=write_readings)
    assert read_profile(spark, path) == profile and profile.names == ("a", "b", "c")
    wide = timeseries_wide(read_readings(spark, path, source.schema), "raw", names_from="topic", profile=profile)
    assert rows(wide) == rows(timeseries_wide(source, "raw", names_from="topic"))
