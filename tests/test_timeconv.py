from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions import timeconv as tc


def decoded(df):
    out = tc.decode_epochs(df, ["x"]).select(F.col("x").cast("timestamp_ntz"))
    return [row[0] for row in out.collect()]


@pytest.mark.parametrize(
    "dtype, value, expected",
    [
        ("bigint", 1666000000000, datetime(2022, 10, 17, 9, 46, 40)),
        ("bigint", 1666000000, datetime(2022, 10, 17, 9, 46, 40)),
        ("double", 1666000000000.0, datetime(2022, 10, 17, 9, 46, 40)),
        ("double", 1666000000.9, datetime(2022, 10, 17, 9, 46, 40)),
        ("double", float("nan"), None),
        ("string", "1666000000000", datetime(2022, 10, 17, 9, 46, 40)),
        ("string", "junk", None),
        ("string", "", None),
        ("string", "9e99", None),
        ("string", None, None),
        ("bigint", None, None),
        ("bigint", 4102444800000, datetime(2100, 1, 1)),
        ("bigint", 12345, datetime(1970, 1, 1, 3, 25, 45)),
    ],
)
def test_epochs(table, dtype, value, expected):
    assert decoded(table(f"x {dtype}", (value,))) == [expected]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=1_000_000_000_000, max_value=9_999_999_999_999), min_size=1, max_size=20))
def test_millisecond_epochs_lose_only_the_fraction(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    assert decoded(df) == [datetime(1970, 1, 1) + timedelta(seconds=v // 1000) for v in values]


def test_iso_text_to_second(table):
    df = table("t string", ("2024-01-02T03:04:05.678Z",), ("2024-01-02T03:04:05",), ("2024-01-02T05:04:05.5+02:00",), (" ",), (None,))
    out = df.select(tc.to_second(F.col("t"), T.StringType()).cast("timestamp_ntz"))
    assert [row[0] for row in out.collect()] == [datetime(2024, 1, 2, 3, 4, 5)] * 3 + [None, None]
    for text in ("junk", "12:30", "T12:30:01", " 1:02"):
        with pytest.raises(Exception, match=f"not a time: {text}"):
            table("t string", (text,)).select(tc.to_second(F.col("t"), T.StringType())).collect()


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz"])
def test_timestamps_keep_their_type(table, dtype):
    df = table("t string", ("2024-01-02 03:04:05.678",)).select(F.col("t").cast(dtype).alias("t"))
    out = df.select(tc.to_second(F.col("t"), df.schema["t"].dataType).alias("t"))
    assert out.dtypes == [("t", dtype)]
    assert out.select(F.col("t").cast("string")).first()[0] == "2024-01-02 03:04:05"


def test_moments_without_zone_are_utc():
    assert tc.epoch_seconds("1970-01-01T00:01:00") == 60
    assert tc.epoch_seconds(datetime(1970, 1, 1, 0, 1)) == 60
    assert tc.epoch_seconds(datetime(1970, 1, 1, 1, 1, tzinfo=timezone(timedelta(hours=1)))) == 60
    assert tc.epoch_seconds(60) == 60
    assert tc.utc_datetime("1970-01-01T00:01:00Z") == datetime(1970, 1, 1, 0, 1)
