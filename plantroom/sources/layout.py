"""Readings on storage, laid out for the queries that read them: some points, some hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import col, require_columns
from plantroom.functions.timeconv import text_time

#: Bytes of a row group: the least that a query of one point reads of a file's column chunks.
ROW_GROUP_BYTES = 16 << 20
#: Rows of a page: what is decoded, or skipped by its bounds, as a whole.
PAGE_ROWS = 4096
#: Different points the Bloom filter of a row group is made for.
POINTS_A_GROUP = 20_000


def utc_date(readings: DataFrame) -> Column:
    """The UTC date of ``time``, whatever the session's zone; null where there is no time."""
    dtype = readings.schema["time"].dataType
    if isinstance(dtype, T.DateType):
        return F.col("time")
    if isinstance(dtype, T.TimestampNTZType):
        return F.col("time").cast("date")
    time = text_time(F.col("time")) if isinstance(dtype, T.StringType) else F.col("time")
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))


def write_readings(
    readings: DataFrame,
    path: str,
    date_column: str = "date",
    row_group_bytes: int = ROW_GROUP_BYTES,
    points_a_group: int = POINTS_A_GROUP,
) -> None:
    """Write readings to a new path, a directory a UTC day, each ordered by point and time, with Bloom filters on points.

    Rows are cut into ranges of (day, point, time), so a file holds few points, its row groups have narrow bounds, and
    a day or a point with most of the rows is spread over as many tasks as its share; equal rows are dealt at random.
    Bounds of timestamps need the session settings of :func:`plantroom.configure`. Readings without time stand in a directory of their own and in no range. ``date_column`` must be a new name.
    """
    require_columns(readings, ["time", "point_id"], "readings")
    if date_column.lower() in (name.lower() for name in readings.columns):
        raise ValueError(f"readings already have a column '{date_column}'")
    order = [col(date_column), F.col("point_id"), F.col("time")]
    dealt = readings.withColumn(date_column, utc_date(readings)).withColumn("__salt", F.rand(17))
    ranged = dealt.repartitionByRange(*order, F.col("__salt")).sortWithinPartitions(*order).drop("__salt")
    options = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.bloom.filter.enabled#point_id": "true",
        "parquet.bloom.filter.expected.ndv#point_id": points_a_group,
    }
    ranged.write.mode("errorifexists").options(**options).partitionBy(date_column).parquet(path)


def read_readings(spark: SparkSession, path: str, schema: T.StructType, date_column: str = "date") -> DataFrame:
    """Readings written by :func:`write_readings`; ``schema`` is that of the readings, without the day.

    Name ``date_column`` in :func:`plantroom.operators.timeseries.timeseries_raw` and directories of other days are not
    listed, files and row groups of other points not read.
    """
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(date_column, T.DateType())])).parquet(path)
