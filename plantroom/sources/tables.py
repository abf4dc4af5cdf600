"""Entity tables on shared storage."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plantroom.functions.columns import col
from plantroom.sources.drift import read_drifting
from plantroom.sources.shared import stored

#: Fixed names: one Parquet directory per entity under a workspace root.
ENTITIES = (
    "organizations",
    "buildings",
    "roles",
    "users",
    "deployments",
    "equipment_types",
    "point_types",
    "measurements",
    "units",
    "tags",
    "points",
    "equipment",
    "readings",
    "unit_conversions",
    "staging_points",
    "staging_equipment",
    "staging_devices",
    "staged",
    "live",
)


def read_table(spark: SparkSession, root: str, entity: str, schema: StructType | str | None = None) -> DataFrame:
    """One entity. Files with differing columns are merged by name, whatever the entity.

    A column whose type differs between files gets the least type that holds all
    (:func:`read_drifting`). Merging opens every file's footer, in tasks. For tables
    of very many files pass ``schema``: then no footer is opened while planning,
    columns a file lacks are null, and what the schema does not name is left out
    because it says so.
    """
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity '{entity}'")
    path = f"{root.rstrip('/')}/{entity}"
    return read_drifting(spark, path) if schema is None else spark.read.schema(schema).parquet(path)


def write_new(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write to a path that does not exist yet.

    A table is never overwritten while a plan that reads it is running; swap the
    path afterwards.
    """
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)


def replace_partitions(rows: DataFrame, path: str, column: str, touched: Sequence[int | str]) -> None:
    """Give the partitions ``touched`` of the table at ``path``, partitioned by ``column``, new contents.

    ``rows`` holds all they are to have, and may be made from the table itself: it is first written to the shared
    folder, so that nothing reads the table while files are moved. Files of other partitions are not opened, moved or
    renamed. A touched partition without rows is removed; a large one is written by several tasks. Rows of partitions
    that are not listed end the job before anything changes. Partitions are exchanged one after the other once all
    files are written; a driver lost in between leaves some old and some new, and the same call repeats safely.
    """
    values = list(dict.fromkeys(touched))
    staged = stored(rows, "partitions")
    kept = F.coalesce(col(column).isin(values), F.lit(False)) if values else F.lit(False)
    strangers = [r[0] for r in staged.where(~kept).select(col(column)).distinct().limit(3).collect()]
    if strangers:
        raise ValueError(f"rows of partitions that are not to be replaced: {column} {strangers}")
    found = {r[0] for r in staged.select(col(column)).distinct().collect()}
    # Rebalanced, not repartitioned: a partition with most of the rows is split into several files.
    writer = staged.hint("rebalance", col(column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if found:
        writer.partitionBy(column).parquet(path)
    for value in values:
        if value not in found:
            _remove(staged.sparkSession, f"{path.rstrip('/')}/{quote(column)}={quote(str(value))}")


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
