"""Points and equipment kept in buckets of one key, so that their metadata needs no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantroom.functions.columns import argument_table, col, filter_by_ids, id_column, prefix_columns, require_columns
from plantroom.operators.metadata import cleaned, with_parent_name
from plantroom.sources.shared import stored

#: Names added to both tables: the key (0 for null), the part of a hot key that a row is in (below 0 for the null key),
#: and the number of parts of its key.
KEY, PART, PARTS = "bucket__key", "bucket__part", "bucket__parts"


@dataclass(frozen=True)
class BucketedTables:
    """Points and equipment as :func:`keep_bucketed` wrote them."""

    points: DataFrame
    equipment: DataFrame


def _hot_keys(keys: DataFrame, buckets: int) -> DataFrame:
    """(id, parts) of the keys that hold more than a bucket's share of rows: fewer than ``buckets``, a local table."""
    counts = stored(keys.groupBy("id").agg(F.count(F.lit(1)).alias("rows")), "key-counts")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    parts = F.ceil(F.col("rows") * buckets / F.lit(max(total, 1)))
    hot = counts.where(F.col("rows") * buckets > total).select("id", parts.alias("parts")).collect()
    table = {"__hot": (pa.int64(), [r["id"] for r in hot]), PARTS: (pa.int64(), [r["parts"] for r in hot])}
    return argument_table(keys.sparkSession, table)


def _keyed(df: DataFrame, key: Column, hot: DataFrame) -> DataFrame:
    """Adds the key, null for none, and its number of parts."""
    rows = df.withColumn(KEY, key)
    joined = rows.join(F.broadcast(hot), F.col(KEY).eqNullSafe(F.col("__hot")), "left").drop("__hot")
    return joined.withColumn(PARTS, F.coalesce(PARTS, F.lit(1).cast("bigint")))


def _placed(df: DataFrame, part: Column) -> DataFrame:
    signed = F.when(F.col(KEY).isNull(), -1 - part).otherwise(part)
    return df.withColumn(PART, signed.cast("bigint")).withColumn(KEY, F.coalesce(KEY, F.lit(0).cast("bigint")))


def _folder(root: str, entity: str, buckets: int) -> str:
    return f"{root.rstrip('/')}/{entity}-{buckets}-buckets"


def _write(df: DataFrame, path: str, buckets: int) -> DataFrame:
    name = f"plantroom_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, KEY, PART).sortWithinPartitions(KEY, PART)
    writer = dealt.write.mode("errorifexists").format("parquet").option("path", path)
    writer.bucketBy(buckets, KEY, PART).sortBy(KEY, PART).saveAsTable(name)
    return df.sparkSession.table(name)


def keep_bucketed(equipment: DataFrame, points: DataFrame, root: str, buckets: int) -> BucketedTables:
    """Write flat equipment and points below ``root``, a new folder, in ``buckets`` of the equipment they belong to.

    A key that holds more than a bucket's share of points, null included, is dealt to as many parts as it needs, and
    its equipment stands in each part, so every bucket holds about the same: a key adds one part for each share it
    holds, which is fewer than twice ``buckets`` parts altogether. Names of parents are looked up here, among all equipment.
    Tables are registered with the session; another one calls :func:`open_bucketed`. Columns named like the three
    that are added end the job.
    """
    require_columns(equipment, ["id", "equip_id", "parent_equip", "building_id"], "equipment")
    require_columns(points, ["id", "equip_id", "building_id"], "points")
    for df in (equipment, points):
        taken = {KEY, PART, PARTS} & {name.lower() for name in df.columns}
        if taken:
            raise ValueError(f"columns of these names are added: {', '.join(sorted(taken))}")
    hot = _hot_keys(points.select(id_column(points, "equip_id").alias("id")), buckets)
    named = with_parent_name(equipment.withColumn("id", id_column(equipment, "id")))
    dealt = _keyed(points.withColumn("equip_id", id_column(points, "equip_id")), col("equip_id"), hot)
    copied = _keyed(named, col("id"), hot).withColumn(PART, F.explode(F.sequence(F.lit(0), F.col(PARTS) - 1)))
    return BucketedTables(
        _write(_placed(dealt, F.pmod(F.monotonically_increasing_id(), PARTS)), _folder(root, "points", buckets), buckets),
        _write(_placed(copied, F.col(PART)), _folder(root, "equipment", buckets), buckets),
    )


def open_bucketed(spark: SparkSession, root: str, buckets: int) -> BucketedTables:
    """What :func:`keep_bucketed` wrote, in a session that has not registered it. Another number of buckets is refused."""

    def registered(entity: str) -> DataFrame:
        path, name = _folder(root, entity, buckets), f"plantroom_{uuid.uuid4().hex}"
        fields = spark.read.parquet(path).schema.fields
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"create table {name} ({columns}) using parquet clustered by ({KEY}, {PART}) "
            f"sorted by ({KEY}, {PART}) into {buckets} buckets location '{place}'"
        )
        return spark.table(name)

    return BucketedTables(registered("points"), registered("equipment"))


def metadata_bucketed(kept: BucketedTables, building_ids: Iterable[int] | None = None) -> DataFrame:
    """:func:`plantroom.operators.metadata.assemble_metadata` of kept tables, whole or of some buildings.

    Both joins, points with their equipment and equipment that no point asks for, read buckets against buckets: no
    row is shuffled, and no task holds more than a bucket's share of a hot key. Equipment with several parts has points,
    or it would have one part, so it is nobody's leftover. With ``building_ids`` both tables are filtered first; then
    that does not follow, and the hot keys that have points left (fewer than there are buckets) are looked up by one
    small aggregation. Parents are named wherever they stand, also in other buildings.
    """
    points, equipment = (filter_by_ids(df, "building_id", building_ids) for df in (kept.points, kept.equipment))
    left = prefix_columns(points.drop(PARTS), "p.").withColumnsRenamed({f"p.{KEY}": KEY, f"p.{PART}": PART})
    right = prefix_columns(equipment.drop(PARTS), "e.")
    same = (col(KEY) == col(f"e.{KEY}")) & (col(PART) == col(f"e.{PART}"))
    inner = ["e.id", f"e.{KEY}", f"e.{PART}", KEY, PART]
    matched = left.join(right, same, "left").drop(*[col(name) for name in inner]).withColumnRenamed("p.equip_id", "e.id")
    asked = points.select(col(KEY).alias("__key"), col(PART).alias("__part"))
    single = equipment.where(col(PARTS) == 1)
    alone = single.join(asked, (col(KEY) == col("__key")) & (col(PART) == col("__part")), "left_anti")
    if building_ids is not None:
        first = (col(PARTS) > 1) & col(PART).isin(0, -1)
        hot = points.where(col(PARTS) > 1).select(col(KEY).alias("__key"), (col(PART) < 0).alias("__none")).distinct()
        unused = (col(KEY) == col("__key")) & ((col(PART) < 0) == col("__none"))
        # fewer rows than buckets
        alone = alone.unionByName(equipment.where(first).join(F.broadcast(hot), unused, "left_anti"))
    alone = prefix_columns(alone.drop(KEY, PART, PARTS), "e.")
    return cleaned(matched.unionByName(alone, allowMissingColumns=True))
