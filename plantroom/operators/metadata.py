"""One flat metadata table out of equipment and points."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.functions.columns import (
    col,
    drop_matching,
    filter_by_ids,
    full_join,
    id_column,
    inline_if_few,
    likely_small,
    prefix_columns,
    require_columns,
    sort_columns,
)
from plantroom.functions.timeconv import decode_epochs
from plantroom.operators.catalog import building_ids
from plantroom.operators.selection import Selection, equipment_by_ids, points_by_ids

# Names of the columns that are left out of the result, and of the renamed ones.
DROPPED_COLUMNS = (
    r"p\.building_id|_type_name|_type_abbr|_subtype|flow|\.y|child|parent_equip"
    r"|measurement|raw_unit_id|hash|e\.points|e\.tags"
)
RENAMED_COLUMNS = {
    "e.id": "e.equipment_id",
    "p.id": "p.point_id",
    "p.type": "p.point_type",
    "e.equip_type_tag": "e.equip_type",
    "e.building_id": "building_id",
}
STATE_TEXT = "state_text"


def with_parent_name(equipment: DataFrame) -> DataFrame:
    """Add ``parent``, the name of the equipment ``parent_equip`` points to.

    Done before points are joined, so that the lookup moves equipment rows only.
    """
    names = equipment.select(col("id").alias("__parent_id"), col("equip_id").alias("parent"))
    parent_id = id_column(equipment, "parent_equip")
    return equipment.join(names, parent_id.eqNullSafe(F.col("__parent_id")), "left").drop("__parent_id")


def assemble_metadata(equipment: DataFrame, points: DataFrame, broadcast: bool = True) -> DataFrame:
    """Equipment and points in one row each, cleaned up.

    Every point and every equipment is kept: points without equipment have null
    equipment columns and a null ``building_id`` (their own is dropped), and
    ``e.equipment_id`` of a dangling point is the id it refers to. Nested input
    has to be flattened first.

    No job is started. Equipment that Spark's statistics put below half of the
    broadcast threshold, in bytes, is broadcast with its parents' names, and no
    point is shuffled; Spark would not find out by itself, because it takes the
    parent lookup for a multiplication. Above it, the points are shuffled by
    equipment, with hot equipment split by adaptive execution.
    ``broadcast=False`` leaves the choice to Spark.
    """
    require_columns(equipment, ["id", "equip_id", "building_id", "equip_type_tag", "parent_equip"], "equipment")
    require_columns(
        points,
        ["id", "type", "equip_id", "units", "tagged_units", "first_updated", "last_updated"],
        "points",
    )
    left = prefix_columns(points.withColumn("equip_id", id_column(points, "equip_id")), "p.")
    named = with_parent_name(equipment.withColumn("id", id_column(equipment, "id")))
    short = broadcast and likely_small(equipment, 2)
    right = prefix_columns(named, "e.")
    # The surviving key column carries the points' name; it is the equipment's id.
    return cleaned(full_join(left, right, "p.equip_id", "e.id", broadcast_right=short).withColumnRenamed("p.equip_id", "e.id"))


def cleaned(rows: DataFrame) -> DataFrame:
    """Prefixed rows of points and equipment with the names, times and state texts of the metadata table."""
    rows = rows.withColumn(
        "p.tagged_units", F.coalesce(col("p.tagged_units").cast("string"), col("p.units"))
    ).withColumnsRenamed(RENAMED_COLUMNS)
    rows = decode_epochs(rows, ["p.first_updated", "p.last_updated"])
    # State texts are read in input order, equipment before points.
    value_order = sorted(rows.columns, key=lambda name: not name.startswith("e."))
    return _fold_state_texts(sort_columns(drop_matching(rows, DROPPED_COLUMNS)), value_order)


def _fold_state_texts(df: DataFrame, value_order: Sequence[str]) -> DataFrame:
    """Join all state-text columns into ``p.state_text``, values in ``value_order``."""
    parts = [name for name in value_order if name in df.columns and re.search(STATE_TEXT, name)]
    if not parts:
        return df
    folded = F.concat_ws(", ", *[col(name).cast("string") for name in parts]).alias("p.state_text")
    first = min(df.columns.index(name) for name in parts)
    selected = []
    for position, name in enumerate(df.columns):
        if position == first:
            selected.append(folded)
        if name not in parts:
            selected.append(col(name))
    return df.select(selected)


def metadata_by_building(
    requests: Sequence[int | str] | int | str,
    buildings: DataFrame,
    equipment: DataFrame,
    points: DataFrame,
    check: bool = True,
) -> DataFrame:
    """Metadata of everything in the requested buildings (names or ids)."""
    wanted = building_ids(buildings, requests, check)
    return assemble_metadata(
        filter_by_ids(equipment, "building_id", wanted),
        filter_by_ids(points, "building_id", wanted),
    )


def metadata_by_selection(
    selection: Selection | Mapping,
    equipment: DataFrame,
    points: DataFrame,
    check: bool = True,
) -> DataFrame:
    """Metadata of the selected points and the selected equipment.

    With ``check`` an empty selection raises ``ValueError``. A :class:`Selection`
    is computed once, by one job that writes its ids; if they are few they
    filter the scans.
    """
    if isinstance(selection, Selection):
        kept = selection.kept()
        point_ids, equipment_ids = inline_if_few(kept.points), inline_if_few(kept.equipment)
    elif isinstance(selection, Mapping):
        point_ids, equipment_ids = selection.get("points"), selection.get("equipment")
    else:
        raise ValueError("selection must be a Selection or a mapping with lists of ids per entity")
    if not isinstance(point_ids, DataFrame):
        point_ids = list(point_ids or [])
    if check:
        if point_ids.isEmpty() if isinstance(point_ids, DataFrame) else not point_ids:
            raise ValueError("no metadata found")
    return assemble_metadata(equipment_by_ids(equipment, equipment_ids), points_by_ids(points, point_ids))
