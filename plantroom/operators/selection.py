"""Point selection by criteria, and fetching points or equipment by id."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields
from datetime import datetime
from functools import reduce
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import (
    INLINE_ID_LIMIT,
    argument_table,
    col,
    filter_by_ids,
    id_column,
    inline_if_few,
    valid_ids,
)
from plantroom.functions.timeconv import EPOCH_DIGITS, epoch_seconds, epoch_to_utc, utc_literal
from plantroom.sources.shared import stored

Values = Iterable[int | str] | int | str | None


@dataclass
class PointSelector:
    """Criteria for points; ``None``, ``''`` and empty lists mean unset.

    Values of one field are alternatives, different fields must all hold.
    ``orgs`` are ids. ``buildings`` and ``equipment`` are ids or names.
    ``updated_since`` is a UTC datetime, ISO text or epoch seconds.
    """

    orgs: Values = None
    buildings: Values = None
    point_ids: Values = None
    point_names: Values = None
    point_topics: Values = None
    updated_since: datetime | str | float | None = None
    point_types: Values = None
    equipment: Values = None
    equipment_types: Values = None
    point_hashes: Values = None

    def values(self, field: str) -> list[int | str]:
        value = getattr(self, field)
        items = [value] if isinstance(value, (int, str)) else list(value or ())
        return [item for item in items if item not in ("", None)]

    def any_of(self, *names: str) -> bool:
        return any(self.values(name) for name in names)

    @property
    def since(self) -> datetime | str | float | None:
        return None if self.updated_since in (None, "") else self.updated_since


@dataclass(frozen=True)
class Selection:
    """Distinct ids per entity, each a one-column DataFrame named ``id``."""

    points: DataFrame
    equipment: DataFrame
    buildings: DataFrame
    orgs: DataFrame

    def kept(self) -> "Selection":
        """The same selection computed once, for use in several queries.

        All ids are written in one job to the shared folder (setting
        ``spark.checkpoint.dir``), so they outlive any executor.
        """
        names = [f.name for f in fields(self)]
        parts = [
            getattr(self, name).select(F.lit(name).alias("entity"), col("id").cast("bigint").alias("id"))
            for name in names
        ]
        table = stored(reduce(DataFrame.unionByName, parts), "selection", partition_by="entity")
        return Selection(*[table.where(F.col("entity") == name).select("id") for name in names])


#: A criterion: a condition on the scan, or a column and a table of its values for a semi-join.
Rule = Column | tuple[str, DataFrame]


def _among(df: DataFrame, column: str, values: list) -> Rule:
    """Listed values: an ``IN`` predicate, or a semi-join where they are many."""
    if len(values) <= INLINE_ID_LIMIT:
        return col(column).isin(values)
    kind = pa.int64() if all(isinstance(value, int) for value in values) else pa.string()
    return column, argument_table(df.sparkSession, {"__value": (kind, dict.fromkeys(values))})


def _id_or_name(df: DataFrame, id_name: str, name_column: str, values: list) -> Rule:
    ids, names = valid_ids(values), list(dict.fromkeys(str(v) for v in values))
    if len(names) <= INLINE_ID_LIMIT:
        return col(id_name).isin(ids) | col(name_column).isin(names)
    by_id = _all([_among(df, id_name, ids)], df).select(col(id_name).alias("__value"))
    by_name = _all([_among(df, name_column, names)], df).select(col(id_name).alias("__value"))
    return id_name, by_id.union(by_name).distinct()


def _all(rules: list[Rule], df: DataFrame) -> DataFrame:
    for rule in rules:
        if isinstance(rule, tuple):
            df = df.join(rule[1], col(rule[0]) == F.col("__value"), "left_semi")
        else:
            df = df.where(rule)
    return df


def _updated(points: DataFrame, since: datetime | str | float) -> Column:
    """``last_updated`` at or after a moment, with whole-number epochs compared on the scan.

    A value's first ten digits are seconds. Where the moment has ten digits, those
    of a value of k digits reach it exactly if the value is in a range of its own.
    """
    dtype = points.schema["last_updated"].dataType
    exact = epoch_to_utc(col("last_updated"), dtype) >= utc_literal(since, T.TimestampType())
    first = ceil(epoch_seconds(since))
    if not isinstance(dtype, T.LongType) or not 10 ** (EPOCH_DIGITS - 1) <= first < 10**EPOCH_DIGITS:
        return exact
    limits = [(first * 10**k, 10 ** (EPOCH_DIGITS + k) - 1) for k in range(20 - EPOCH_DIGITS)]
    ranges = [col("last_updated").between(low, min(high, 2**63 - 1)) for low, high in limits if low < 2**63]
    return reduce(lambda a, b: a | b, ranges) & exact


def _belonging(df: DataFrame, key: str, parents: DataFrame) -> DataFrame:
    """Rows whose ``key`` is an id of ``parents``."""
    wanted = parents.select(col("id").alias("__parent"))
    return df.join(wanted, id_column(df, key) == F.col("__parent"), "left_semi")


def _ids(df: DataFrame, column: str = "id") -> DataFrame:
    return df.select(id_column(df, column).alias("id")).where("id is not null").distinct()


def select_points(
    query: PointSelector | Mapping,
    points: DataFrame,
    equipment: DataFrame,
    buildings: DataFrame,
) -> Selection:
    """Ids of everything that fits the criteria.

    A point fits when its own fields do and, where such criteria are set, its
    equipment and its building do. Equipment fits likewise and, once any
    criterion on points is set, must hold a fitting point. Buildings and
    organizations are those the criteria allow.

    The criteria are lists the caller typed: short ones are ``IN`` predicates on
    the scans, longer ones semi-joins. Where buildings are restricted, one small
    job looks up their ids; if they are few, they filter the scans, too, which
    prunes tables partitioned by building. Tables are combined by semi-joins
    only: no row is multiplied and no strategy is forced.
    """
    if isinstance(query, Mapping):
        unknown = set(query) - {f.name for f in fields(PointSelector)}
        if unknown:
            raise ValueError(f"unknown selection field(s): {', '.join(sorted(unknown))}")
        query = PointSelector(**query)

    site_rules = []
    if query.any_of("orgs"):
        site_rules.append(_among(buildings, "org_id", valid_ids(query.values("orgs"))))
    if query.any_of("buildings"):
        site_rules.append(_id_or_name(buildings, "id", "name", query.values("buildings")))
    sites = _all(site_rules, buildings)

    gear_rules = []
    if query.any_of("equipment"):
        gear_rules.append(_id_or_name(equipment, "id", "equip_id", query.values("equipment")))
    if query.any_of("equipment_types"):
        gear_rules.append(_among(equipment, "equip_type_tag", query.values("equipment_types")))
    gear = _all(gear_rules, equipment)

    point_rules = []
    if query.any_of("point_ids"):
        point_rules.append(_among(points, "id", valid_ids(query.values("point_ids"))))
    for field, column in (
        ("point_names", "name"),
        ("point_topics", "topic"),
        ("point_types", "type"),
        ("point_hashes", "topic_hash"),
    ):
        if query.any_of(field):
            point_rules.append(_among(points, column, query.values(field)))
    if query.since is not None:
        point_rules.append(_updated(points, query.since))
    chosen = _all(point_rules, points)

    if site_rules:
        site_ids = inline_if_few(sites.select("id"))
        gear = filter_by_ids(gear, "building_id", site_ids)
        chosen = filter_by_ids(chosen, "building_id", site_ids)
    if gear_rules:
        chosen = _belonging(chosen, "equip_id", gear)
    if point_rules:
        holding = chosen.select(id_column(chosen, "equip_id").alias("id")).distinct()
        gear = gear.join(holding, "id", "left_semi")

    return Selection(
        points=_ids(chosen),
        equipment=_ids(gear),
        buildings=_ids(sites),
        orgs=_ids(sites, "org_id"),
    )


def points_by_ids(points: DataFrame, ids: Iterable | DataFrame | int) -> DataFrame:
    """Points with these ids, each once however often an id is asked for."""
    return filter_by_ids(points, "id", [] if ids is None else ids)


def equipment_by_ids(equipment: DataFrame, ids: Iterable | DataFrame | int) -> DataFrame:
    """Equipment with these ids, each once however often an id is asked for."""
    return filter_by_ids(equipment, "id", [] if ids is None else ids)
