"""Organizations, buildings, users, deployments and the data model listings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import (
    argument_table,
    filter_by_ids,
    inline_if_few,
    list_to_text,
    require_columns,
    valid_ids,
    whole_number,
)
from plantroom.functions.timeconv import decode_epochs

Ids = Iterable | DataFrame | int | str | None

#: Fixed output columns of the users listing.
USER_COLUMNS = (
    "id", "org_id", "org_name", "role", "email", "username",
    "first_name", "last_name", "last_login", "created", "password_reset", "active",
)


def organizations(orgs: DataFrame, ids: Ids = None, if_no_valid_id: str = "empty") -> DataFrame:
    return filter_by_ids(orgs, "id", ids, if_no_valid_id)


def buildings(table: DataFrame, ids: Ids = None, if_no_valid_id: str = "empty") -> DataFrame:
    return filter_by_ids(table, "id", ids, if_no_valid_id)


def deployments(table: DataFrame, org_ids: Ids = None, if_no_valid_id: str = "empty") -> DataFrame:
    """Deployments with ``last_heartbeat`` decoded, optionally of some organizations."""
    return decode_epochs(filter_by_ids(table, "org_id", org_ids, if_no_valid_id), ["last_heartbeat"])


def _keys(table: DataFrame) -> DataFrame:
    """Each building under its name and under its id: (key, how, id, name)."""
    keys = F.array(
        F.struct(F.col("name").alias("key"), F.lit("name").alias("how")),
        F.struct(F.col("id").cast("string").alias("key"), F.lit("id").alias("how")),
    )
    return table.select(F.inline(keys), "id", "name")


def _mentioned(table: DataFrame, names: Iterable[str], ids: Iterable) -> DataFrame:
    return table.where(F.col("name").isin(list(names)) | F.col("id").isin(valid_ids(ids)))


def resolve_requests(table: DataFrame, requests: Sequence[int | str] | int | str, check: bool = True) -> dict[str, str]:
    """Whether each requested building is meant by ``name`` or by ``id``.

    A request is a name, or an id where no building has that name. One small job
    looks all of them up; its result has at most one row per request. Requests
    that mean nothing raise ``ValueError``, or are left out without ``check``.
    """
    requests = [requests] if isinstance(requests, (int, str)) else list(requests)
    if not requests:
        raise ValueError("no building requested")
    texts = list(dict.fromkeys(str(request) for request in requests))
    hits = _keys(_mentioned(table, texts, texts)).where(F.col("key").isin(texts))
    # "name" sorts after "id", so it wins.
    found = {row.key: row.how for row in hits.groupBy("key").agg(F.max("how").alias("how")).collect()}
    unknown = [text for text in texts if text not in found]
    if unknown and check:
        raise ValueError(f"no building found for name/id: {', '.join(unknown)}")
    return found


def building_info(table: DataFrame, requests: Sequence[int | str] | int | str, check: bool = True) -> DataFrame:
    """(id, name) of the requested buildings, in request order.

    A repeated request repeats its rows and a shared name yields every building
    that has it. See :func:`resolve_requests` for what a request means.
    """
    how = resolve_requests(table, requests, check)
    listed = [str(r) for r in ([requests] if isinstance(requests, (int, str)) else requests) if str(r) in how]
    wanted = argument_table(
        table.sparkSession,
        {
            "request_no": (pa.int32(), range(len(listed))),
            "key": (pa.string(), listed),
            "how": (pa.string(), [how[text] for text in listed]),
        },
    )
    found = _keys(_mentioned(table, how, how)).join(wanted, ["key", "how"])
    return found.orderBy("request_no", "id").select("id", "name")


def building_ids(table: DataFrame, requests: Sequence[int | str] | int | str, check: bool = True) -> list[int] | DataFrame:
    """The distinct ids behind :func:`building_info`: a list, or a table if there are very many."""
    how = resolve_requests(table, requests, check)
    names = [text for text, kind in how.items() if kind == "name"]
    ids = [text for text, kind in how.items() if kind == "id"]
    return inline_if_few(_mentioned(table, names, ids).select("id"))


def one_building(table: DataFrame, request: Sequence[int | str] | int | str, check: bool = True) -> list[int]:
    """The id of the one building that is asked for, by name or id; none without ``check`` if it is unknown.

    A name that several buildings share is refused: their rows must not be mixed.
    """
    if not isinstance(request, (int, str)):
        if len(request) != 1:
            raise ValueError("exactly one building is allowed")
        request = request[0]
    ids = building_ids(table, request, check)
    if isinstance(ids, DataFrame) or len(ids) > 1:
        raise ValueError(f"several buildings are called {request}; give an id")
    return ids


def users(
    table: DataFrame,
    roles: DataFrame,
    ids: Ids = None,
    max_roles: int | None = None,
    if_no_valid_id: str = "empty",
) -> DataFrame:
    """One row per user and role, role ids replaced by names, epochs decoded.

    Users without roles and roles without a name keep a row with a null role.
    ``max_roles`` keeps only that many leading roles of each user.
    """
    chosen = filter_by_ids(table, "id", ids, if_no_valid_id)
    role_list = F.slice("roles", 1, max_roles) if max_roles is not None else F.col("roles")
    per_role = chosen.select(
        *[name for name in USER_COLUMNS if name != "role"],
        F.explode_outer(F.transform(role_list, whole_number)).alias("__role_id"),
    )
    names = roles.select(F.col("id").alias("__id"), F.col("name").alias("role"))
    named = per_role.join(names, F.col("__role_id").eqNullSafe(F.col("__id")), "left")
    return decode_epochs(named.select(*USER_COLUMNS), ["password_reset", "last_login", "created"])


def equipment_types(table: DataFrame) -> DataFrame:
    """Active equipment types; an unknown activity counts as inactive."""
    return table.where("active").drop("sub_types", "flow_order", "active")


def measurement_units(measurements: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """One row per measurement and unit; a measurement without units keeps one row.

    Units come from the ``units`` array of the measurements, or from a separate
    table with a ``measurement_id``.
    """
    details = ("name_long", "name_abbr", "data_type")
    kept = [F.col("id"), F.col("name").alias("measurement_name"), "units_convertible", "qudt_type"]
    if units is None:
        rows = measurements.select(*kept, F.explode_outer("units").alias("__unit"))
        detail = {name: F.col("__unit").getField(name) for name in details}
    else:
        listed = units.select(F.col("measurement_id").cast("bigint").alias("__measurement_id"), *details)
        rows = measurements.select(*kept).join(listed, F.col("id").eqNullSafe(F.col("__measurement_id")), "left")
        detail = {name: F.col(name) for name in details}
    return rows.select(
        "id",
        "measurement_name",
        "units_convertible",
        "qudt_type",
        detail["name_long"].alias("unit_name"),
        detail["name_abbr"].alias("unit"),
        detail["data_type"].alias("data_type"),
    )


def point_types(
    table: DataFrame,
    measurements: DataFrame,
    units: DataFrame | None = None,
    tags_as_text: bool = True,
) -> DataFrame:
    """Point types with the name and every unit of their measurement.

    One row per point type and unit; nulls where the measurement is unknown or
    has no unit. ``tags`` is text joined by ``", "`` unless ``tags_as_text`` is
    false.
    """
    require_columns(table, ["id", "tag_name", "measurement_id", "tags"], "point types")
    tags = F.col("tags")
    tags_type = table.schema["tags"].dataType
    if tags_as_text and isinstance(tags_type, T.ArrayType):
        tags = list_to_text(tags, tags_type)
    rows = table.select("id", F.col("tag_name").alias("point_type"), "measurement_id", tags.alias("tags"))
    if units is None:
        known = measurement_units(measurements).select(
            F.col("id").alias("__measurement"), "measurement_name", "unit", "data_type"
        )
    else:
        # Units are joined last: each side stays a plain table whose size Spark knows.
        known = measurements.select(F.col("id").alias("__measurement"), F.col("name").alias("measurement_name"))
    rows = rows.join(known, F.col("measurement_id").eqNullSafe(F.col("__measurement")), "left")
    if units is not None:
        listed = units.select(
            F.col("measurement_id").alias("__unit_of"), F.col("name_abbr").alias("unit"), "data_type"
        )
        rows = rows.join(listed, F.col("__measurement") == F.col("__unit_of"), "left")
    return rows.select("id", "point_type", "measurement_name", "unit", "data_type", "tags")


def listing(table: DataFrame) -> DataFrame:
    """Tags, units or measurements exactly as they are stored."""
    return table
