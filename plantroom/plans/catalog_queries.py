"""Catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.functions.columns import columns_to_text
from plantroom.operators import catalog
from plantroom.plans.fixtures import Fixtures, with_views
from plantroom.plans.registry import plain, query
from plantroom.sources.documents import flatten_json as read_variants
from plantroom.sources.documents import parse_json, rows_to_json, unwrap

EPOCH = "make_timestamp(cast(substr(cast({0} as varchar), 1, 10) as bigint) * 1000000)"
EPOCH_TEXT = "make_timestamp(try_cast(substr({0}, 1, 10) as bigint) * 1000000)"

REQUESTS = ("Supplier#000000003", 5, "Annex", 8, "Supplier#000000003", 3)


@query(
    with_views(
        ["organizations", "buildings"],
        "select id, name, segment from v_organizations where id in (select org_id from v_buildings)",
    )
)
def orgs_by_id(fx: Fixtures) -> DataFrame:
    return catalog.organizations(fx.view("organizations"), fx.view("buildings").select("org_id"))


@query(
    with_views(
        ["buildings", "points"],
        "select id, name, org_id from v_buildings where id in (select building_id from v_points)",
    )
)
def buildings_by_id(fx: Fixtures) -> DataFrame:
    return catalog.buildings(fx.view("buildings"), fx.view("points").select("building_id"))


@query(
    with_views(
        ["buildings"],
        """, requests(no, request) as (
             values (0, 'Supplier#000000003'), (1, '5'), (2, 'Annex'), (3, '8'), (4, 'Supplier#000000003'), (5, '3')),
           named as (select r.no, b.id, b.name from requests r join v_buildings b on b.name = r.request)
           select id, name from named
           union all
           select b.id, b.name from requests r join v_buildings b on cast(b.id as varchar) = r.request
           where r.no not in (select no from named)""",
    )
)
def building_info(fx: Fixtures) -> DataFrame:
    return catalog.building_info(fx.view("buildings"), REQUESTS)


def users_with_roles(fx: Fixtures) -> DataFrame:
    """Users holding 0 to 6 roles, the sixth of which nobody has heard of."""
    role = F.transform(
        F.sequence(F.lit(0), F.col("n_roles")),
        lambda no: F.when(no == 6, F.lit(900000000)).otherwise(no),
    )
    return fx.view("users").withColumn("roles", F.filter(role, lambda r: r > 0))


USERS_SQL = """
  select u.id, u.org_id, u.org_name, r.name as role, u.email, u.username, u.first_name, u.last_name,
         {last_login} as last_login, {created} as created, {reset} as password_reset, u.active
  from (select *, unnest(case when n_roles = 0 then [null] else range(1, least(n_roles, {limit}) + 1) end) as role_no
        from v_users) u
  left join v_roles r on r.id = case when u.role_no = 6 then 900000000 else u.role_no end"""


def _users_sql(limit: int) -> str:
    return with_views(
        ["users", "roles"],
        USERS_SQL.format(
            limit=limit,
            last_login=EPOCH.format("u.last_login"),
            created=EPOCH.format("u.created"),
            reset=EPOCH_TEXT.format("u.password_reset"),
        ),
    )


@query(_users_sql(99))
def users_roles(fx: Fixtures) -> DataFrame:
    return plain(catalog.users(users_with_roles(fx), fx.view("roles")))


@query(_users_sql(4))
def users_four_roles(fx: Fixtures) -> DataFrame:
    return plain(catalog.users(users_with_roles(fx), fx.view("roles"), max_roles=4))


@query(
    with_views(
        ["deployments"],
        f"select id, org_id, {EPOCH.format('last_heartbeat')} as last_heartbeat from v_deployments",
    )
)
def deployments_heartbeat(fx: Fixtures) -> DataFrame:
    return plain(catalog.deployments(fx.view("deployments")))


@query(
    with_views(
        ["deployments", "organizations"],
        f"""select id, org_id, {EPOCH.format('last_heartbeat')} as last_heartbeat from v_deployments
            where org_id in (select id from v_organizations where segment = 'BUILDING')""",
    )
)
def deployments_by_org(fx: Fixtures) -> DataFrame:
    owners = fx.view("organizations").where("segment = 'BUILDING'").select("id")
    return plain(catalog.deployments(fx.view("deployments"), owners))


@query(with_views(["equipment_types"], "select id, tag_name from v_equipment_types where active"))
def equip_types_active(fx: Fixtures) -> DataFrame:
    return catalog.equipment_types(fx.view("equipment_types"))


TAGGED_TYPES = """
  select t.id, t.tag_name as point_type, m.name as measurement_name, {unit} as unit, {data_type} as data_type,
         case n_tags when 0 then '' when 1 then first_tag else first_tag || ', ' || second_tag end as tags
  from v_point_types t left join v_measurements m on m.id = t.measurement_id {units}"""


def tagged_point_types(fx: Fixtures) -> DataFrame:
    tags = F.slice(F.array("first_tag", "second_tag"), F.lit(1), F.col("n_tags"))
    return fx.view("point_types").withColumn("tags", tags)


@query(
    with_views(
        ["point_types", "measurements", "units"],
        TAGGED_TYPES.format(
            unit="u.name_abbr", data_type="u.data_type", units="left join v_units u on u.measurement_id = m.id"
        ),
    )
)
def point_types_units(fx: Fixtures) -> DataFrame:
    return catalog.point_types(tagged_point_types(fx), fx.view("measurements"), fx.view("units"))


@query(
    with_views(
        ["point_types", "measurements"],
        TAGGED_TYPES.format(
            unit="'u' || cast(k as varchar)",
            data_type="'Continuous'",
            units="left join (select id as mid, unnest(range(1, id % 4 + 1)) as k from v_measurements) u on u.mid = m.id",
        ).replace("'Continuous' as data_type", "case when k is not null then 'Continuous' end as data_type"),
    )
)
def point_types_nested_units(fx: Fixtures) -> DataFrame:
    """Units as an array inside each measurement, none for every fourth."""
    units = F.transform(
        F.when(F.col("id") % 4 > 0, F.sequence(F.lit(1), F.col("id") % 4)).otherwise(F.array().cast("array<int>")),
        lambda k: F.struct(
            F.concat(F.lit("unit "), k).alias("name_long"),
            F.concat(F.lit("u"), k).alias("name_abbr"),
            F.lit("Continuous").alias("data_type"),
        ),
    )
    return catalog.point_types(tagged_point_types(fx), fx.view("measurements").withColumn("units", units))


@query(
    with_views(
        ["measurements", "units"],
        """select m.id, m.name as measurement_name, m.units_convertible, m.qudt_type, u.name_long as unit_name,
                  u.name_abbr as unit, u.data_type
           from v_measurements m left join v_units u on u.measurement_id = m.id""",
    )
)
def measurement_units(fx: Fixtures) -> DataFrame:
    return catalog.measurement_units(fx.view("measurements"), fx.view("units"))


@query(with_views(["measurements"], "select id, name, units_convertible, qudt_type from v_measurements"))
def measurements_all(fx: Fixtures) -> DataFrame:
    return catalog.listing(fx.view("measurements"))


@query(with_views(["units"], "select measurement_id, name_long, name_abbr, data_type from v_units"))
def units_all(fx: Fixtures) -> DataFrame:
    return catalog.listing(fx.view("units"))


@query(with_views(["tags"], "select id, name, category from v_tags"))
def tags_all(fx: Fixtures) -> DataFrame:
    return catalog.listing(fx.view("tags"))


@query(
    with_views(
        ["equipment"],
        """select id, equip_id as info_name, rating as info_detail_rating, parent_equip as info_detail_parent
           from v_equipment""",
    )
)
def flatten_json(fx: Fixtures) -> DataFrame:
    """Equipment packed into nested JSON texts, parsed and flattened."""
    nested = fx.view("equipment").select(
        "id",
        F.struct(
            F.col("equip_id").alias("name"),
            F.struct(F.col("rating").alias("rating"), F.col("parent_equip").alias("parent")).alias("detail"),
        ).alias("info"),
    )
    schema = "id bigint, info struct<name: string, detail: struct<rating: double, parent: bigint>>"
    return plain(parse_json(rows_to_json(nested), "payload", schema))


@query(
    with_views(
        ["equipment"],
        """select case when id % 3 = 2 then 'E' || cast(id as varchar) else cast(id as varchar) end as id,
                  case when id % 3 <> 2 then equip_id end as info_name,
                  case when id % 3 = 0 then cast(id * 0.5 as double) end as info_detail_half,
                  case when id % 3 = 1 then parent_equip end as info_detail_parent,
                  case when id % 3 = 2 then 'x' || cast(flow_order as varchar) end as info_tags_first,
                  case when id % 3 = 1 then flow_order % 2 = 0 end as even
           from v_equipment""",
    )
)
def flatten_json_variant(fx: Fixtures) -> DataFrame:
    """JSON objects whose fields differ from row to row, in a type, too, parsed without a schema."""
    text = F.expr(
        """case id % 3
             when 0 then to_json(named_struct('id', id, 'info', named_struct('name', equip_id, 'detail', named_struct('half', cast(id * 0.5 as double)))))
             when 1 then to_json(named_struct('id', id, 'info', named_struct('name', equip_id, 'detail', named_struct('parent', parent_equip)),
                                              'even', flow_order % 2 = 0))
             else to_json(named_struct('id', 'E' || cast(id as string), 'info', named_struct('tags', array('x' || cast(flow_order as string), 'y'))))
           end"""
    )
    found = read_variants(fx.view("equipment").select(text.alias("payload")), "payload")
    first = F.element_at("`info.tags`", 1).alias("info.tags.first")
    return plain(found.select("id", "`info.name`", "`info.detail.half`", "`info.detail.parent`", first, "even"))


@query(
    with_views(
        ["organizations"],
        "select id, name from v_organizations union all select id + 1000000000 as id, segment as name from v_organizations",
    )
)
def unwrap_json(fx: Fixtures) -> DataFrame:
    """Wrapped JSON record lists, two records per text, unpacked to rows."""
    wrapped = fx.view("organizations").select(
        F.array(
            F.struct("id", "name"), F.struct((F.col("id") + 1000000000).alias("id"), F.col("segment").alias("name"))
        ).alias("data")
    )
    parsed = parse_json(rows_to_json(wrapped), "payload", "data array<struct<id: int, name: string>>", flat=False)
    return unwrap(parsed, "data")


@query(
    with_views(
        ["users"],
        """select cast(id as varchar) as id, username,
                  coalesce(array_to_string(list_transform(range(1, n_roles + 1),
                      lambda x: case when x = 6 then 900000000 else x end), ', '), '') as roles
           from v_users""",
    )
)
def list_columns_text(fx: Fixtures) -> DataFrame:
    return columns_to_text(users_with_roles(fx).select("id", "username", "roles"))
