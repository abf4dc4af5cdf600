"""Building-data entities as views over the star-schema test tables.

Each view is one SQL text that Spark and DuckDB both understand, with ``{table}``
for the tables it reads. All of them read whole tables, so their size follows
the data. They are shaped to be awkward: a third of all points hang on one
equipment, keys are null or dangling, names collide with ids, several buildings
share one name.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from plantroom.session import configure

VIEWS: dict[str, str] = {
    "organizations": """
        select cast(c_custkey as int) as id, c_name as name, c_mktsegment as segment
        from {customer}""",
    "buildings": """
        select cast(s_suppkey as int) as id,
               case when s_suppkey % 10 = 7 then 'Annex'
                    when s_suppkey % 10 = 4 then cast(s_suppkey + 1 as varchar(20))
                    else s_name end as name,
               s_nationkey as org_id
        from {supplier}""",
    "users": """
        select cast(c_custkey as int) as id, c_nationkey % 5 as org_id,
               'org_' || cast(c_nationkey % 5 as varchar(20)) as org_name,
               cast(c_custkey % 7 as int) as n_roles,
               lower(c_name) || '@example.org' as email, c_name as username,
               c_mktsegment as first_name, cast(null as varchar(20)) as last_name,
               1600000000000 + c_custkey * 86400000 as last_login,
               1500000000 + c_custkey * 3600 as created,
               case when c_custkey % 5 = 0 then null
                    when c_custkey % 5 = 1 then 'junk'
                    else cast(1400000000000 + c_custkey * 1000 as varchar(20)) end as password_reset,
               c_custkey % 4 <> 0 as active
        from {customer}""",
    "roles": """
        select cast(s_suppkey as int) as id, 'role_' || cast(s_suppkey as varchar(20)) as name
        from {supplier}""",
    "deployments": """
        select o_orderkey as id, cast(o_custkey as int) as org_id,
               case when o_orderkey % 9 = 0 then null else 1600000000000 + o_orderkey * 60000 end as last_heartbeat
        from {orders}""",
    "equipment_types": """
        select cast(p_partkey as int) as id, p_name as tag_name, p_size as sub_types, p_size % 4 as flow_order,
               case when p_partkey % 7 = 0 then null else p_partkey % 3 <> 0 end as active
        from {part}""",
    "measurements": """
        select cast(c_custkey as int) as id, 'measure ' || c_name as name,
               c_custkey % 2 = 0 as units_convertible, 'q:' || c_mktsegment as qudt_type
        from {customer}""",
    "units": """
        select cast((p_partkey - p_partkey % 4) / 4 as int) as measurement_id,
               p_name || ' ' || cast(p_partkey as varchar(20)) as name_long,
               'u' || cast(p_partkey as varchar(20)) as name_abbr,
               case when p_partkey % 2 = 0 then 'Continuous' else 'Enum' end as data_type
        from {part}""",
    "tags": """
        select cast(p_partkey as int) as id, 'tag ' || cast(p_partkey as varchar(20)) as name, p_type as category
        from {part}""",
    "point_types": """
        select cast(o_orderkey as int) as id, o_orderpriority || ' ' || cast(o_orderkey as varchar(20)) as tag_name,
               cast(case when o_orderkey % 9 = 0 then null
                         when o_orderkey % 11 = 0 then 100000000 + o_orderkey
                         when o_orderkey % 3 = 1 then 1
                         else o_custkey end as int) as measurement_id,
               'tag_' || cast(o_custkey as varchar(20)) as first_tag, o_orderstatus as second_tag,
               cast(o_orderkey % 3 as int) as n_tags
        from {orders}""",
    "equipment": """
        select c_custkey as id, c_name as equip_id,
               cast(case when c_custkey % 3 = 0 then 3 else c_custkey % 10 end as int) as building_id,
               lower(c_mktsegment) as equip_type_tag,
               case when c_custkey % 10 = 0 then null
                    when c_custkey % 13 = 0 then 100000000 + c_custkey
                    when c_custkey % 3 = 1 then 1
                    else c_custkey - c_custkey % 10 end as parent_equip,
               c_nationkey as flow_order, c_name as child_equip, c_acctbal as rating
        from {customer}""",
    "points": """
        select o_orderkey as id, 'topic/' || cast(o_orderkey as varchar(20)) as topic,
               'point ' || cast(o_orderkey % 1000 as varchar(20)) as name,
               o_orderpriority as type,
               case when o_orderkey % 11 = 0 then null
                    when o_orderkey % 13 = 0 then 100000000 + o_orderkey
                    when o_orderkey % 3 = 1 then 1
                    else o_custkey - o_custkey % 2 end as equip_id,
               cast(case when o_orderkey % 3 = 0 then 3 else o_orderkey % 10 end as int) as building_id,
               'kind ' || cast(o_orderkey % 7 as varchar(20)) as measurement,
               case when o_orderkey % 4 = 0 then 'degc' else 'pa' end as units,
               case when o_orderkey % 3 = 0 then null else o_orderstatus end as tagged_units,
               1500000000 + o_orderkey as first_updated,
               case when o_orderkey % 17 = 0 then null else 1600000000000 + o_orderkey * 60000 end as last_updated,
               'h' || cast(o_orderkey as varchar(20)) as topic_hash, o_custkey as raw_unit_id,
               case when o_orderkey % 2 = 0 then 'off' else null end as state_off,
               case when o_orderkey % 5 = 0 then 'on' else null end as state_on
        from {orders}""",
    "readings": """
        select user_id as point_id, 'sensor/' || cast(user_id as varchar(20)) as topic, event_type as display,
               ts as time, case when event_id % 17 = 0 then null else value end as raw,
               case when event_id % 17 = 0 then null else value * 1.8 + 32 end as unit, event_id
        from {events}""",
    # Many readings in the same second and a column for each of seven meters. The id tells different readings apart.
    "meter_readings": """
        select l_orderkey as point_id, 'meter/' || cast(l_linenumber as varchar(20)) as topic,
               'meter ' || cast(l_linenumber as varchar(20)) as display, l_shipdate as time,
               l_quantity as raw, l_extendedprice as unit,
               cast((l_orderkey * 8 + l_linenumber) * 64 + l_quantity as bigint) * 16777216
                 + cast(round(l_extendedprice * 100) as bigint) as reading_id
        from {lineitem}""",
    "staging_points": """
        select 'topic/' || cast(o_orderkey as varchar(20)) as topic,
               case when o_orderkey % 10 = 0 then '__SKIP__'
                    when o_orderkey % 11 = 0 then null
                    when o_orderkey % 3 = 1 then 'Customer#000000001'
                    when o_orderkey % 13 = 0 then 'unknown ' || cast(o_custkey as varchar(20))
                    else 'Customer#' || lpad(cast(o_custkey - o_custkey % 2 as varchar(20)), 9, '0') end as equip,
               case when o_orderkey % 14 = 0 then 'second' else null end as second_equip,
               case when o_orderkey % 8 = 0 then null
                    when o_orderkey % 3 = 2 then '1'
                    else cast(o_orderkey % 30 as varchar(20)) end as device_id,
               cast(case when o_orderkey % 35 = 0 then 2
                         when o_orderkey % 5 = 0 then o_orderkey % 10 else 3 end as int) as building_id,
               o_totalprice as price, o_orderstatus as status, 1600000000000 + o_orderkey as modified
        from {orders}""",
    "staging_equipment": """
        select c_name as equip_id,
               cast(case when c_custkey % 35 = 0 then 2
                         when c_custkey % 5 = 0 then c_custkey % 10 else 3 end as int) as building_id,
               c_acctbal as balance, c_mktsegment as check_field
        from {customer}""",
    # Building 2 has points and equipment but no device.
    "staging_devices": """
        select cast(s_suppkey as varchar(20)) as device_id, s_name as device_name,
               cast(case when s_suppkey % 5 = 0 then s_suppkey % 10 else 3 end as int) as building_id,
               s_nationkey as vendorid
        from {supplier}""",
    "promotion_report": """
        select case o_orderkey % 4 when 0 then 'points' when 1 then 'equipment'
                    when 2 then 'unexpected_deletes' else 'building_id' end as type,
               'topic/' || cast(o_orderkey as varchar(20)) as topic,
               case o_orderkey % 5 when 0 then 'Skipped equipment not validated'
                    when 1 then 'Skipped points are not validated'
                    when 2 then 'No valid equipment for topic'
                    else 'bad value ' || cast(o_totalprice as varchar(40)) end as error
        from {orders}""",
    # What a user edits and uploads: changed rows, new topics, rows without topic or any key, copies, contradictions.
    "upload_rows": """
        select case when l_orderkey % 23 = 0 then null
                    when l_orderkey % 4 = 0 then 'new/' || cast(l_orderkey as varchar(20))
                    else 'topic/' || cast(l_orderkey as varchar(20)) end as topic,
               case when l_orderkey % 46 = 0 then null
                    when l_orderkey % 6 = 0 then '__SKIP__'
                    when l_orderkey % 69 = 0 then 'fresh ' || cast(l_orderkey % 10000 as varchar(20))
                    else 'Customer#' || lpad(cast(l_orderkey % 100 as varchar(20)), 9, '0') end as equip,
               case when l_orderkey % 5 = 0 then l_linestatus else 'edited' end as status
        from {lineitem}""",
}


def tables_of(view: str) -> list[str]:
    return sorted({field for _, field, _, _ in string.Formatter().parse(VIEWS[view]) if field})


class Fixtures:
    """The views over the Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def view(self, name: str) -> DataFrame:
        tables = {table: self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet") for table in tables_of(name)}
        return self.spark.sql(VIEWS[name], **tables)


def oracle_view(name: str) -> str:
    """A view's SQL over tables registered under their own names."""
    return VIEWS[name].format(**{table: table for table in tables_of(name)})


def with_views(names: list[str], body: str) -> str:
    """``body`` with the named views as common table expressions ``v_<name>``."""
    ctes = ",\n".join(f"v_{name} as ({oracle_view(name)})" for name in names)
    return f"with {ctes}\n{body}"
