"""Selection and metadata queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.operators import bucketed, metadata, selection
from plantroom.plans.catalog_queries import EPOCH
from plantroom.plans.fixtures import Fixtures, with_views
from plantroom.plans.registry import plain, query
from plantroom.sources.shared import shared_folder

MOMENT = "2020-09-14 00:00:00"

SITES = "select id from v_buildings where (id in (3, 5, 8) or name in ('3', '5', '8', 'Annex'))"

# Asked for one by one, a name goes before an id: "5" is the name of building 4.
REQUESTED = """
  select id from v_buildings
  where name in ('3', 'Annex', '5', '8')
     or (cast(id as varchar) in ('3', 'Annex', '5', '8') and cast(id as varchar) not in (select name from v_buildings))"""


def _both(chosen: selection.Selection) -> DataFrame:
    points = chosen.points.select(F.lit("point").alias("entity"), "id")
    return points.unionByName(chosen.equipment.select(F.lit("equipment").alias("entity"), "id"))


CRITERIA = selection.PointSelector(
    buildings=[3, "Annex", 5, 8],
    equipment_types=["building", "machinery"],
    point_types=["1-URGENT", "2-HIGH", "5-LOW"],
    updated_since=MOMENT,
)

SELECTED = f"""
  , sites as ({SITES}),
  gear as (select id from v_equipment
           where equip_type_tag in ('building', 'machinery') and building_id in (select id from sites)),
  chosen as (select id, equip_id from v_points
             where type in ('1-URGENT', '2-HIGH', '5-LOW') and building_id in (select id from sites)
               and {EPOCH.format('last_updated')} >= timestamp '{MOMENT}'
               and equip_id in (select id from gear)),
  selected_gear as (select id from gear where id in (select equip_id from chosen))"""


@query(
    with_views(
        ["buildings", "equipment", "points"],
        SELECTED
        + """
        select 'point' as entity, id from chosen union all select 'equipment' as entity, id from selected_gear""",
    )
)
def select_points(fx: Fixtures) -> DataFrame:
    return _both(selection.select_points(CRITERIA, fx.view("points"), fx.view("equipment"), fx.view("buildings")))


@query(
    with_views(
        ["buildings", "equipment", "points"],
        """
        , sites as (select id, org_id from v_buildings where org_id in (1, 3, 5, 7, 9, 11, 13, 15, 17, 19, 21, 23)),
        gear as (select id from v_equipment where building_id in (select id from sites)),
        chosen as (select id from v_points where building_id in (select id from sites))
        select 'point' as entity, id from chosen
        union all select 'equipment', id from gear
        union all select 'building', id from sites
        union all select 'org', id from (select distinct org_id as id from sites)""",
    )
)
def select_by_orgs(fx: Fixtures) -> DataFrame:
    """No criterion on points, so equipment without points is selected, too."""
    found = selection.select_points(
        {"orgs": list(range(1, 25, 2)), "point_ids": "", "updated_since": ""},
        fx.view("points"), fx.view("equipment"), fx.view("buildings"),
    )
    parts = {"point": found.points, "equipment": found.equipment, "building": found.buildings, "org": found.orgs}
    rows = [ids.select(F.lit(entity).alias("entity"), F.col("id").cast("bigint")) for entity, ids in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


LISTED_TOPICS = [f"topic/{no}" for no in range(0, 8000, 5)]


@query(
    with_views(
        ["equipment", "points"],
        f""", chosen as (select id, equip_id from v_points
                         where topic in (select 'topic/' || cast(r.range as varchar) from range(0, 8000, 5) r)
                           and {EPOCH.format('last_updated')} >= timestamp '{MOMENT}')
            select 'point' as entity, id from chosen
            union all
            select 'equipment', id from v_equipment where id in (select equip_id from chosen)""",
    )
)
def select_by_many_topics(fx: Fixtures) -> DataFrame:
    """1,600 listed topics: a semi-join in place of a predicate."""
    criteria = selection.PointSelector(point_topics=LISTED_TOPICS, updated_since=MOMENT)
    return _both(selection.select_points(criteria, fx.view("points"), fx.view("equipment"), fx.view("buildings")))


@query(
    with_views(
        ["points"],
        "select id, topic from v_points where id in (select r.range from range(0, 9000, 4) r)",
    )
)
def points_by_many_ids(fx: Fixtures) -> DataFrame:
    """2,250 listed ids."""
    return selection.points_by_ids(fx.view("points"), range(0, 9000, 4)).select("id", "topic")


@query(
    with_views(
        ["points", "readings"],
        "select id, topic, type, equip_id from v_points where id in (select point_id from v_readings)",
    )
)
def points_by_ids(fx: Fixtures) -> DataFrame:
    found = selection.points_by_ids(fx.view("points"), fx.view("readings").select("point_id"))
    return found.select("id", "topic", "type", "equip_id")


@query(
    with_views(
        ["equipment", "points"],
        "select id, equip_id, equip_type_tag from v_equipment where id in (select equip_id from v_points)",
    )
)
def equipment_by_ids(fx: Fixtures) -> DataFrame:
    found = selection.equipment_by_ids(fx.view("equipment"), fx.view("points").select("equip_id"))
    return found.select("id", "equip_id", "equip_type_tag")


def raw_equipment(fx: Fixtures) -> DataFrame:
    """Equipment with the list columns metadata leaves out."""
    lists = {"points": F.array("id"), "tags": F.array("equip_type_tag")}
    return fx.view("equipment").withColumns(lists)


def raw_points(fx: Fixtures) -> DataFrame:
    """Points with state texts under their flattened names."""
    return fx.view("points").withColumnsRenamed({"state_off": "state_text.0", "state_on": "state_text.1"})


def _metadata_sql(equipment: str, points: str, parents: str | None = None) -> str:
    """Rows of points and equipment (two subqueries) as one table, parents among that equipment or ``parents``."""
    return f"""
  , e as (select c.*, parent.equip_id as parent
          from ({equipment}) c left join ({parents or equipment}) parent on parent.id = c.parent_equip),
  p as ({points})
  select e.building_id as building_id, e.equip_id as e_equip_id, e.equip_type_tag as e_equip_type,
         coalesce(e.id, p.equip_id) as e_equipment_id, e.parent as e_parent, e.rating as e_rating,
         {EPOCH.format('p.first_updated')} as p_first_updated, {EPOCH.format('p.last_updated')} as p_last_updated,
         p.name as p_name, p.id as p_point_id, p.type as p_point_type,
         concat_ws(', ', p.state_off, p.state_on) as p_state_text,
         coalesce(p.tagged_units, p.units) as p_tagged_units, p.topic as p_topic, p.units as p_units
  from e full join p on e.id is not distinct from p.equip_id"""


@query(
    with_views(["equipment", "points"], _metadata_sql("select * from v_equipment", "select * from v_points"))
)
def metadata_assembly(fx: Fixtures) -> DataFrame:
    return plain(metadata.assemble_metadata(raw_equipment(fx), raw_points(fx)))


@query(
    with_views(
        ["buildings", "equipment", "points"],
        f", sites as ({REQUESTED})"
        + _metadata_sql(
            "select * from v_equipment where building_id in (select id from sites)",
            "select * from v_points where building_id in (select id from sites)",
        ),
    )
)
def metadata_by_building(fx: Fixtures) -> DataFrame:
    found = metadata.metadata_by_building([3, "Annex", 5, 8], fx.view("buildings"), raw_equipment(fx), raw_points(fx))
    return plain(found)


@query(
    with_views(
        ["buildings", "equipment", "points"],
        SELECTED
        + _metadata_sql(
            "select * from v_equipment where id in (select id from selected_gear)",
            "select * from v_points where id in (select id from chosen)",
        ),
    )
)
def metadata_by_selection(fx: Fixtures) -> DataFrame:
    chosen = selection.select_points(CRITERIA, fx.view("points"), fx.view("equipment"), fx.view("buildings"))
    return plain(metadata.metadata_by_selection(chosen, raw_equipment(fx), raw_points(fx)))


def _bucketed(fx: Fixtures) -> bucketed.BucketedTables:
    """Sixteen buckets: a third of the points is more than five of them hold."""
    root = f"{shared_folder(fx.spark)}/bucketed-{uuid.uuid4().hex}"
    return bucketed.keep_bucketed(raw_equipment(fx), raw_points(fx), root, 16)


@query(
    with_views(["equipment", "points"], _metadata_sql("select * from v_equipment", "select * from v_points"))
)
def metadata_bucketed(fx: Fixtures) -> DataFrame:
    """Points and equipment in buckets, joined without a shuffle."""
    return plain(bucketed.metadata_bucketed(_bucketed(fx)))


@query(
    with_views(
        ["equipment", "points"],
        _metadata_sql(
            "select * from v_equipment where building_id in (0, 2, 5)",
            "select * from v_points where building_id in (0, 2, 5)",
            "select * from v_equipment",
        ),
    )
)
def metadata_bucketed_buildings(fx: Fixtures) -> DataFrame:
    """Three buildings of the bucketed tables; the busiest equipment stands in another."""
    return plain(bucketed.metadata_bucketed(_bucketed(fx), [0, 2, 5]))
