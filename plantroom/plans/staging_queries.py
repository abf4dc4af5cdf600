"""Staging queries."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.functions.columns import argument_table
from plantroom.operators import staging
from plantroom.plans.fixtures import Fixtures, with_views
from plantroom.plans.registry import plain, query
from plantroom.sources.shared import shared_folder, stored
from plantroom.sources.tables import write_new
from plantroom.sources.uploads import CsvRows, parse_upload_csv, read_upload_csv
from plantroom.workspace import Workspace

HERE = "(select id from v_buildings where name = 'Supplier#00000000{}')"


def _listing_sql(view: str, columns: str) -> str:
    return with_views([view], f"select {columns} from v_{view} where building_id = 3")


@query(_listing_sql("staging_points", "topic, equip, device_id, price"))
def staging_points(fx: Fixtures) -> DataFrame:
    return staging.staged_in(fx.view("staging_points"), 3).select("topic", "equip", "device_id", "price")


@query(_listing_sql("staging_equipment", "equip_id, balance"))
def staging_equipment(fx: Fixtures) -> DataFrame:
    return staging.staged_in(fx.view("staging_equipment"), 3).select("equip_id", "balance")


@query(_listing_sql("staging_devices", "device_id, device_name"))
def staging_devices(fx: Fixtures) -> DataFrame:
    return staging.staged_in(fx.view("staging_devices"), 3).select("device_id", "device_name")


def listed_points(fx: Fixtures) -> DataFrame:
    """Staged points with their equipment as a list of none, one or two, and hidden columns."""
    names = F.filter(F.array("equip", "second_equip"), lambda name: name.isNotNull())
    return (
        fx.view("staging_points")
        .withColumns({"equip_ids": names, "data.presValue": F.col("price"), "priority": F.col("status")})
        .drop("equip", "second_equip")
    )


def _staging_sql(building: int, keys: str) -> str:
    here = HERE.format(building)
    return with_views(
        ["buildings", "staging_points", "staging_equipment", "staging_devices"],
        f""", p as (select *, {keys} as equip_key from v_staging_points where building_id in {here}),
        e as (select * from v_staging_equipment where building_id in {here}),
        d as (select * from v_staging_devices where building_id in {here}),
        pe as (select p.topic, p.device_id, p.price, p.status, p.modified, p.building_id,
                      coalesce(p.equip_key, e.equip_id) as equip_key, e.balance, e.building_id as e_building_id
               from p full join e on p.equip_key is not distinct from e.equip_id)
        select d.building_id as d_building_id, d.device_name as d_device_name,
               pe.balance as e_balance, pe.e_building_id,
               pe.building_id as p_building_id, coalesce(pe.device_id, d.device_id) as p_device_id,
               pe.equip_key as p_equip_ids, pe.modified as p_modified, pe.price as p_price,
               pe.status as p_status, pe.topic as p_topic
        from pe full join d on pe.device_id is not distinct from d.device_id""",
    )


LISTED = "list_filter([equip, second_equip], lambda x: x is not null)"
TEXT_KEY = f"case when len({LISTED}) > 0 then array_to_string({LISTED}, ', ') end"
EACH_KEY = f"unnest(case when len({LISTED}) > 0 then {LISTED} else [null] end)"


def _staging_data(fx: Fixtures, building: int = 3, multi_equip: str = "text") -> DataFrame:
    tables = listed_points(fx), fx.view("staging_equipment"), fx.view("staging_devices")
    return staging.staging_data(f"Supplier#00000000{building}", fx.view("buildings"), *tables, multi_equip)


@query(_staging_sql(3, TEXT_KEY))
def staging_data(fx: Fixtures) -> DataFrame:
    return plain(_staging_data(fx))


@query(_staging_sql(2, TEXT_KEY))
def staging_data_no_devices(fx: Fixtures) -> DataFrame:
    """A building without devices: all rows come from points and equipment."""
    return plain(_staging_data(fx, 2))


@query(_staging_sql(3, EACH_KEY))
def staging_data_each_equipment(fx: Fixtures) -> DataFrame:
    """Points with several equipment get a row for each."""
    return plain(_staging_data(fx, multi_equip="explode"))


def staged_table(fx: Fixtures, building: int | None = None) -> DataFrame:
    rows = fx.view("staging_points")
    return (rows if building is None else staging.staged_in(rows, building)).select(
        F.col("topic").alias("p.topic"),
        F.col("equip").alias("e.equip_id"),
        F.col("status").alias("p.status"),
        F.col("price").alias("p.price"),
    )


def uploaded(fx: Fixtures) -> DataFrame:
    return fx.view("upload_rows").select(
        F.col("topic").alias("p.topic"), F.col("equip").alias("e.equip_id"), F.col("status").alias("p.status")
    )


VERSIONS = """
  , versions as (select distinct topic, equip, status from v_upload_rows where topic is not null),
  usable as (select topic, min(equip) as equip, min(status) as status from versions group by topic having count(*) = 1),
  gear as (select equip, min(status) as status
           from (select distinct equip, status from v_upload_rows where topic is null and equip is not null)
           group by equip having count(*) = 1)"""


# Rows without topic change columns of equipment; here there are none but the key, so new equipment is added.
MERGED = """
  , merged as (
      select s.topic as p_topic, case when u.topic is null then s.equip else u.equip end as e_equip_id,
             case when u.topic is null then s.status else u.status end as p_status, s.price as p_price
      from v_staging_points s left join usable u on u.topic = s.topic
      union all
      select topic, equip, status, null from usable where topic not in (select topic from v_staging_points))
  select * from merged
  union all
  select null, equip, null, null from gear where equip not in (select e_equip_id from merged where e_equip_id is not null)"""


@query(with_views(["staging_points", "upload_rows"], VERSIONS + MERGED))
def upload_result(fx: Fixtures) -> DataFrame:
    return plain(staging.upload(staged_table(fx), uploaded(fx)).staged)


@query(
    with_views(
        ["staging_points", "upload_rows"],
        VERSIONS
        + """
  select u.topic as p_topic,
         case when s.topic is null then 'inserted'
              when s.equip is not distinct from u.equip and s.status is not distinct from u.status then 'unchanged'
              else 'changed' end as change
  from usable u left join v_staging_points s on s.topic = u.topic""",
    )
)
def upload_changes(fx: Fixtures) -> DataFrame:
    """What an upload inserts, changes and leaves alone; some of it is uploaded as it is staged."""
    return plain(staging.upload_changes(staged_table(fx), uploaded(fx)))


@query(
    with_views(
        ["staging_points", "upload_rows"],
        VERSIONS + " select topic as p_topic, 'unchanged' as change from usable",
    )
)
def upload_again(fx: Fixtures) -> DataFrame:
    """The same upload a second time changes nothing."""
    staged = staging.upload(staged_table(fx), uploaded(fx)).staged
    return plain(staging.upload_changes(stored(staged, "staged"), uploaded(fx)))


@query(
    with_views(
        ["upload_rows"],
        VERSIONS
        + """
  select topic as p_topic, equip as e_equip_id, status as p_status,
         case when topic is not null then 'conflicting rows for p.topic'
              when equip is not null then 'conflicting rows for e.equip_id'
              else 'missing p.topic or e.equip_id' end as error
  from v_upload_rows
  where topic not in (select topic from usable)
     or topic is null and (equip is null or equip not in (select equip from gear))""",
    )
)
def upload_errors(fx: Fixtures) -> DataFrame:
    return plain(staging.upload(staged_table(fx), uploaded(fx)).errors)


@query(
    with_views(
        ["staging_points", "upload_rows"],
        VERSIONS
        + """
  , merged as (
      select s.topic as p_topic, case when u.topic is null then s.equip else u.equip end as e_equip_id,
             case when u.topic is null then cast(null as varchar) else u.status end as e_grade
      from v_staging_points s left join usable u on u.topic = s.topic
      union all
      select topic, equip, status from usable where topic not in (select topic from v_staging_points))
  select p_topic, e_equip_id, case when g.equip is null then e_grade else g.status end as e_grade
  from merged left join gear g on g.equip = e_equip_id
  union all
  select null, equip, status from gear where equip not in (select e_equip_id from merged where e_equip_id is not null)""",
    )
)
def upload_mixed_keys(fx: Fixtures) -> DataFrame:
    """Rows with a topic change that point's row, rows without one every row of their equipment."""
    rows = uploaded(fx).withColumnRenamed("p.status", "e.grade")
    return plain(staging.upload(staged_table(fx).select("`p.topic`", "`e.equip_id`"), rows).staged)


# A line as a spreadsheet writes it: quotes doubled inside quotes, and now and then no number where one belongs.
LINE = '''coalesce(topic, '') || ',' || equip || ',"said ""' || status || '""",' ||
          case when topic like '%7' then 'abc' when topic like '%3' then '2.5,more' else '1.5' end'''
CSV_ROWS = f"""
  , lines as (select distinct topic, equip, status, {LINE} as line from v_upload_rows
              where equip is not null and equip <> '__SKIP__' and topic is not null),
  good as (select topic, min(equip) as equip, 'said "' || min(status) || '"' as status from lines
           where not (topic like '%7' or topic like '%3') group by topic having count(*) = 1)"""


def csv_upload(fx: Fixtures) -> staging.UploadResult:
    wanted = fx.view("upload_rows").where("equip is not null and equip <> '__SKIP__' and topic is not null")
    lines = wanted.select(F.expr(LINE).alias("line"))
    schema = "`p.topic` string, `e.equip_id` string, `p.status` string, `p.weight` double"
    read = parse_upload_csv(lines, "line", schema).kept()
    return staging.upload(staged_table(fx), read.rows, read.refused)


@query(
    with_views(
        ["staging_points", "upload_rows"],
        CSV_ROWS
        + """
  select s.topic as p_topic, case when g.topic is null then s.equip else g.equip end as e_equip_id,
         case when g.topic is null then s.status else g.status end as p_status, s.price as p_price,
         case when g.topic is null then null else cast(1.5 as double) end as p_weight
  from v_staging_points s left join good g on g.topic = s.topic
  union all
  select topic, equip, status, null, 1.5 from good where topic not in (select topic from v_staging_points)""",
    )
)
def upload_csv(fx: Fixtures) -> DataFrame:
    """An upload as CSV lines with doubled quotes; lines that do not parse change nothing."""
    return plain(csv_upload(fx).staged)


@query(
    with_views(
        ["upload_rows"],
        f"""select topic as p_topic, 'does not parse: ' || {LINE} as error from v_upload_rows
            where equip is not null and equip <> '__SKIP__' and (topic like '%7' or topic like '%3')""",
    )
)
def upload_csv_errors(fx: Fixtures) -> DataFrame:
    """The lines that do not parse, each as often as it was uploaded."""
    return plain(csv_upload(fx).errors.where("error like 'does not parse%'").select("`p.topic`", "error"))


FILE_ROWS = """
  , records as (select topic, equip, 'edited "' || status || '",' || chr(10) || coalesce(equip, '') as note,
                       case when topic like '%7' then 'abc' else '1.5' end as weight from v_upload_rows)"""


def csv_file(fx: Fixtures) -> CsvRows:
    """Uploaded rows as CSV files, missing keys included, with line breaks and quotes in a field."""
    note = F.expr("concat('edited \"', status, '\",\\n', coalesce(equip, ''))")
    weight = F.expr("case when topic like '%7' then 'abc' else '1.5' end")
    table = fx.view("upload_rows").select(
        F.col("topic").alias("p.topic"), F.col("equip").alias("e.equip_id"), note.alias("p.note"), weight.alias("p.weight")
    )
    path = f"{shared_folder(fx.spark)}/upload-{uuid.uuid4().hex}"
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    table.write.options(header=True, escape='"', **blanks).csv(path)
    schema = "`p.topic` string, `e.equip_id` string, `p.note` string, `p.weight` double"
    return read_upload_csv(fx.spark, path, schema).kept()


@query(
    with_views(
        ["upload_rows"],
        FILE_ROWS
        + """
  select topic as p_topic, equip as e_equip_id, note as p_note, cast(weight as double) as p_weight, null as error
  from records where weight <> 'abc'
  union all
  select topic, equip, note, null, 'does not parse: ' || coalesce(topic, '') || ',' || coalesce(equip, '') || ',"'
         || replace(note, '"', '""') || '",' || weight from records where weight = 'abc'""",
    )
)
def upload_csv_file(fx: Fixtures) -> DataFrame:
    """CSV files read in parallel though their fields hold line breaks; records that do not parse and why."""
    read = csv_file(fx)
    return plain(read.rows.withColumn("error", F.lit(None).cast("string")).unionByName(read.refused))


@query(
    with_views(
        ["staging_points"],
        """select s.topic as p_topic, case when i.equip is not null then i.equip else s.equip end as e_equip_id,
                  case when i.equip is not null then i.balance else null end as e_balance
           from v_staging_points s
           left join (select 'Customer#000000001' as equip, cast(7.5 as double) as balance) i on i.equip = s.equip
           union all select null, 'Brand new', cast(8.5 as double)""",
    )
)
def upload_by_equipment(fx: Fixtures) -> DataFrame:
    """An upload without topics changes every row of its equipment."""
    rows = argument_table(
        fx.spark,
        {"e.equip_id": (pa.string(), ["Customer#000000001", "Brand new"]), "e.balance": (pa.float64(), [7.5, 8.5])},
    )
    return plain(staging.upload(staged_table(fx).select("`p.topic`", "`e.equip_id`"), rows).staged)


def live_table(fx: Fixtures, *more: str) -> DataFrame:
    """Live points, half of which are staged again below other names."""
    return fx.view("points").select(
        F.when(F.col("id") % 2 == 0, F.col("topic")).otherwise(F.concat(F.lit("live/"), "id")).alias("p.topic"),
        F.col("id").alias("p.point_id"),
        F.lit("live").alias("p.status"),
        *more,
    )


PROMOTED = """
  , live as (select case when id % 2 = 0 then topic else 'live/' || cast(id as varchar) end as topic,
                    id as point_id, 'live' as status from v_points),
  valid as (select topic, equip, status, price from v_staging_points
            where topic is not null and equip is not null and equip <> '__SKIP__' {chosen})
  select l.topic as p_topic, l.point_id as p_point_id,
         case when v.topic is null then l.status else v.status end as p_status,
         v.equip as e_equip_id, v.price as p_price
  from live l left join valid v on v.topic = l.topic
  union all
  select topic, null, status, equip, price from valid where topic not in (select topic from live)"""


@query(with_views(["points", "staging_points"], PROMOTED.format(chosen="")))
def promote_all(fx: Fixtures) -> DataFrame:
    return plain(staging.promote(staged_table(fx), live_table(fx)).live)


@query(
    with_views(
        ["points", "staging_points"],
        """
  , live as (select case when id % 2 = 0 then topic else 'live/' || cast(id as varchar) end as topic, id as point_id,
                    'live' as status, building_id from v_points),
  valid as (select topic, equip, status, price from v_staging_points
            where building_id = 3 and topic is not null and equip is not null and equip <> '__SKIP__')
  select l.topic as p_topic, l.point_id as p_point_id,
         case when v.topic is null then l.status else v.status end as p_status,
         v.equip as e_equip_id, v.price as p_price, l.building_id
  from live l left join valid v on v.topic = l.topic and l.building_id = 3
  union all
  select topic, null, status, equip, price, 3 from valid where topic not in (select topic from live where building_id = 3)""",
    )
)
def promote_written(fx: Fixtures) -> DataFrame:
    """One building is promoted and written back; the others' files stay, and the table is read again as a whole."""
    root = f"{shared_folder(fx.spark)}/live-{uuid.uuid4().hex}"
    write_new(live_table(fx, "building_id"), f"{root}/live", ["building_id"])
    site = Workspace.open(fx.spark, root)
    staged = staged_table(fx, 3)
    site.write_building("live", 3, staging.promote(staged, site.read_building("live", 3)).live)
    return plain(site.table("live"))


@query(
    with_views(
        ["points", "staging_points", "upload_rows"],
        PROMOTED.format(chosen="and (topic, equip) in (select topic, equip from v_upload_rows "
                               "where topic is not null and equip <> '__SKIP__')"),
    )
)
def promote_some(fx: Fixtures) -> DataFrame:
    chosen = uploaded(fx).select("`e.equip_id`", "`p.topic`")
    return plain(staging.promote(staged_table(fx), live_table(fx), chosen).live)


@query(
    with_views(
        ["staging_points", "upload_rows"],
        """, pairs as (select distinct equip, topic from v_upload_rows where equip <> '__SKIP__')
           select 'points' as type, topic, 'Listed row is not staged' as error from pairs
           where not exists (select 1 from v_staging_points s
                             where s.equip = pairs.equip and s.topic is not distinct from pairs.topic)""",
    )
)
def promote_some_report(fx: Fixtures) -> DataFrame:
    """Listed pairs that are not staged."""
    chosen = uploaded(fx).select("`e.equip_id`", "`p.topic`")
    return staging.promote(staged_table(fx), live_table(fx), chosen).report


@query(
    with_views(
        ["staging_points"],
        """select 'points' as type, topic,
                  case when equip is null then 'No valid equipment for topic'
                       else 'Skipped points are not validated' end as error
           from v_staging_points where equip is null or equip = '__SKIP__'""",
    )
)
def promote_report(fx: Fixtures) -> DataFrame:
    return staging.promote(staged_table(fx), live_table(fx)).report


BENIGN = "Skipped (equipment|points are) not validated|No valid equipment for topic"


@query(
    with_views(
        ["promotion_report"],
        f"""select type, topic, error from v_promotion_report
            where type <> 'building_id' and not regexp_matches(error, '{BENIGN}')""",
    )
)
def promote_errors(fx: Fixtures) -> DataFrame:
    return staging.promotion_errors(fx.view("promotion_report"))


@query(
    with_views(
        ["promotion_report"],
        f"""select section as type, case when section <> 'unexpected_deletes' then topic end as topic, error
            from v_promotion_report, (values ('equipment'), ('points'), ('unexpected_deletes')) s(section)
            where type = section and not regexp_matches(error, '{BENIGN}')""",
    )
)
def promote_errors_nested(fx: Fixtures) -> DataFrame:
    """Nested responses, molten and cleaned: messages by topic, and a plain list of unexpected deletes."""
    row = F.create_map("topic", "error")
    none = F.create_map().cast("map<string,string>")
    sections = {name: F.when(F.col("type") == name, row).otherwise(none) for name in ("points", "equipment")}
    listed = F.when(F.col("type") == "unexpected_deletes", F.array("error"))
    response = fx.view("promotion_report").select(
        F.lit(3).alias("building_id"),
        *[value.alias(name) for name, value in sections.items()],
        listed.alias("unexpected_deletes"),
    )
    return staging.promotion_errors(staging.melt_report(response))


@query(
    with_views(
        ["promotion_report"],
        f""", errors as (select type, case when topic like '%1' then null else substr(topic, 1, 8) end as topic, error
                         from v_promotion_report where type <> 'building_id' and not regexp_matches(error, '{BENIGN}')),
            each as (select type, topic, error, count(*) as times from errors group by type, topic, error)
            select type, topic, 0 as part, count(*) as n_messages, cast(sum(times) as bigint) as errors,
                   string_agg(error || ' x' || cast(times as varchar), '; ' order by error) as messages
            from each group by type, topic""",
    )
)
def promote_errors_by_topic(fx: Fixtures) -> DataFrame:
    """Lists of messages with their counts for groups of topics, one of them null."""
    topic = F.when(F.col("topic").like("%1"), None).otherwise(F.substring("topic", 1, 8))
    errors = staging.promotion_errors(fx.view("promotion_report")).withColumn("topic", topic)
    texts = F.transform("messages", lambda m: F.concat(m["error"], F.lit(" x"), m["times"].cast("string")))
    grouped = staging.errors_by_topic(errors, messages_a_row=1 << 20)
    return grouped.select(
        "type", "topic", F.col("part").cast("int").alias("part"), F.size("messages").cast("bigint").alias("n_messages"), "errors",
        F.array_join(texts, "; ").alias("messages"),
    )


@query(
    with_views(
        ["promotion_report"],
        f"""select topic, error from v_promotion_report
            where type = 'points' and not regexp_matches(error, '{BENIGN}')""",
    )
)
def promote_errors_of_points(fx: Fixtures) -> DataFrame:
    errors = staging.promotion_errors(fx.view("promotion_report"))
    return staging.errors_by_section(errors)["points"]


def listed_withdrawals(fx: Fixtures) -> DataFrame:
    """Every reading lists its point and, some of them, an equipment; most pairs repeat."""
    return fx.view("readings").select(
        F.col("point_id").alias("p.point_id"),
        F.when(F.col("event_id") % 3 != 0, F.col("point_id") * 2).alias("e.equipment_id"),
    )


def relationships(fx: Fixtures) -> DataFrame:
    return fx.view("points").select(F.col("equip_id").alias("equipment_id"), F.col("id").alias("point_id"))


GONE_EQUIPMENT = "select point_id * 2 from v_readings where event_id % 3 <> 0"


@query(
    with_views(
        ["points", "readings"],
        "select id, topic from v_points where id not in (select point_id from v_readings)",
    )
)
def unpromote_points(fx: Fixtures) -> DataFrame:
    left = staging.unpromote(fx.view("points"), fx.view("equipment"), listed_withdrawals(fx), "points")
    return left.points.select("id", "topic")


@query(
    with_views(
        ["equipment", "readings"],
        f"select id, equip_id from v_equipment where id not in ({GONE_EQUIPMENT})",
    )
)
def unpromote_equipment(fx: Fixtures) -> DataFrame:
    left = staging.unpromote(fx.view("points"), fx.view("equipment"), listed_withdrawals(fx), "equipment")
    return left.equipment.select("id", "equip_id")


@query(
    with_views(
        ["points", "readings"],
        f"""select equip_id as equipment_id, id as point_id from v_points
            where id not in (select point_id from v_readings)
              and (equip_id is null or equip_id not in ({GONE_EQUIPMENT}))""",
    )
)
def unpromote_relationships(fx: Fixtures) -> DataFrame:
    left = staging.unpromote(
        fx.view("points"), fx.view("equipment"), listed_withdrawals(fx), "equipment", relationships(fx)
    )
    return left.relationships


@query(
    with_views(
        ["readings"],
        """select distinct point_id, case when event_id % 3 <> 0 then point_id * 2 end as equipment_id
           from v_readings""",
    )
)
def unpromote_pairs(fx: Fixtures) -> DataFrame:
    return staging.withdrawal_pairs(listed_withdrawals(fx))
