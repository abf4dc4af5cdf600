"""Time-series queries."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.functions.columns import argument_table
from plantroom.operators import timeseries
from plantroom.operators.profiles import read_profile, write_profiled
from plantroom.plans.fixtures import Fixtures, with_views
from plantroom.plans.registry import plain, query
from plantroom.sources.documents import parse_json
from plantroom.sources.layout import read_readings, write_readings
from plantroom.sources.shared import shared_folder
from plantroom.sources.tables import read_table

START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
WEEK_START, WEEK_END = "2024-01-08T00:00:00Z", "2024-01-15T00:00:00Z"
KINDS = ("click", "error", "purchase", "signup", "view")
METERS = tuple(f"meter {no}" for no in range(1, 8))


def _wide_sql(view: str, value: str, names: tuple[str, ...], order: str, pick: str = "first", where: str = "") -> str:
    """Keep one reading per second and name, then one column per name."""
    direction = "asc" if pick == "first" else "desc"
    ordering = ", ".join(f"{key.strip()} {direction}" for key in order.split(","))
    cells = ", ".join(f"max(case when display = '{name}' then cell end) as \"{name}\"" for name in names)
    return with_views(
        [view],
        f""", kept as (
               select date_trunc('second', time) as second, display, {value} as cell,
                      row_number() over (partition by date_trunc('second', time), display
                                         order by {ordering}) as no
               from v_{view} {where})
            select second as time, {cells} from kept where no = 1 group by second""",
    )


@query(
    with_views(
        ["readings"],
        "select time, raw, unit, point_id, topic, display from v_readings "
        f"where time >= timestamp '{START}' and time < timestamp '{END}'",
    )
)
def ts_raw(fx: Fixtures) -> DataFrame:
    """All points over the whole time range."""
    return timeseries.timeseries_raw(fx.view("readings"), START, END, None).select(*timeseries.READING_COLUMNS)


@query(
    with_views(
        ["readings"],
        """select event_id, case when event_id % 3 = 0 then cast(cast(floor(raw) as int) as varchar)
                                 else 'v' || cast(event_id as varchar) end as raw,
                  case when event_id % 3 <> 0 then display end as quality, cast(point_id as bigint) as point_id
           from v_readings""",
    )
)
def readings_drift(fx: Fixtures) -> DataFrame:
    """Files in which a column is a number, and files in which it is a text, as one table."""
    root, readings = f"{shared_folder(fx.spark)}/drift-{uuid.uuid4().hex}", fx.view("readings")
    numbers = readings.where("event_id % 3 = 0").selectExpr("event_id", "cast(floor(raw) as int) as raw", "cast(point_id as int) as point_id")
    texts = readings.where("event_id % 3 <> 0").selectExpr(
        "event_id", "'v' || cast(event_id as string) as raw", "display as quality", "cast(point_id as bigint) as point_id"
    )
    numbers.write.parquet(f"{root}/readings")
    texts.write.mode("append").parquet(f"{root}/readings")
    return read_table(fx.spark, root, "readings").select("event_id", "raw", "quality", "point_id")


@query(
    with_views(
        ["readings", "points"],
        """select time, raw, unit, point_id, topic, display from v_readings
           where time >= timestamp '2024-01-08 00:00:00' and time < timestamp '2024-01-15 00:00:00'
             and point_id in (select id from v_points where type = '1-URGENT')""",
    )
)
def ts_raw_of_points(fx: Fixtures) -> DataFrame:
    """A week of the points that a table of ids lists."""
    ids = fx.view("points").where("type = '1-URGENT'").select("id")
    found = timeseries.timeseries_raw(fx.view("readings"), WEEK_START, WEEK_END, ids)
    return found.select(*timeseries.READING_COLUMNS)


@query(
    with_views(
        ["readings", "points"],
        """select time, raw, unit, point_id, topic, display from v_readings
           where time >= timestamp '2024-01-08 00:00:00' and time < timestamp '2024-01-15 00:00:00'
             and point_id in (select id from v_points where type = '1-URGENT')""",
    )
)
def ts_raw_laid_out(fx: Fixtures) -> DataFrame:
    """A week of some points, from readings written by day and point."""
    readings, path = fx.view("readings"), f"{shared_folder(fx.spark)}/laid-out-{uuid.uuid4().hex}"
    write_readings(readings, path)
    ids = fx.view("points").where("type = '1-URGENT'").select("id")
    laid_out = read_readings(fx.spark, path, readings.schema)
    found = timeseries.timeseries_raw(laid_out, WEEK_START, WEEK_END, ids, date_column="date")
    return found.select(*timeseries.READING_COLUMNS)


def packed_blocks(fx: Fixtures, quality: bool = False) -> DataFrame:
    """Readings as nested blocks: old ones with a ``clean`` entry, some empty, one or two readings each.

    Blocks are built row by row, so none grows with the data. With ``quality``,
    current blocks hold a further name.
    """
    no = F.col("event_id")
    time, raw, unit = (F.col(c).cast("string") for c in ("time", "raw", "unit"))
    later = (F.col("time") + F.expr("interval 1 hour")).cast("string")
    clean = F.lit("true")

    def block(names, first, second) -> F.Column:
        readings = (
            F.when(no % 10 == 0, F.array().cast("array<array<string>>"))
            .when(no % 2 == 0, F.array(F.array(*first), F.array(*second)))
            .otherwise(F.array(F.array(*first)))
        )
        return F.struct(F.array(*[F.lit(n) for n in names]).alias("columns"), readings.alias("values"))

    current = block(["time", "raw", "degF"], [time, raw, unit], [later, raw, unit])
    if quality:
        grade = F.concat(F.lit("grade "), (no % 5).cast("string"))
        current = block(["time", "raw", "degF", "quality"], [time, raw, unit, grade], [later, raw, unit, grade])
    old = block(["time", "clean", "raw", "degF"], [time, clean, raw, unit], [later, clean, raw, unit])
    swapped = block(["raw", "time", "kPa", "clean"], [raw, time, unit, clean], [raw, later, unit, clean])
    packed = F.when(no % 3 == 0, old).when(no % 3 == 1, swapped).otherwise(current)
    return fx.view("readings").select("point_id", "topic", "display", packed.alias("b")).select(
        "point_id", "topic", "display", "b.columns", "b.values"
    )


BLOCKS_SQL = """
  select time, raw, unit, point_id, topic, display from v_readings where event_id % 10 <> 0
  union all
  select time + interval 1 hour as time, raw, unit, point_id, topic, display from v_readings
  where event_id % 10 <> 0 and event_id % 2 = 0"""


def _typed(long: DataFrame, *more: str) -> DataFrame:
    return long.select(
        *more,
        F.col("time").try_cast("timestamp_ntz").alias("time"),
        F.col("raw").try_cast("double").alias("raw"),
        F.col("unit").try_cast("double").alias("unit"),
        "point_id",
        "topic",
        "display",
    )


@query(with_views(["readings"], BLOCKS_SQL))
def ts_blocks(fx: Fixtures) -> DataFrame:
    """Nested blocks to long rows."""
    return _typed(timeseries.unpack_blocks(packed_blocks(fx)))


@query(
    with_views(
        ["readings"],
        """, graded as (select *, case when event_id % 3 = 2 then 'grade ' || cast(event_id % 5 as varchar) end as quality
                        from v_readings where event_id % 10 <> 0)
           select time, raw, unit, quality, point_id, topic, display from graded
           union all
           select time + interval 1 hour as time, raw, unit, quality, point_id, topic, display from graded
           where event_id % 2 = 0""",
    )
)
def ts_blocks_extra_columns(fx: Fixtures) -> DataFrame:
    """Blocks some of which hold a further name: it becomes a column, null where it is missing."""
    long = timeseries.unpack_blocks(packed_blocks(fx, quality=True))
    return _typed(long, "quality")


@query(with_views(["readings"], BLOCKS_SQL))
def ts_blocks_json(fx: Fixtures) -> DataFrame:
    """Nested blocks as JSON texts in which numbers are numbers."""
    blocks = packed_blocks(fx)
    quoted = F.to_json("values")
    # Unquote what is a number, as a service would send it.
    values = F.regexp_replace(quoted, r'"(-?[0-9]+[.]?[0-9]*(?:[eE][-+]?[0-9]+)?)"', "$1")
    text = F.concat(
        F.lit('{"point_id":'), F.col("point_id"), F.lit(',"topic":"'), "topic", F.lit('","display":"'), "display",
        F.lit('","columns":'), F.to_json("columns"), F.lit(',"values":'), values, F.lit("}"),
    )
    parsed = parse_json(blocks.select(text.alias("block")), "block", timeseries.BLOCK_SCHEMA, flat=False)
    return _typed(timeseries.unpack_blocks(parsed))


TWO_WEEKS_SQL = with_views(
    ["readings"],
    f""", long as ({BLOCKS_SQL}),
         kept as (select date_trunc('second', time) as second, display, unit as cell,
                         row_number() over (partition by date_trunc('second', time), display
                                            order by time, point_id, unit nulls first) as no
                  from long where time >= timestamp '2024-01-08 00:00:00' and time < timestamp '2024-01-22 00:00:00')
         select second as time, """
    + ", ".join(f"max(case when display = '{name}' then cell end) as \"{name}\"" for name in KINDS)
    + " from kept where no = 1 group by second",
)


@query(TWO_WEEKS_SQL)
def ts_wide_from_blocks(fx: Fixtures) -> DataFrame:
    """The whole way: text blocks to long rows, two weeks of them, typed and wide."""
    long = timeseries.unpack_blocks(packed_blocks(fx))
    return plain(timeseries.timeseries(long, "2024-01-08", "2024-01-22", None))


@query(TWO_WEEKS_SQL)
def ts_wide_profiled(fx: Fixtures) -> DataFrame:
    """Blocks unpacked and stored once; names and type are known from then."""
    path = f"{shared_folder(fx.spark)}/profiled-{uuid.uuid4().hex}"
    write_profiled(timeseries.unpack_blocks(packed_blocks(fx)), path)
    stored = fx.spark.read.parquet(path)
    return plain(timeseries.timeseries(stored, "2024-01-08", "2024-01-22", None, profile=read_profile(fx.spark, path)))


@query(_wide_sql("readings", "unit", KINDS, "time, event_id"))
def ts_wide_default(fx: Fixtures) -> DataFrame:
    long = timeseries.timeseries_raw(fx.view("readings"), START, END, None)
    return timeseries.timeseries_wide(long, order_by=["time", "event_id"], unique_order=True)


@query(_wide_sql("readings", "raw", KINDS, "time, event_id"))
def ts_wide_raw(fx: Fixtures) -> DataFrame:
    """Names given, so that nothing has to be looked up first."""
    return timeseries.timeseries(
        fx.view("readings"), START, END, None, unit_type="raw", columns=KINDS, order_by=["time", "event_id"],
        unique_order=True,
    )


@query(_wide_sql("meter_readings", "raw", METERS, "time, reading_id"))
def ts_wide_crowded(fx: Fixtures) -> DataFrame:
    """Many readings in every cell; the first is kept."""
    return timeseries.timeseries_wide(
        fx.view("meter_readings"), "raw", order_by=["time", "reading_id"], unique_order=True
    )


@query(_wide_sql("meter_readings", "raw", METERS, "time, point_id, raw"))
def ts_wide_ties(fx: Fixtures) -> DataFrame:
    """Readings the order leaves equal are settled by their value."""
    return timeseries.timeseries_wide(fx.view("meter_readings"), "raw", order_by=["time", "point_id"])


@query(_wide_sql("meter_readings", "unit", METERS, "time, reading_id", pick="last"))
def ts_wide_last(fx: Fixtures) -> DataFrame:
    return timeseries.timeseries_wide(
        fx.view("meter_readings"), columns=METERS, duplicates="last", order_by=["time", "reading_id"],
        unique_order=True,
    )


@query(
    with_views(
        ["meter_readings"],
        "select date_trunc('second', time) as time, "
        + ", ".join(f"avg(raw) filter (where display = '{name}') as \"{name}\"" for name in METERS)
        + " from v_meter_readings group by 1",
    )
)
def ts_wide_mean(fx: Fixtures) -> DataFrame:
    return timeseries.timeseries_wide(fx.view("meter_readings"), "raw", duplicates="mean")


@query(
    with_views(
        ["meter_readings"],
        """, placed as (
               select date_trunc('second', time) as time, display as name, raw as value,
                      row_number() over (partition by date_trunc('second', time), display
                                         order by time, reading_id) - 1 as place
               from v_meter_readings)
           select time, name, cast(floor(place / 50) as bigint) as segment, cast(place % 50 as int) as place, value
           from placed""",
    )
)
def ts_wide_lists(fx: Fixtures) -> DataFrame:
    """All readings of crowded cells, in lists of 50; their entries are shown one by one."""
    wide = timeseries.timeseries_lists(
        fx.view("meter_readings"), "raw", order_by=["time", "reading_id"], max_length=50
    )
    lists = F.create_map(*[part for name in METERS for part in (F.lit(name), F.col(name))])
    cells = wide.select("time", "segment", F.explode(lists).alias("name", "list"))
    return cells.select("time", "segment", "name", F.posexplode("list").alias("place", "value"))


MANY = tuple(f"m{no}" for no in range(64))


@query(
    with_views(
        ["meter_readings"],
        """, kept as (
               select date_trunc('second', time) as second, 'm' || cast(point_id % 64 as varchar) as name, raw as cell,
                      row_number() over (partition by date_trunc('second', time), point_id % 64
                                         order by time, reading_id) as no
               from v_meter_readings)
           select second as time, """
        + ", ".join(f"max(case when name = '{name}' then cell end) as \"{name}\"" for name in MANY)
        + " from kept where no = 1 group by second",
    )
)
def ts_wide_by_point(fx: Fixtures) -> DataFrame:
    """64 columns: more than a single aggregation should carry."""
    named = fx.view("meter_readings").withColumn("name", F.concat(F.lit("m"), F.col("point_id") % 64))
    return timeseries.timeseries_wide(
        named, "raw", names_from="name", order_by=["time", "reading_id"], unique_order=True
    )


@query(
    with_views(
        ["readings"],
        """, kept as (
               select date_trunc('second', time) as time, 'p' || cast(point_id as varchar) as name, unit as cell,
                      row_number() over (partition by date_trunc('second', time), point_id
                                         order by time, event_id) as no
               from v_readings)
           select time, name, cell from kept where no = 1""",
    )
)
def ts_map_by_point(fx: Fixtures) -> DataFrame:
    """One name per point: a map for each second, whose entries are shown one by one."""
    named = fx.view("readings").withColumn("name", F.concat(F.lit("p"), "point_id"))
    wide = timeseries.timeseries_map(named, names_from="name", order_by=["time", "event_id"], unique_order=True)
    return wide.select("time", F.explode("values").alias("name", "cell"))


@query(_wide_sql("readings", "unit", KINDS, "time, event_id", where=f"where time < timestamp '{START}' + interval 14 day"))
def ts_wide_offsets(fx: Fixtures) -> DataFrame:
    """Times as texts with offsets: range and label both read them whole."""
    moved = F.date_format(F.col("time") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")
    plain_text = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    texts = fx.view("readings").withColumn("time", F.when(F.col("event_id") % 2 == 0, moved).otherwise(plain_text))
    found = timeseries.timeseries_raw(texts, "2000-01-01", "2024-01-15", None)
    return plain(timeseries.timeseries_wide(found, columns=KINDS, order_by=["time", "event_id"]))


def _as_text(df: DataFrame, expression: str) -> DataFrame:
    iso = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return df.withColumn("unit", F.expr(expression)).withColumn("time", iso)


TEXT_VALUE = "case when event_id = 5 then 'fault' else cast(raw as {text}) end"
WHOLE_VALUE = "cast(cast(floor(raw) as bigint) as {text})"
FLAG_VALUE = "case when raw > 10 then 'TRUE' when raw > 1 then 'F' when raw <= 1 then 'NA' end"


@query(_wide_sql("readings", TEXT_VALUE.format(text="varchar"), KINDS, "time, event_id"))
def ts_wide_text(fx: Fixtures) -> DataFrame:
    """ISO text times, and one text reading that makes every column text."""
    long = _as_text(fx.view("readings"), TEXT_VALUE.format(text="string"))
    return plain(timeseries.timeseries_wide(long, order_by=["time", "event_id"]))


@query(_wide_sql("readings", "cast(floor(raw) as integer)", KINDS, "time, event_id"))
def ts_wide_whole(fx: Fixtures) -> DataFrame:
    """Texts that are all whole numbers become integers."""
    long = _as_text(fx.view("readings"), WHOLE_VALUE.format(text="string"))
    return plain(timeseries.timeseries_wide(long, order_by=["time", "event_id"]))


@query(_wide_sql("readings", "case when raw > 10 then true when raw > 1 then false end", KINDS, "time, event_id"))
def ts_wide_flags(fx: Fixtures) -> DataFrame:
    """Texts that are all truth values or missing become booleans."""
    long = _as_text(fx.view("readings"), FLAG_VALUE)
    return plain(timeseries.timeseries_wide(long, order_by=["time", "event_id"]))


CONVERSIONS = {
    "measurement": (pa.string(), ["kind 1", "kind 1", "kind 2", "kind 2", "kind 3"]),
    "from_unit": (pa.string(), ["degc", "degc", "pa", "pa", "pa"]),
    "to_unit": (pa.string(), ["k", "degf", "kpa", "bar", "kpa"]),
    "scale": (pa.float64(), [1.0, 1.8, 0.001, 0.00001, 0.001]),
    "offset": (pa.float64(), [273.15, 32.0, 0.0, 0.0, 0.0]),
}


@query(
    with_views(
        ["readings", "points"],
        """select r.time, r.raw, r.point_id, r.topic, r.display,
                  case when p.measurement = 'kind 1' and p.units = 'degc' then r.raw * cast(1.8 as double) + 32
                       when p.measurement = 'kind 2' and p.units = 'pa' then r.raw * cast(0.001 as double)
                       else r.unit end as unit
           from v_readings r left join v_points p on p.id = r.point_id""",
    )
)
def ts_units(fx: Fixtures) -> DataFrame:
    conversions = argument_table(fx.spark, CONVERSIONS)
    factors = timeseries.unit_factors({"kind 1": "degf", "kind 2": "kpa"}, fx.view("points"), conversions)
    found = timeseries.timeseries_raw(fx.view("readings"), START, END, None, factors)
    return found.select(*timeseries.READING_COLUMNS)
