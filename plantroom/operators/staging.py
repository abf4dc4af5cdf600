"""The staging area: listings, the joined view, upload, promotion, withdrawal."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import (
    col,
    distinct_keys,
    drop_matching,
    filter_by_ids,
    full_join,
    id_column,
    prefix_columns,
    require_columns,
    sort_columns,
    spread,
    unmatched,
)
from plantroom.operators.catalog import one_building

# Fixed value: columns left out of the staging view, matched anywhere in the prefixed name.
HIDDEN_COLUMNS = (
    r"polarity|reliability|event|covIncrement|presvalue|statusflags|outofservice|datasource|limit|deadband"
    r"|@prop|timedelay|instance_tagger|ob_predicted|notif|acked|resolution|state_text|relinquish|priority"
    r"|p\.data\.e\.|_tagger|p\.confidences\.e\.|check|\.err|tags|type_id|unit_id"
    r"|maxMaster|offset|objectList|systemStatus|maxInfo|protocolVersion|Revision|vendorId|lastRestart"
    r"|Segment|apdu|binding|daylight|d.objectInstance|covsubscription|align|backup|restore|Sync"
)

# Fixed value: equipment name of rows that are to be left alone.
SKIP = "__SKIP__"

# Marks the text of several equipment names while rows are joined, so that it equals no single name.
MANY = "\u0000"

# Messages that report nothing wrong, and the sections of an error report.
SKIPPED_EQUIPMENT = "Skipped equipment not validated"
SKIPPED_POINTS = "Skipped points are not validated"
NO_VALID_EQUIPMENT = "No valid equipment for topic"
BENIGN_MESSAGES = r"Skipped (equipment|points are) not validated|No valid equipment for topic"
ERROR_SECTIONS = ("points", "equipment", "unexpected_deletes")

#: Report message for listed rows that are not there.
NOT_STAGED = "Listed row is not staged"

UNPROMOTE_TYPES = ("points", "equipment")


def staged_in(table: DataFrame, building_id: int) -> DataFrame:
    """Staging points, equipment or devices of one building, otherwise untouched."""
    return table.where(col("building_id") == building_id)


def _equip_key(points: DataFrame, multi_equip: str) -> DataFrame:
    """Replace the equipment list of staged points by one text key.

    A list of one is its element. A longer list is a text marked as no equipment's
    name, or with ``multi_equip="explode"`` one row per element. An empty list is
    null.
    """
    if not isinstance(points.schema["p.equip_ids"].dataType, T.ArrayType):
        return points
    names = col("p.equip_ids").cast("array<string>")
    if multi_equip == "explode":
        key = F.explode_outer(names)
    else:
        text = F.array_join(names, ", ")
        key = F.when(F.size(names) == 1, names[0]).when(F.size(names) > 1, F.concat(F.lit(MANY), text))
    return points.select([key.alias(n) if n == "p.equip_ids" else col(n) for n in points.columns])


def staging_view(
    points: DataFrame,
    equipment: DataFrame,
    devices: DataFrame,
    multi_equip: str = "text",
) -> DataFrame:
    """Staged points with their equipment and device in one row, cleaned up.

    All points, equipment and devices are kept; the keys survive as
    ``p.equip_ids`` and ``p.device_id``. Timestamps stay raw.
    """
    if multi_equip not in ("text", "explode"):
        raise ValueError("multi_equip must be 'text' or 'explode'")
    require_columns(points, ["equip_ids", "device_id"], "staging points")
    require_columns(equipment, ["equip_id"], "staging equipment")
    require_columns(devices, ["device_id"], "staging devices")
    gear = drop_matching(prefix_columns(equipment, "e."), HIDDEN_COLUMNS)
    hardware = drop_matching(prefix_columns(devices, "d."), HIDDEN_COLUMNS, ignore_case=True)
    staged = _equip_key(
        drop_matching(prefix_columns(points, "p."), HIDDEN_COLUMNS, ignore_case=True), multi_equip
    )
    with_gear = full_join(staged, gear, "p.equip_ids", "e.equip_id")
    # Equipment without points has no device, so the second join's keys are those
    # of the points, and null if there is such equipment.
    idle = unmatched(gear, "e.equip_id", staged.select(col("p.equip_ids")))
    device_type = staged.schema["p.device_id"].dataType
    device_keys = staged.select(col("p.device_id")).union(idle.select(F.lit(None).cast(device_type)))
    rows = full_join(with_gear, hardware, "p.device_id", "d.device_id", device_keys)
    return sort_columns(rows.withColumn("p.equip_ids", F.ltrim(col("p.equip_ids"), F.lit(MANY))))


def staging_data(
    building: int | str | Sequence[int | str],
    buildings: DataFrame,
    points: DataFrame,
    equipment: DataFrame,
    devices: DataFrame,
    multi_equip: str = "text",
    check: bool = True,
) -> DataFrame:
    """:func:`staging_view` of one building, given by its id or by a name no other has.

    With ``check`` small jobs make sure that the building exists and has points.
    """
    wanted = one_building(buildings, building, check)
    here = filter_by_ids(points, "building_id", wanted)
    if check and here.isEmpty():
        raise ValueError(f"no points found for building {building}")
    return staging_view(
        here,
        filter_by_ids(equipment, "building_id", wanted),
        filter_by_ids(devices, "building_id", wanted),
        multi_equip,
    )


def _one_per_key(rows: DataFrame, key: str, hot: bool) -> tuple[DataFrame, DataFrame]:
    """(rows with exactly one version per key, keys with several versions).

    Exact copies count as one version. Copies collapse before the shuffle, so a
    key repeated without end costs one row per task. ``hot`` says that a join by
    the key may have to be split, see :func:`spread`; otherwise the join takes
    the rows as they come out, partitioned and sorted by the key.
    """
    whole = F.struct(*[col(name) for name in rows.columns])
    bucket = [spread(col(key)).alias("__bucket")] if hot else []
    versions = rows.groupBy(col(key).alias("__key"), *bucket).agg(
        F.min(whole).alias("__low"), F.max(whole).alias("__high")
    )
    # The key comes from the grouping, by which the rows are known to be partitioned.
    parts = [F.col("__key") if name == key else F.col("__low").getField(name) for name in rows.columns]
    single = versions.where(F.col("__low").eqNullSafe(F.col("__high"))).select(
        [part.alias(name) for part, name in zip(parts, rows.columns)]
    )
    several = versions.where(~F.col("__low").eqNullSafe(F.col("__high"))).select(F.col("__key").alias(key))
    return single, several


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``target`` with ``updates`` applied by ``key``; updates hold each key once.

    A row whose key is updated takes the columns the updates have and keeps the
    rest. New keys are added, with nulls in the columns they lack. Columns only
    the updates have are appended.
    """
    return _merged(full_join(target, _fresh(updates), key, f"__new.{key}"), target, updates, key)


def upsert_unique(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """:func:`upsert` by a key that few rows of ``target`` share, null apart.

    One outer join, each side shuffled once: no key is hot. Rows without key meet
    no update and are spread by their contents.
    """
    spot = F.concat(F.lit("\u0000"), F.xxhash64(*[col(name) for name in target.columns]))
    spotted = target.withColumn("__spot", F.coalesce(col(key), spot))
    joined = spotted.join(_fresh(updates), F.col("__spot") == col(f"__new.{key}"), "full")
    return _merged(joined.withColumn(key, F.coalesce(col(key), col(f"__new.{key}"))), target, updates, key)


def _fresh(updates: DataFrame) -> DataFrame:
    return updates.select(
        *[col(name).alias(f"__new.{name}") for name in updates.columns], F.lit(True).alias("__updated")
    )


def _merged(joined: DataFrame, target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    changed = [name for name in updates.columns if name != key]
    columns = []
    for name in [*target.columns, *[name for name in updates.columns if name not in target.columns]]:
        if name not in changed:
            columns.append(col(name))
        elif name in target.columns:
            columns.append(
                F.when(F.col("__updated"), col(f"__new.{name}")).otherwise(col(name)).alias(name)
            )
        else:
            columns.append(col(f"__new.{name}").alias(name))
    return joined.select(columns)


@dataclass(frozen=True)
class UploadResult:
    """The staging table after an upload, and the rows that were refused."""

    staged: DataFrame
    errors: DataFrame


def upload(staged: DataFrame, rows: DataFrame, refused: DataFrame | None = None) -> UploadResult:
    """Merge uploaded rows into the staging table.

    A row is matched by its ``p.topic`` where it has one, else by ``e.equip_id``;
    then it changes every staged row of that equipment, and in an upload that has
    topics only columns of equipment (``e.``). Only the uploaded columns change.
    Rows with neither key, and all versions of a key that is uploaded with
    different contents, are refused: they come back in ``errors`` with their
    columns and a reason, and leave the table as it was. So do the ``refused``
    rows of a CSV file, which carry their reason already. Uploading the same rows
    again changes nothing.
    """
    keys = [name for name in ("p.topic", "e.equip_id") if name in rows.columns]
    if not keys:
        raise ValueError("the upload needs a p.topic or an e.equip_id column")
    require_columns(staged, keys, "staging table")
    lost = reduce(lambda a, b: a & b, [col(name).isNull() for name in keys])
    errors = rows.where(lost).withColumn("error", F.lit(f"missing {' or '.join(keys)}"))
    result = staged
    if "p.topic" in keys:
        single, conflicts = _usable(rows.where(col("p.topic").isNotNull()), "p.topic", hot=False)
        result = upsert_unique(result, single, "p.topic")
        errors = errors.unionByName(conflicts)
    if "e.equip_id" in keys:
        by_gear = rows.where(col("e.equip_id").isNotNull())
        if "p.topic" in keys:
            by_gear = by_gear.where(col("p.topic").isNull())
        single, conflicts = _usable(by_gear, "e.equip_id", hot=True)
        if "p.topic" in keys:
            single = single.select([col(name) for name in single.columns if name.startswith("e.")])
        result = upsert(result, single, "e.equip_id")
        errors = errors.unionByName(conflicts)
    if refused is not None:
        errors = errors.unionByName(refused, allowMissingColumns=True)
    return UploadResult(staged=result, errors=errors)


def row_digest(df: DataFrame, names: Sequence[str]) -> Column:
    """A digest of some columns of a row: names and values, nulls told from texts. A column ``df`` lacks counts as null."""
    present = [col(name).alias(name) for name in sorted(names) if name in df.columns]
    return F.sha2(F.to_json(F.struct(*present)) if present else F.lit("{}"), 256)


def upload_changes(staged: DataFrame, rows: DataFrame) -> DataFrame:
    """What :func:`upload` would do with rows that have a topic: (p.topic, change).

    ``inserted`` topics are not staged yet, ``changed`` ones differ in an uploaded column from a row staged for them,
    ``unchanged`` ones would be written as they are. Topics uploaded with different contents are refused by the upload
    and do not appear. Only keys and digests of the uploaded columns are joined, not the rows; a number and a text
    differ whatever they say.
    """
    require_columns(rows, ["p.topic"], "upload")
    require_columns(staged, ["p.topic"], "staging table")
    single, _ = _usable(rows.where(col("p.topic").isNotNull()), "p.topic", hot=False)
    names = [name for name in single.columns if name != "p.topic"]
    new = single.select(col("p.topic").alias("p.topic"), row_digest(single, names).alias("__new"))
    held = staged.where(col("p.topic").isNotNull()).select(col("p.topic").alias("__topic"), row_digest(staged, names).alias("__old"))
    old = held.groupBy("__topic").agg(F.min("__old").alias("__low"), F.max("__old").alias("__high"))
    same = (F.col("__low") == F.col("__new")) & (F.col("__high") == F.col("__new"))
    change = F.when(F.col("__topic").isNull(), "inserted").when(same, "unchanged").otherwise("changed")
    return new.join(old, col("p.topic") == F.col("__topic"), "left").select(col("p.topic"), change.alias("change"))


def changed_rows(staged: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of an upload without those of topics it would leave as they are; uploading these has the same result."""
    idle = upload_changes(staged, rows).where("change = 'unchanged'").select(col("p.topic").alias("__idle"))
    return rows.join(idle, col("p.topic") == F.col("__idle"), "left_anti")


def _usable(rows: DataFrame, key: str, hot: bool) -> tuple[DataFrame, DataFrame]:
    """(one row for each key, rows of keys with different contents and why they are refused)."""
    single, several = _one_per_key(rows, key, hot)
    disputed = several.withColumnRenamed(key, "__disputed")
    conflicts = rows.join(disputed, col(key) == F.col("__disputed"), "left_semi")
    return single, conflicts.withColumn("error", F.lit(f"conflicting rows for {key}"))


@dataclass(frozen=True)
class PromotionResult:
    """The live table after a promotion, and the tidy report (type, topic, error)."""

    live: DataFrame
    report: DataFrame

    @property
    def errors(self) -> DataFrame:
        """The report without the messages that mean nothing is wrong."""
        return promotion_errors(self.report)


def promote(staged: DataFrame, live: DataFrame, chosen: DataFrame | None = None) -> PromotionResult:
    """Apply valid staged rows to the live table, matched by ``p.topic``.

    ``chosen`` (``e.equip_id``, ``p.topic``) limits this to the listed pairs;
    listed rows marked ``__SKIP__`` or without equipment are passed over. A
    staged row is valid when it has a topic and equipment other than
    ``__SKIP__`` and no different row is staged for its topic. What is not
    promoted stands in the report, listed pairs that no staged row has included.
    """
    require_columns(staged, ["e.equip_id", "p.topic"], "staging table")
    absent = None
    if chosen is not None:
        require_columns(chosen, ["e.equip_id", "p.topic"], "rows to promote")
        listed = chosen.where(col("e.equip_id") != SKIP)
        pairs = distinct_keys(listed.select(col("e.equip_id").alias("__equip"), col("p.topic").alias("__topic")))
        same = (col("e.equip_id") == F.col("__equip")) & col("p.topic").eqNullSafe(F.col("__topic"))
        absent = pairs.join(staged.select(col("e.equip_id"), col("p.topic")), same, "left_anti").select(
            F.lit("points").alias("type"), F.col("__topic").alias("topic"), F.lit(NOT_STAGED).alias("error")
        )
        staged = staged.join(pairs, same, "left_semi")
    no_topic = col("p.topic").isNull()
    no_equipment = col("e.equip_id").isNull()
    skipped = col("e.equip_id") == SKIP
    single, several = _one_per_key(staged.where(~no_topic & ~no_equipment & ~skipped), "p.topic", hot=False)
    refused = F.when(no_topic, "Topic is missing").when(no_equipment, NO_VALID_EQUIPMENT).when(skipped, SKIPPED_POINTS)
    report = (
        staged.select(F.lit("points").alias("type"), col("p.topic").alias("topic"), refused.alias("error"))
        .where("error is not null")
        .unionByName(
            several.select(
                F.lit("points").alias("type"),
                col("p.topic").alias("topic"),
                F.lit("Topic is staged with different contents").alias("error"),
            )
        )
    )
    if absent is not None:
        report = report.unionByName(absent)
    return PromotionResult(live=upsert_unique(live, single, "p.topic"), report=report)


def _messages(value: Column, dtype: T.DataType) -> Column | None:
    """A section of a response as an array of (topic, error); None if it is no section."""

    def entry(topic: Column, error: Column) -> Column:
        return F.struct(topic.cast("string").alias("topic"), error.alias("error"))

    def text(item: Column, kind: T.DataType) -> Column:
        return F.to_json(item) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else item.cast("string")

    if isinstance(dtype, T.MapType):
        return F.transform(F.map_entries(value), lambda e: entry(e["key"], text(e["value"], dtype.valueType)))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: entry(F.lit(None), text(item, dtype.elementType)))
    if isinstance(dtype, T.StructType) and dtype.fields:
        # Read without a schema, an object's topics are fields, null where a response lacks them.
        parts = [entry(F.lit(f.name), text(value.getField(f.name), f.dataType)) for f in dtype.fields]
        return F.filter(F.array(*parts), lambda e: e["error"].isNotNull())
    return None


def melt_report(response: DataFrame, sections: Iterable[str] | None = None) -> DataFrame:
    """A nested response to rows (type, topic, error).

    A section is a column with messages by topic (a map, or an object whose
    fields are the topics) or with a plain list of messages, which have no topic;
    what is no text becomes JSON. All sections may also stand in one map or
    object named ``response``. Columns of single values, such as the building id,
    are no sections.
    """
    held = response.schema["response"].dataType if "response" in response.columns else None
    if isinstance(held, T.MapType) and isinstance(held.valueType, (T.MapType, T.ArrayType, T.StructType)):
        outer = response.select(F.explode("response").alias("type", "__section"))
        rows = outer.select("type", F.inline(_messages(F.col("__section"), held.valueType)))
    else:
        if isinstance(held, T.StructType):
            response = response.select("response.*")
        found = [(f.name, _messages(col(f.name), f.dataType)) for f in response.schema.fields]
        listed = [
            F.struct(F.lit(name).alias("type"), messages.alias("messages"))
            for name, messages in found
            if messages is not None
        ]
        if not listed:
            raise ValueError("the response has no section of messages")
        rows = response.select(F.inline(F.array(*listed))).select("type", F.inline("messages"))
    return rows if sections is None else rows.where(F.col("type").isin(list(sections)))


def promotion_errors(report: DataFrame) -> DataFrame:
    """Report rows (type, topic, error) that are worth a look."""
    worth = F.col("error").isNull() | ~F.col("error").rlike(BENIGN_MESSAGES)
    return report.where((F.col("type") != "building_id") & worth).select("type", "topic", "error")


def errors_by_section(errors: DataFrame) -> dict[str, DataFrame]:
    """Errors split into (topic, error) of points and equipment, and (error) of unexpected deletes."""
    return {
        section: errors.where(F.col("type") == section).select(
            *(["error"] if section == "unexpected_deletes" else ["topic", "error"])
        )
        for section in ERROR_SECTIONS
    }


#: Different messages that a row of a report by topic holds, about.
MESSAGES_A_ROW = 1000


def errors_by_topic(errors: DataFrame, messages_a_row: int = MESSAGES_A_ROW) -> DataFrame:
    """Report rows (type, topic, error) as (type, topic, part, messages, errors): lists of messages with their counts.

    A message repeated without end is counted before it is shuffled. The different messages of a topic are dealt to
    as many parts as they need, by a hash, and are sorted within a part; ``errors`` counts the rows of a part. So a
    topic with a third of all messages is no single row and no single task. Null topics are a topic, null errors a
    message.
    """
    each = errors.groupBy("type", "topic", "error").agg(F.count(F.lit(1)).alias("times"))
    bucket = spread(F.col("type"), F.col("topic")).alias("__bucket")
    many = each.groupBy("type", "topic", bucket).agg(F.count(F.lit(1)).alias("__messages")).where(F.col("__messages") > messages_a_row)
    many = many.select(F.col("type").alias("__type"), F.col("topic").alias("__topic"), F.ceil(F.col("__messages") / messages_a_row).alias("__parts"))
    same = F.col("type").eqNullSafe(F.col("__type")) & F.col("topic").eqNullSafe(F.col("__topic"))
    part = F.pmod(F.xxhash64("error"), F.coalesce("__parts", F.lit(1))).alias("part")
    dealt = each.join(many, same, "left").select("type", "topic", part, "error", "times")
    messages = F.sort_array(F.collect_list(F.struct("error", "times"))).alias("messages")
    return dealt.groupBy("type", "topic", "part").agg(messages, F.sum("times").alias("errors"))


@dataclass(frozen=True)
class LiveTables:
    """Live data after a withdrawal."""

    points: DataFrame
    equipment: DataFrame
    relationships: DataFrame | None


def withdrawal_pairs(rows: DataFrame) -> DataFrame:
    """The distinct (equipment_id, point_id) pairs listed, as far as these columns exist."""
    names = {"e.equipment_id": "equipment_id", "p.point_id": "point_id"}
    return rows.select(
        *[id_column(rows, name).alias(names[name]) for name in rows.columns if name in names]
    ).distinct()


def _without(df: DataFrame, column: str, pairs: DataFrame, listed: str) -> DataFrame:
    """Rows whose ``column`` is not among the ids in column ``listed`` of ``pairs``."""
    gone = distinct_keys(pairs.select(F.col(listed).alias("__gone")).where("__gone is not null"))
    return df.join(gone, id_column(df, column) == F.col("__gone"), "left_anti")


def unpromote(
    points: DataFrame,
    equipment: DataFrame,
    rows: DataFrame,
    unpromote_type: str = "points",
    relationships: DataFrame | None = None,
) -> LiveTables:
    """Withdraw listed points, or listed equipment, from the live tables.

    ``rows`` lists ``e.equipment_id`` and/or ``p.point_id``. ``"points"`` removes
    the listed points and keeps all equipment. ``"equipment"`` removes the listed
    equipment and, where points are listed, those too; further points of removed
    equipment stay. ``relationships`` (equipment_id, point_id) loses the listed
    pairs and every pair that names something removed.
    """
    if unpromote_type not in UNPROMOTE_TYPES:
        raise ValueError("unpromote_type must be 'points' or 'equipment'")
    pairs = withdrawal_pairs(rows)
    if unpromote_type == "points" and "point_id" not in pairs.columns:
        raise ValueError("withdrawing points needs a p.point_id column")
    if unpromote_type == "equipment" and "equipment_id" not in pairs.columns:
        raise ValueError("withdrawing equipment needs an e.equipment_id column")
    if "point_id" in pairs.columns:
        points = _without(points, "id", pairs, "point_id")
        if relationships is not None:
            relationships = _without(relationships, "point_id", pairs, "point_id")
    if unpromote_type == "equipment":
        equipment = _without(equipment, "id", pairs, "equipment_id")
        if relationships is not None:
            relationships = _without(relationships, "equipment_id", pairs, "equipment_id")
    return LiveTables(points, equipment, relationships)
