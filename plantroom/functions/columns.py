"""Column-name algebra, id filters and the skew-tolerant full join.

Everything that only touches names runs on the driver against ``df.columns`` and
starts no job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Id lists up to this length become an ``IN`` predicate, which reaches the
#: Parquet scan. Longer ones become a semi-join whose strategy Spark picks by size.
INLINE_ID_LIMIT = 1000


def col(name: str) -> Column:
    """Column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def argument_table(spark: SparkSession, columns: Mapping[str, tuple[pa.DataType, Iterable]]) -> DataFrame:
    """Arguments the caller typed, as a table.

    Handed over as Arrow, they become a local relation: no Python worker runs and
    the planner knows their size, which decides how they are joined.
    """
    return spark.createDataFrame(pa.table({name: pa.array(list(v), t) for name, (t, v) in columns.items()}))


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s): {', '.join(missing)}")


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + name for name in df.columns])


def drop_matching(df: DataFrame, pattern: str, ignore_case: bool = False) -> DataFrame:
    """Drop every column whose name contains a match of ``pattern``."""
    regex = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return df.select([col(name) for name in df.columns if not regex.search(name)])


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in code-point order of their names."""
    return df.select([col(name) for name in sorted(df.columns)])


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs become dotted columns at any depth; arrays and maps stay."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    paths = list(leaves(df.schema, ()))
    names = [".".join(path) for path in paths]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"flattening would repeat column(s): {', '.join(repeated)}")

    def at(path: tuple[str, ...]) -> Column:
        value = col(path[0])
        for part in path[1:]:
            value = value.getField(part)
        return value

    return df.select([at(path).alias(name) for path, name in zip(paths, names)])


def list_to_text(value: Column, dtype: T.DataType, separator: str = ", ") -> Column:
    """An array column as one text; missing elements read ``NA``, no elements read ``''``."""
    while isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ArrayType):
        value, dtype = F.flatten(value), dtype.elementType
    if isinstance(dtype.elementType, (T.StructType, T.MapType)):
        value = F.transform(value, lambda item: F.to_json(item))
    return F.coalesce(F.array_join(value.cast("array<string>"), separator, "NA"), F.lit(""))


def columns_to_text(df: DataFrame) -> DataFrame:
    """Every column as text: list columns joined with ``", "``, all others cast."""
    return df.select(
        [
            (
                list_to_text(col(field.name), field.dataType)
                if isinstance(field.dataType, T.ArrayType)
                else col(field.name).cast("string")
            ).alias(field.name)
            for field in df.schema.fields
        ]
    )


def whole_number(value: Column) -> Column:
    """Whole number or null; junk text never raises."""
    return value.try_cast("decimal(38,6)").try_cast("bigint")


def id_column(df: DataFrame, name: str) -> Column:
    """A column of ids as whole numbers; integer columns stay visible to the scan."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return col(name).cast("bigint")
    return whole_number(col(name))


def valid_ids(ids: Iterable) -> list[int]:
    """The entries of a Python list that are whole-number ids of 64 bits, each once."""
    found: dict[int, None] = {}
    for value in ids:
        try:
            number = int(Decimal(str(value)))
        except (ArithmeticError, ValueError):
            continue
        if abs(number) < 2**63:
            found[number] = None
    return list(found)


def spread(*keys: Column) -> Column:
    """A bucket number that follows from ``keys``, to be grouped by along with them.

    It changes no group. But rows grouped by their keys alone come out
    partitioned by them, a join on these keys takes them as they are, and
    adaptive execution only splits hot keys of joins that shuffle both sides.
    Grouped like this, the few grouped rows are shuffled once more and the hot
    key on the other side can be split.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(64))


def distinct_keys(df: DataFrame) -> DataFrame:
    """``df.distinct()`` for the right side of a join on all its columns."""
    bucket = spread(*[col(name) for name in df.columns]).alias("__bucket")
    return df.select("*", bucket).distinct().drop("__bucket")


def filter_by_ids(
    df: DataFrame,
    column: str,
    ids: Iterable | DataFrame | int | str | None,
    if_no_valid_id: str = "empty",
) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``ids``.

    ``None`` means no filter. ``ids`` is one id, a Python collection or a
    one-column DataFrame of any size. Entries that are not whole numbers are
    ignored; when nothing valid remains the result is empty, or everything with
    ``if_no_valid_id="all"``. Repeated ids never repeat rows.
    """
    if if_no_valid_id not in ("empty", "all"):
        raise ValueError("if_no_valid_id must be 'empty' or 'all'")
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        # Made distinct first: an id listed millions of times would burden one task of the join.
        wanted = ids.select(id_column(ids, ids.columns[0]).alias("__wanted")).where("__wanted is not null")
        if if_no_valid_id == "all" and wanted.isEmpty():
            return df
        return df.join(distinct_keys(wanted), col(column) == F.col("__wanted"), "left_semi")
    wanted_list = valid_ids([ids] if isinstance(ids, (int, str)) else ids)
    if not wanted_list:
        return df if if_no_valid_id == "all" else df.where(F.lit(False))
    if len(wanted_list) <= INLINE_ID_LIMIT:
        return df.where(col(column).isin(wanted_list))
    wanted = argument_table(df.sparkSession, {"__wanted": (pa.int64(), wanted_list)})
    return df.join(wanted, col(column) == F.col("__wanted"), "left_semi")


def inline_if_few(ids: DataFrame) -> list[int] | DataFrame:
    """A one-column table of ids as a Python list if it is short, else unchanged.

    At most ``INLINE_ID_LIMIT + 1`` ids are fetched to find out. A list filters
    the scans themselves and prunes partitions, which a join cannot always do.
    """
    head = ids.distinct().limit(INLINE_ID_LIMIT + 1).collect()
    return ids if len(head) > INLINE_ID_LIMIT else [row[0] for row in head]


def unmatched(right: DataFrame, right_key: str, left_keys: DataFrame) -> DataFrame:
    """Rows of ``right`` whose key, null included, is not among ``left_keys`` (one column)."""
    keys = distinct_keys(left_keys.select(col(left_keys.columns[0]).alias("__left_key")))
    return right.join(keys, col(right_key).eqNullSafe(F.col("__left_key")), "left_anti")


def likely_small(df: DataFrame, times: int = 1) -> bool:
    """Whether ``times`` the bytes that Spark's statistics give ``df`` stay within its broadcast threshold. No job."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size * times <= threshold


def full_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_keys: DataFrame | None = None,
    broadcast_right: bool = False,
) -> DataFrame:
    """Full outer join in which null matches null and the left key column survives.

    Written as (left rows with their match) + (right rows nobody asked for). A
    full outer merge join can neither broadcast a small side nor have a hot key
    split, so one key holding a third of the left rows, null included, would end
    in one task. The left join can do both, and the second half only needs the
    distinct left keys, which collapse before they are shuffled.

    Column names of the two sides must not overlap. ``left_keys`` may supply all
    values of ``left_key`` where they are cheaper to get than from ``left``.
    ``broadcast_right`` is for a right side that was found small (:func:`likely_small`)
    but that Spark overestimates, as it does with the result of a join.
    """
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"both sides have column(s): {', '.join(sorted(overlap))}")
    looked_up = F.broadcast(right) if broadcast_right else right
    matched = left.join(looked_up, col(left_key).eqNullSafe(col(right_key)), "left").drop(col(right_key))
    right_only = unmatched(right, right_key, left.select(col(left_key)) if left_keys is None else left_keys)
    return matched.unionByName(right_only.withColumnRenamed(right_key, left_key), allowMissingColumns=True)
