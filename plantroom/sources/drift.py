"""Parquet files whose columns differ in name and in type, as one table."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import col
from plantroom.sources.shared import file_system

#: Number types, each of which holds all before it; decimals stand between whole numbers and fractions.
WHOLE_NUMBERS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONS = (T.FloatType, T.DoubleType)
#: Digits that whole numbers need.
DIGITS = {T.BooleanType: 1, T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}

TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds values of both: numbers widen, days become times, all else becomes text.

    Objects are merged by field, lists by element.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, common_type(a.valueType, b.valueType))
    for kinds in (WHOLE_NUMBERS, TIMES):
        if type(a) in kinds and type(b) in kinds:
            return max((a, b), key=lambda t: kinds.index(type(t)))
    numbers = (*WHOLE_NUMBERS, *FRACTIONS, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return _decimal(a, b) if not isinstance(a, FRACTIONS) and not isinstance(b, FRACTIONS) else T.DoubleType()
    return T.StringType()


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    """A decimal with the places of both, or a double where that is too long."""
    sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[type(t)], 0) for t in (a, b)]
    whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def _merged(schemas: list[T.StructType]) -> T.StructType:
    """All fields, in the order they first appear, with the types that hold all."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            types[field.name] = common_type(types[field.name], field.dataType) if field.name in types else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def converted(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value as the wider type; what has parts becomes JSON where it has to be text."""
    if old == new:
        return value
    if isinstance(new, T.StructType):
        had = {f.name: f.dataType for f in old.fields}
        parts = [
            (converted(value.getField(f.name), had[f.name], f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(new, T.ArrayType) and isinstance(old, T.ArrayType):
        return F.transform(value, lambda x: converted(x, old.elementType, new.elementType))
    if isinstance(new, T.MapType) and isinstance(old, T.MapType):
        return F.transform_values(value, lambda _, x: converted(x, old.valueType, new.valueType))
    if isinstance(new, T.StringType) and isinstance(old, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(new)


def as_one(tables: list[DataFrame]) -> DataFrame:
    """All rows, columns united by name, each with the least type that holds its values everywhere."""
    whole = _merged([df.schema for df in tables])
    parts = []
    for df in tables:
        types = {f.name: f.dataType for f in df.schema.fields}
        parts.append(df.select([converted(col(f.name), types[f.name], f.dataType).alias(f.name) for f in whole.fields if f.name in types]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select([col(f.name) for f in whole.fields])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, kinds = batch.column("path").to_pylist(), []
        for path in paths:
            store, place = file_system(path)
            with store.open_input_file(place) as file:
                schema = pq.ParquetFile(file).schema_arrow
            # names and types, without the statistics and notes that differ from file to file
            kinds.append(schema.remove_metadata().to_string(show_field_metadata=False))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(kinds, pa.string())], names=["path", "kind"])


def file_kinds(spark: SparkSession, path: str) -> list[list[str]]:
    """The files at ``path``, those of one schema together; their footers are read in tasks."""
    # a listing: contents that are not asked for are not read
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    kinds: dict[str, list[str]] = {}
    for row in listed.mapInArrow(_footers, "path string, kind string").collect():
        kinds.setdefault(row["kind"], []).append(row["path"])
    return [sorted(files) for _, files in sorted(kinds.items())]


def read_drifting(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files as one table, whatever their columns.

    Where names differ only, Spark merges them. Where a column's type differs, files of one schema are a scan each,
    cast and united, so that filters still reach every scan; the driver holds the files' names, as it does for any scan.
    """
    merging = spark.read.option("mergeSchema", True)
    try:
        return merging.parquet(path)
    except Exception as error:
        if "CANNOT_MERGE_SCHEMA" not in str(error):
            raise
    groups = file_kinds(spark, path)
    return as_one([spark.read.option("basePath", path).parquet(*[unquote(f) for f in files]) for files in groups])
