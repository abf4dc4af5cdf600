"""JSON in and out: wrapped record lists, nested objects, row payloads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import col, flatten


def unwrap(df: DataFrame, field: str) -> DataFrame:
    """Records held in the array column ``field``, one row each.

    Anything but an array of objects is refused: it has no table form.
    """
    dtype = df.schema[field].dataType if field in df.columns else None
    if not (isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)):
        raise ValueError(f"'{field}' is not a list of objects and cannot become a table")
    return df.select(F.inline(col(field)))


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    wrapper: str | None = None,
    multiline: bool = False,
    flat: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """JSON files as a table.

    ``wrapper`` names the field that holds the records, if there is one. Objects
    become dotted columns unless ``flat`` is false; arrays stay arrays. Pass a
    ``schema`` for large inputs, otherwise Spark reads everything once to infer
    it. ``multiline`` is for files that are one document, which cannot be split.
    A document that does not parse ends the job; ``mode="PERMISSIVE"`` makes it a
    row of nulls instead.
    """
    reader = spark.read.option("multiLine", multiline).option("mode", mode)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    if wrapper is not None:
        df = unwrap(df, wrapper)
    return flatten(df) if flat else df


def parse_json(
    df: DataFrame, text: str, schema: T.StructType | str, flat: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """Like :func:`read_json` for JSON texts already in column ``text``.

    With ``mode="PERMISSIVE"``, :func:`unparsed_json` tells which texts became nulls.
    """
    parsed = df.select(F.from_json(col(text), schema, {"mode": mode}).alias("__row")).select("__row.*")
    return flatten(parsed) if flat else parsed


def unparsed_json(df: DataFrame, text: str, schema: T.StructType | str) -> DataFrame:
    """The rows of ``df`` whose ``text`` does not parse; a null text is no document and none of them."""
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*typed.fields, T.StructField("__bad", T.StringType())])
    parsed = F.from_json(col(text), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    return df.where(parsed.getField("__bad").isNotNull())


def rows_to_json(df: DataFrame, name: str = "payload") -> DataFrame:
    """One JSON object per row; null fields are left out."""
    return df.select(F.to_json(F.struct(*[col(c) for c in df.columns])).alias(name))


def _plain_type(dtype: T.DataType) -> T.DataType | None:
    """The column type for what was seen in JSON; None if there is nothing to hold."""
    if isinstance(dtype, T.StructType):
        fields = [(f.name, _plain_type(f.dataType)) for f in dtype.fields]
        held = [T.StructField(name, kind) for name, kind in fields if kind is not None]
        return T.StructType(held) if held else None
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain_type(dtype.elementType) or T.StringType())
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType()
    # values of several types, and nulls only, are text
    return T.StringType() if isinstance(dtype, (T.VariantType, T.NullType)) else dtype


def variant_schema(df: DataFrame, variant: str) -> T.StructType:
    """The columns of JSON objects held in a ``variant`` column, found in one pass that combines what each task saw.

    Fields that any object has are there; fractions are doubles; a field with values of several types, or with objects
    here and single values there, is text.
    """
    seen = df.agg(F.schema_of_variant_agg(col(variant))).first()[0]
    # objects are written as OBJECT<...>; quoted field names are left alone
    parts = re.split(r"(`(?:[^`]|``)*`)", seen)
    ddl = "".join(part if part.startswith("`") else part.replace("OBJECT<", "STRUCT<") for part in parts)
    dtype = T.DataType.fromDDL(ddl)
    if isinstance(dtype, T.NullType):
        return T.StructType([])
    if not isinstance(dtype, T.StructType):
        raise ValueError(f"JSON documents that are {seen} are no objects and cannot become a table")
    return _plain_type(dtype) or T.StructType([])


def flatten_json(
    df: DataFrame, text: str, schema: T.StructType | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """JSON objects of unknown and differing shape, in column ``text``, as a table with dotted columns.

    Each document becomes a variant, so no schema has to fit all of them beforehand; without ``schema``
    :func:`variant_schema` looks at all once. A field a document lacks is null. A document that does not parse ends
    the job, or with ``mode="PERMISSIVE"`` is a row of nulls, as a null text is.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError("mode must be 'FAILFAST' or 'PERMISSIVE'")
    parse = F.parse_json if mode == "FAILFAST" else F.try_parse_json
    variants = df.select(parse(col(text)).alias("__variant"))
    found = variant_schema(variants, "__variant") if schema is None else schema
    if not found.fields:
        return variants.select()
    return flatten(variants.select(F.col("__variant").cast(found).alias("__row")).select("__row.*"))
