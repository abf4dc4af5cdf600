"""CSV batches meant for the staging area."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import col
from plantroom.sources.csv_records import csv_records
from plantroom.sources.shared import stored

#: Column that holds the text of a record that does not parse.
BAD_RECORD = "__bad_record"

#: Quotes inside a quoted field are doubled, as spreadsheets and R write them.
DIALECT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}


@dataclass(frozen=True)
class CsvRows:
    """Parsed records with the text of those that do not parse in ``BAD_RECORD``."""

    parsed: DataFrame

    @property
    def _names(self) -> list[str]:
        return [name for name in self.parsed.columns if name != BAD_RECORD]

    @property
    def rows(self) -> DataFrame:
        """Records that parse."""
        return self.parsed.where(F.col(BAD_RECORD).isNull()).select([col(name) for name in self._names])

    @property
    def refused(self) -> DataFrame:
        """Records that do not, as far as they were read, with an ``error``."""
        message = F.concat(F.lit("does not parse: "), F.rtrim(F.col(BAD_RECORD), F.lit("\r\n")))
        bad = self.parsed.where(F.col(BAD_RECORD).isNotNull())
        return bad.select(*[col(name) for name in self._names], message.alias("error"))

    def kept(self) -> CsvRows:
        """The same, parsed in one job and stored in the shared folder; an upload reads them several times."""
        return CsvRows(stored(self.parsed, "csv"))


def read_upload_csv(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = True) -> CsvRows:
    """CSV files with a header row. The schema is required, so no inference pass runs.

    Records with too few or too many fields, or with text in a number's place, are refused, not read as nulls.
    With ``multiline`` a quoted field may hold line breaks (:func:`csv_records`); without, every line is a record.
    Files are split either way.
    """
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if multiline:
        return parse_upload_csv(csv_records(spark, path, typed.names), "record", typed)
    full = T.StructType([*typed.fields, T.StructField(BAD_RECORD, T.StringType())])
    reader = spark.read.options(**DIALECT).option("header", True).option("enforceSchema", False)
    # Without pruning every record is checked whole, whichever columns are asked for later; the condition, which
    # always holds, asks for all.
    parsed = reader.option("columnPruning", False).schema(full).csv(path)
    return CsvRows(parsed.where(F.length(F.concat_ws("", *[col(name).cast("string") for name in typed.names])) >= 0))


def parse_upload_csv(df: DataFrame, line: str, schema: T.StructType | str) -> CsvRows:
    """CSV records already in column ``line``, without header."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields
    )
    record = F.from_csv(col(line), F.lit(f"{ddl}, `{BAD_RECORD}` string"), {**DIALECT, "multiLine": "true"})
    # Exploded from a list of one, a record is parsed once, however many columns and conditions are read from it.
    return CsvRows(df.select(F.explode(F.array(record)).alias("__row")).select("__row.*"))
