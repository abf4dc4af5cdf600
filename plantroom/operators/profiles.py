"""What wide tables need to know of stored readings, found out while they are stored."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantroom.functions.columns import argument_table, col, require_columns
from plantroom.operators.timeseries import MISSING_TEXT, first_fit, type_profile

VALUE_COLUMNS = ("raw", "unit")
KINDS = ("boolean", "int", "double")


@dataclass(frozen=True)
class Profile:
    """The names in a column of stored readings, and which types the texts of each name fit.

    ``fits`` has an entry for each value column that holds texts: a mapping of names to the kinds all their texts fit.
    """

    names_from: str
    names: tuple[str, ...]
    fits: Mapping[str, Mapping[str, frozenset[str]]]

    def value_type(self, value_column: str, columns: Iterable[str]) -> str | None:
        """The first of boolean, int, double, string that all texts of these names fit; None for typed values."""
        if value_column not in self.fits:
            return None
        found = [self.fits[value_column].get(name, frozenset(KINDS)) for name in columns]
        return first_fit([{kind: kind in fit for kind in KINDS} for fit in found])


def _plain(readings: DataFrame, path: str) -> None:
    readings.write.mode("errorifexists").parquet(path)


def write_profiled(
    readings: DataFrame,
    path: str,
    names_from: str = "display",
    write: Callable[[DataFrame, str], None] = _plain,
) -> Profile:
    """Write readings to a new path and take their profile in the same pass; it is kept beside them.

    ``write`` may be :func:`plantroom.sources.layout.write_readings`. The profile is an observation of the rows on their
    way to the files: a set of (name, what its text fits) of each value column, at most five entries a name. Such
    sets are the same however often a row is seen, so repeated tasks and stages do not change them. Names pass
    through the driver, as for every wide table. A null name reads ``NA``. An empty table has no names, and its texts
    would be booleans, as all types fit no text.
    """
    present = [name for name in VALUE_COLUMNS if name in readings.columns]
    require_columns(readings, [names_from], "readings")
    name = F.coalesce(col(names_from).cast("string"), F.lit(MISSING_TEXT)).alias("name")
    texts = [column for column in present if isinstance(readings.schema[column].dataType, T.StringType)]
    metrics = [F.collect_set(name).alias("names")]
    for column in texts:
        flags = [fit.alias(kind) for kind, fit in type_profile(col(column), whole=False).items()]
        metrics.append(F.collect_set(F.struct(name, *flags)).alias(column))
    seen = Observation()
    write(readings.observe(seen, *metrics), path)
    found = seen.get
    fits: dict[str, dict[str, frozenset[str]]] = {column: {} for column in texts}
    for column in texts:
        for entry in found[column]:
            # a missing text fits everything
            fit = frozenset(kind for kind in KINDS if entry[kind] is not False)
            fits[column][entry["name"]] = fits[column].get(entry["name"], fit) & fit
    profile = Profile(names_from, tuple(sorted(found["names"])), fits)
    _keep(readings.sparkSession, path, profile)
    return profile


def _beside(path: str) -> str:
    return path.rstrip("/") + "-profile"


def _keep(spark: SparkSession, path: str, profile: Profile) -> None:
    """One row for each name and value column; a row without column names the profile's own."""
    rows = [(None, profile.names_from, None)]
    rows += [("", name, None) for name in profile.names]
    rows += [(column, name, sorted(kinds)) for column, fits in profile.fits.items() for name, kinds in fits.items()]
    # A text column without any reading is still a text column.
    rows += [(column, None, None) for column in profile.fits]
    columns = {
        "value_column": (pa.string(), [row[0] for row in rows]),
        "name": (pa.string(), [row[1] for row in rows]),
        "fits": (pa.list_(pa.string()), [row[2] for row in rows]),
    }
    argument_table(spark, columns).coalesce(1).write.mode("errorifexists").parquet(_beside(path))


def read_profile(spark: SparkSession, path: str) -> Profile:
    """The profile of readings that :func:`write_profiled` wrote to ``path``."""
    rows = spark.read.schema("value_column string, name string, fits array<string>").parquet(_beside(path)).collect()
    fits: dict[str, dict[str, frozenset[str]]] = {r.value_column: {} for r in rows if r.value_column}
    for row in rows:
        if row.value_column and row.name is not None:
            fits[row.value_column][row.name] = frozenset(row.fits)
    names_from = next(row.name for row in rows if row.value_column is None)
    return Profile(names_from, tuple(sorted(row.name for row in rows if row.value_column == "")), fits)
