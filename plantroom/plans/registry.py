"""Registered queries: an operator run over the fixture views, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from plantroom.functions.columns import col
from plantroom.plans.fixtures import Fixtures


@dataclass(frozen=True)
class Query:
    run: Callable[[Fixtures], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a function of the fixtures under its own name."""

    def register(run: Callable[[Fixtures], DataFrame]):
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(run, oracle)
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Underscores instead of dots in column names, timestamps without zone."""
    return df.select(
        [
            (col(name).cast("timestamp_ntz") if dtype == "timestamp" else col(name)).alias(name.replace(".", "_"))
            for name, dtype in df.dtypes
        ]
    )
