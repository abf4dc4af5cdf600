"""Tables that several jobs read, and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from plantroom.sources.shared import shared_folder, stored

__all__ = ["partitions", "sampled", "shared_folder", "stored"]


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session, for explicit repartitioning."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sampled(rows: int, wanted: int, *key: str) -> Column:
    """Holds for about twice as many of `rows` rows as are wanted, chosen by a hash of a key.

    Put before an exact choice of the smallest hashes, so that no task offers more rows than are needed in all.
    """
    share = min(1.0, 2.0 * (wanted + 50) / max(1, rows))
    return F.pmod(F.xxhash64(*key), F.lit(1 << 40)) <= F.lit(int(share * (1 << 40)))
