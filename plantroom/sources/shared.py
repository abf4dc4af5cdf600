"""Tables that several jobs read, kept where every executor can read them."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote, urlsplit

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a file or folder, and its path there, for tasks that read or write files themselves."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, the context's, or one below the warehouse, which is shared."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/plantroom-shared"
    return found.rstrip("/")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table to a new path in the shared folder and read it back: the lineage ends there.

    Every call writes to a path of its own, so a repeated job never reads another one's rows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/plantroom-{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
