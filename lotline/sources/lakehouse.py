"""Layered tables on a root folder (S-1 ... S-13).

A table is addressed by (layer, name) and stored as Parquet under
``{root}/{layer}/{name}``.  Parquet has no MERGE/UPDATE and a job may not
overwrite the path it reads from, so DML results are written as a new
*version* folder and a one-line pointer switches readers to it
(``write_version`` / ``read_table``).  The format is a parameter, so Delta
can be used where it is installed.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

POINTER = "_current"


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def _last(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number and version folder that the last pointer names, or (0, None) for a plain table.

    Pointers are numbered files that are added, never replaced, so a reader
    sees either the old or the new one.  Only a missing pointer folder means a
    plain table; any other failure to read it is an error.
    """
    try:
        pointers = spark.read.schema("n long, version string").json(f"{path}/{POINTER}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return 0, None
        raise
    last = pointers.agg(F.max(F.struct("n", "version")).alias("last")).first()["last"]  # one short line per rewrite
    if last and (last["n"] is None or last["version"] is None):
        raise ValueError(f"{path} has a pointer that names no version")
    return (last["n"], last["version"]) if last else (0, None)


def _current_version(spark: SparkSession, path: str) -> str | None:
    return _last(spark, path)[1]


def read_table(spark: SparkSession, root: str, layer: str, table: str, fmt: str = "parquet") -> DataFrame:
    path = table_path(root, layer, table)
    version = _current_version(spark, path)
    return spark.read.format(fmt).load(f"{path}/{version}" if version else path)


def read_version(spark: SparkSession, root: str, layer: str, table: str, number: int, fmt: str = "parquet") -> DataFrame:
    """A versioned table as it was at version ``number``."""
    path = table_path(root, layer, table)
    pointers = spark.read.schema("n long, version string").json(f"{path}/{POINTER}")
    found = pointers.filter(F.col("n") == number).collect()  # one short line
    if len(found) != 1:
        raise ValueError(f"{path} has no version {number}")
    return spark.read.format(fmt).load(f"{path}/{found[0]['version']}")


def table_exists(spark: SparkSession, root: str, layer: str, table: str) -> bool:
    """False only if the table's folder is not there."""
    try:
        read_table(spark, root, layer, table)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise


def write_table(df: DataFrame, root: str, layer: str, table: str, mode: str = "overwrite",
                fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Overwrite or append a table by path (S-10, S-11).

    A versioned table is appended to in its current version's folder, and
    overwritten by a new version.
    """
    path = table_path(root, layer, table)
    version = _current_version(df.sparkSession, path)
    if version and mode == "overwrite":
        return write_version(df, root, layer, table, fmt, partition_by)
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    path = f"{path}/{version}" if version else path
    w.save(path)
    return path


def write_version(df: DataFrame, root: str, layer: str, table: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                  based_on: int | None = None) -> str:
    """Write a new table state (the result of a MERGE/UPDATE rewrite) to a
    fresh version folder, then point readers at it.  ``df`` may read the
    current version: no folder is ever overwritten.

    ``based_on`` is the number of the version that ``df`` was made from
    (``version_number``; by default the current one when writing begins).  If
    another writer has added the next number meanwhile, ``ConcurrentRewrite``
    is raised, readers keep the other one's version, and the caller makes
    ``df`` again from it.
    """
    spark = df.sparkSession
    path = table_path(root, layer, table)
    number = (version_number(spark, root, layer, table) if based_on is None else based_on) + 1
    version = f"v-{uuid.uuid4().hex[:12]}"
    w = df.write.format(fmt).mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).save(f"{path}/{version}")
    _add_pointer(spark, f"{path}/{POINTER}", number, version)
    return f"{path}/{version}"


class ConcurrentRewrite(RuntimeError):
    """Another writer has rewritten the table since it was read."""


def version_number(spark: SparkSession, root: str, layer: str, table: str) -> int:
    """Number of a table's current version (0: a plain table, or none)."""
    return _last(spark, table_path(root, layer, table))[0]


def _add_pointer(spark: SparkSession, folder: str, number: int, version: str) -> None:
    """One short file named by its number.  Creating it fails if it is there, which the file system decides for all writers."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}.json")
    try:
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, False)
    except Exception as e:
        if "AlreadyExists" in str(e):
            raise ConcurrentRewrite(f"version {number} of {folder.rsplit('/', 1)[0]} has been written by another") from e
        raise
    out.write(bytearray(json.dumps({"n": number, "version": version}).encode()))
    out.close()


def read_like(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Read files with another table's schema (S-6)."""
    return spark.read.schema(like.schema).format(fmt).load(path)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """A table by its catalog name (S-3)."""
    return spark.table(name)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
                  path: str | None = None) -> None:
    """Overwrite a catalog table by name (S-12); ``path`` makes it an
    external table stored there instead of under the warehouse folder."""
    w = df.write.format(fmt).mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """A catalog table in ``buckets`` files by ``key``, sorted by it (S-12): tables bucketed alike join and aggregate by
    the key without a shuffle (J-4, J-13).  Rows are dealt by the same hash first, so each bucket is one file."""
    w = df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (w.option("path", path) if path else w).saveAsTable(name)


def overwrite_partitions(df: DataFrame, root: str, layer: str, table: str, partition_by: list[str], fmt: str = "parquet") -> str:
    """Replace the partitions that ``df`` has rows of, and leave all others as they are (S-10).

    For tables partitioned by a date key: a late day is rewritten alone.  In a
    versioned table it is the current version's folder.
    """
    path = table_path(root, layer, table)
    version = _current_version(df.sparkSession, path)
    path = f"{path}/{version}" if version else path
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
    return path


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def create_namespace(spark: SparkSession, name: str) -> None:
    """CREATE DATABASE IF NOT EXISTS (S-13)."""
    if not _IDENT.match(name):
        raise ValueError(f"bad namespace name: {name!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def scalar_or_default(df: DataFrame, expr, default, alias: str = "value") -> DataFrame:
    """One-row DataFrame with an aggregate and a default (S-8, S-9), kept in
    the plan (use ``.scalar()`` on it) instead of collected."""
    return df.agg(F.coalesce(expr, F.lit(default)).alias(alias))
