"""Raw landing and JSON payload access (X-13, X-11)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from lotline.session import cut_lineage
from lotline.sources.lakehouse import read_table, table_exists, write_table


def land_raw(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json",
             as_of=None, **options) -> DataFrame:
    """Read raw files with an explicit schema (no inference) and stamp the
    ingestion time and source file."""
    r = spark.read.schema(schema).format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return r.load(path).withColumn("ingested_at", ts).withColumn("source_file", F.input_file_name())


def explode_payload(raw: DataFrame, json_col: str, schema: StructType | str, array_col: str | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a JSON string column with a fixed schema; optionally explode an
    array field (``explode_outer`` keeps rows with an empty or null array)."""
    parsed = raw.select(*keep, F.from_json(F.col(json_col), schema).alias("_p")).select(*keep, "_p.*")
    if array_col:
        others = [c for c in parsed.columns if c != array_col]
        parsed = parsed.select(*others, F.explode_outer(array_col).alias(array_col))
    return parsed


def land_files(spark: SparkSession, source: str, root: str, table: str, schema: StructType | str, as_of=None) -> int:
    """Land the JSON-lines files under ``source`` that have not been landed yet; returns how many files.

    Three bronze tables under ``root``: ``table`` (the records, with
    ``ingested_at``, ``source_file`` and ``extra``), ``table``_rejected (the
    text of lines that are no JSON object or hold a value of another type
    than ``schema``, with the reason), and ``table``_files.  Files that were
    landed, by path, length and time of change, are met by an anti-join and
    not read again, so landing twice adds nothing; a file that has changed
    lands as a whole once more.  Fields that ``schema`` does not name are kept
    as text in ``extra``, missing ones are null, so files of several schemas
    land in one table.

    The files table is written last and is what commits a batch: readers
    (``read_landed``) take only rows of batches that stand there, so a landing
    that broke off leaves nothing behind and can be repeated.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    found = found.select("path", "length", F.col("modificationTime").alias("modified"))
    if table_exists(spark, root, "bronze", f"{table}_files"):
        known = read_table(spark, root, "bronze", f"{table}_files")
        found = found.join(known, ["path", "length", "modified"], "left_anti")
    paths = [r["path"] for r in found.select("path").collect()]  # the driver lists files in any case
    if not paths:
        return 0
    batch = uuid.uuid4().hex
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    lines = spark.read.text(paths).filter(F.length(F.trim("value")) > 0).select("value", F.col("_metadata.file_path").alias("source_file"))
    declared = _fields(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in declared])
    parsed = cut_lineage(lines.select("*", F.from_json("value", "map<string,string>").alias("_map"), F.from_json("value", text).alias("_text"),
                                      F.from_json("value", declared.add("_corrupt", "string"), {"columnNameOfCorruptRecord": "_corrupt"}).alias("_record")))
    names = [f.name for f in declared if f.name != "_corrupt"]
    broken = F.col("_map").isNull()
    # a value that its declared type does not hold comes out as null though the text has one
    wrong = F.array_compact(F.array(*[F.when(F.col(f"_record.`{c}`").isNull() & F.col(f"_text.`{c}`").isNotNull(), F.lit(c)) for c in names]))
    reason = F.when(broken, F.lit("malformed")).when(F.size(wrong) > 0, F.concat(F.lit("type:"), F.array_join(wrong, ",")))
    judged = parsed.withColumn("reason", reason)
    extra = F.map_filter("_map", lambda k, _: ~k.isin(*names))
    good = judged.filter("reason is null").select("_record.*", F.when(F.size(extra) > 0, extra).alias("extra"), ts.alias("ingested_at"), "source_file", F.lit(batch).alias("batch"))
    write_table(good.drop("_corrupt"), root, "bronze", table, mode="append")
    write_table(judged.filter("reason is not null").select(F.col("value").alias("record"), "reason", ts.alias("ingested_at"), "source_file", F.lit(batch).alias("batch")),
                root, "bronze", f"{table}_rejected", mode="append")
    write_table(found.withColumn("batch", F.lit(batch)), root, "bronze", f"{table}_files", mode="append")
    return len(paths)


def read_landed(spark: SparkSession, root: str, table: str, rejected: bool = False) -> DataFrame:
    """Records (or rejected lines) of all committed batches."""
    rows = read_table(spark, root, "bronze", f"{table}_rejected" if rejected else table)
    batches = read_table(spark, root, "bronze", f"{table}_files").select("batch").distinct()
    return rows.join(batches, "batch", "left_semi").drop("batch")


def _fields(schema: StructType | str) -> StructType:
    return StructType(list(schema.fields)) if isinstance(schema, StructType) else StructType.fromDDL(schema)
