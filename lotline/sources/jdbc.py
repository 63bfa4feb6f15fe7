"""Relational export (S-14).

Tables are appended in a foreign-key-safe order; each table is written by
the executors in parallel (``numPartitions`` connections), nothing passes
through the driver.  URL and credentials come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

# Fixed value: the reference's export order (parents before children).
TABLES_IN_ORDER = (
    "branch", "data_source", "auction_house", "vendor", "part",
    "inspection_checklist_item", "staff", "staff_role", "vehicle",
    "purchase", "shipment", "port_arrival", "pickup", "office_intake",
    "inspection", "inspection_result", "damage_item", "repair_job",
    "repair_job_damage", "repair_job_part", "cleaning_task", "listing",
    "customer", "sale", "payment", "vehicle_stage_history",
)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "append", num_partitions: int | None = None, batch_size: int = 10000) -> None:
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def export_tables(tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str] | None = None,
                  order: Sequence[str] = TABLES_IN_ORDER, mode: str = "append",
                  num_partitions: int | None = None) -> list[str]:
    """Append every table present in ``tables`` following ``order``; returns
    the names written."""
    written = []
    for name in order:
        if name in tables:
            write_jdbc(tables[name], url, name, properties, mode, num_partitions)
            written.append(name)
    return written
