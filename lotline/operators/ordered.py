"""Scans along a total order, without a window by key.

``ranged`` deals rows by ranges of the whole order and writes them; what a range
hands on to the following ones (its last value, its last group's sum) is a row
or two per range.  So a key with a third of all rows spreads over many tasks,
and every pass sees the same rows, also after an executor loss.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    import pyarrow as pa

from lotline.session import cut_lineage


def ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df``, written in ranges of ``order`` (ascending, nulls first), with ``_range`` and the place ``_at`` inside it.

    Spark samples the boundaries, so outliers and hot leading values do not
    matter as long as the whole order is selective.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _cut(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order))


def _cut(dealt: DataFrame) -> DataFrame:
    # the identifier counts a partition's rows in their order, the partition's number above them
    cut = cut_lineage(dealt.withColumn("_id", F.monotonically_increasing_id()))
    return cut.select(*dealt.columns, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))


def neighbours(df: DataFrame, order: Sequence[str], prev: Sequence[str] = (), nxt: Sequence[str] = ()) -> DataFrame:
    """``ranged``, with the structs ``_prev`` and ``_next`` of the previous and next row inside the range.

    They are null where asked for nothing and at a range's edges.  A range's
    sorted rows stream by once, before they are written, so its neighbours need
    no window over the written table, which would deal and sort all rows again.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    beside = [("_prev", list(prev)), ("_next", list(nxt))]
    shape = T.StructType(list(df.schema) + [
        T.StructField(side, T.StructType([T.StructField(c, df.schema[c].dataType) for c in cols])) for side, cols in beside if cols])
    # Arrow batches carry the rows; only the columns asked for are moved by one
    dealt = dealt.mapInArrow(functools.partial(_beside, beside=[(side, cols) for side, cols in beside if cols]), shape)
    return _cut(dealt)


def _beside(batches: Iterator[pa.RecordBatch], beside: Sequence[tuple[str, Sequence[str]]]) -> Iterator[pa.RecordBatch]:
    """The batches, one behind, with the columns of the rows before and after each row."""
    import pyarrow as pa

    def joined(last, now, after):
        columns, n = list(now.columns), now.num_rows
        for side, cols in beside:
            if side == "_prev":
                other, at, edge = last, (lambda c: pa.concat_arrays([last.column(c).slice(last.num_rows - 1), now.column(c).slice(0, n - 1)]) if last is not None
                                         else pa.concat_arrays([pa.nulls(1, now.column(c).type), now.column(c).slice(0, n - 1)])), 0
            else:
                other, at, edge = after, (lambda c: pa.concat_arrays([now.column(c).slice(1), after.column(c).slice(0, 1)]) if after is not None
                                          else pa.concat_arrays([now.column(c).slice(1), pa.nulls(1, now.column(c).type)])), n - 1
            gone = pa.array([other is None and i == edge for i in range(n)]) if other is None else None
            columns.append(pa.StructArray.from_arrays([at(c) for c in cols], names=list(cols), mask=gone))
        return pa.RecordBatch.from_arrays(columns, names=[*now.schema.names, *[side for side, _ in beside]])

    last = now = None
    for after in batches:
        if not after.num_rows:
            continue
        if now is not None:
            yield joined(last, now, after)
        last, now = now, after
    if now is not None:
        yield joined(last, now, None)


def carry_last(cut: DataFrame, value: Column, name: str, backwards: bool = False) -> DataFrame:
    """Adds the last non-null ``value`` up to each row of a ``ranged`` table (null where there is none yet).

    ``backwards`` goes through the rows from the last one, so it adds the next non-null value.
    """
    cut = cut.withColumn("_value", value)
    at, of = (F.col("_at").desc(), F.col("_range").desc()) if backwards else (F.col("_at"), F.col("_range"))
    inside = Window.partitionBy("_range").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    outermost = F.min_by if backwards else F.max_by
    edge = cut.groupBy("_range").agg(outermost("_value", F.when(F.col("_value").isNotNull(), F.col("_at"))).alias("_edge"))
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    handed = edge.select("_range", F.last("_edge", ignorenulls=True).over(before).alias("_edge"))
    out = cut.join(F.broadcast(handed), "_range")
    return out.withColumn(name, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_edge"))).drop("_value", "_edge")


def running_total(cut: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over a group's rows up to each row; the table is ``ranged`` by ``group`` first."""
    ends = cut.groupBy("_range").agg(F.min(group).alias("_low"), F.max(group).alias("_high"))
    held = cut.join(F.broadcast(ends), "_range").filter(F.col(group).eqNullSafe(F.col("_low")) | F.col(group).eqNullSafe(F.col("_high")))
    held = held.groupBy("_range", F.col(group).alias("_of")).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy("_of").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = held.select(F.col("_range").alias("_r"), "_of", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range", group).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    out = cut.join(F.broadcast(handed), (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_of")), "left")
    return out.withColumn(name, F.sum(value).over(inside) + F.coalesce("_before", F.lit(0))).drop("_r", "_of", "_before")
