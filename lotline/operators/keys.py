"""Surrogate keys and neighbours in a total order (W-2 ... W-7).

``dense_key`` numbers rows 1..n in a stated total order, by one algorithm at
every size and for any orderable columns, nulls first:

1. the rows are range-partitioned by all order columns (Spark samples the
   boundaries, so outliers and hot leading values do not matter as long as
   the whole order is selective) and written to the shared checkpoint folder
   with their range's number, so every later pass sees the same rows, also
   after an executor loss;
2. the rows of each range are counted; the running sums, one number per range
   (as many as there are shuffle partitions, whatever the input), become a
   constant of the plan;
3. key = offset of the range + place inside it.

So the numbered table is a projection of the written files: no join and no
further shuffle.  The previous and next row of the whole order are written with
the rows of a range as they stream by; at the edges of a range they are handed
over by a broadcast of one row per range.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotline.operators.ordered import neighbours, ranged
from lotline.sources.lakehouse import scalar_or_default


def dense_key(df: DataFrame, order: str | Sequence[str], name: str, start: int = 1, offset: DataFrame | None = None,
              prev: Sequence[str] | None = None, nxt: Sequence[str] | None = None) -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order`` (columns, ascending, nulls first).

    ``offset``: a one-row DataFrame whose single numeric column is added to
    every key (W-4), as a scalar subquery.  ``prev`` / ``nxt``: columns of
    the previous / next row in the order, added as structs ``_prev`` /
    ``_next`` (null at the ends).  Rows that tie in all of ``order`` get
    consecutive keys in any order among them.
    """
    order = [order] if isinstance(order, str) else list(order)
    cut = neighbours(df, order, prev or (), nxt or ()) if prev or nxt else ranged(df, order)
    size = {r["_range"]: r["_n"] for r in cut.groupBy("_range").agg((F.max("_at") + 1).alias("_n")).collect()}
    before = [0, *itertools.accumulate(size.get(r, 0) for r in range(max(size, default=0)))]
    key = F.element_at(F.lit(before).cast("array<bigint>"), (F.col("_range") + 1).cast("int")) + F.col("_at") + F.lit(start)
    sides = [(side, F.struct(*cols)) for side, cols in (("_prev", prev), ("_next", nxt)) if cols]
    near = []
    if sides:
        edges = [(F.max_by if side == "_prev" else F.min_by)(value, "_at").alias(f"{side}_edge") for side, value in sides]
        by_range = Window.orderBy("_range")  # one row per range
        handed = [(F.lag if side == "_prev" else F.lead)(f"{side}_edge").over(by_range).alias(f"{side}_edge") for side, _ in sides]
        per_range = cut.groupBy("_range").agg(*edges).select("_range", *handed)
        near = [F.coalesce(side, F.col(f"{side}_edge")).alias(side) for side, _ in sides]
        cut = cut.join(F.broadcast(per_range), "_range")
    out = cut.select(*df.columns, key.cast("long").alias(name), *near)
    if offset is not None:
        base = offset.select(F.coalesce(F.col(offset.columns[0]), F.lit(0)).cast("long")).scalar()
        out = out.withColumn(name, F.col(name) + base)
    return out


def next_keys(df: DataFrame, order: str | Sequence[str], name: str, existing: DataFrame, existing_key: str) -> DataFrame:
    """Number new rows after the current maximum of ``existing`` (W-4);
    an empty existing table starts at 1."""
    return dense_key(df, order, name, offset=scalar_or_default(existing, F.max(existing_key), 0, "_mx"))


def unique_id(df: DataFrame, name: str) -> DataFrame:
    """Unique, non-dense id (W-5); restarts at 0 on every run, so never use
    it for rows appended across runs (use ``next_keys``)."""
    return df.withColumn(name, F.monotonically_increasing_id())
