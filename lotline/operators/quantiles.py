"""Exact quantiles by refining histograms (X-6: where vehicles wait longest).

No group is sorted or held in one task, however large.  Each round counts the
rows of every group in ``bins`` equal steps between the bounds that are still
possible, with the least and greatest value of each bin, keeps the bin that holds
the wanted rank, and goes on inside it until its values are one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.session import cut_lineage

BINS = 1024
#: More wanted quantiles (groups times shares) than this meet the rows in a shuffle, not a broadcast.
BROADCAST_STATES = 50_000


def exact_quantiles(df: DataFrame, group: str, value: str, shares: Sequence[float], bins: int = BINS) -> DataFrame:
    """(group, share, rows, quantile): the value at rank ceil(share x rows) of each group's non-null values, rank 1 at least.

    Null is a group of its own; groups without a value have no row.  Values
    are numbers of any kind, returned in their own type; ties do not matter.
    A round reads ``df`` once; a round shrinks the bounds by ``bins`` or more,
    or ends a group, so there are few of them.
    """
    if not shares or not all(0 <= s <= 1 for s in shares):
        raise ValueError("shares are between 0 and 1")
    rows = df.select(F.col(group).alias("_group"), F.col(value).alias("_value")).filter("_value is not null")
    bounds = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    wanted = bounds.withColumn("_share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    rank = F.greatest(F.lit(1), F.ceil(F.col("_share") * F.col("_n"))).cast("long")
    states = cut_lineage(wanted.withColumn("_rank", rank))
    done = None
    while True:
        ended = states.filter("_low = _high").select("_group", "_share", "_n", F.col("_low").alias("_quantile"))
        done = ended if done is None else done.unionByName(ended)
        open_ = states.filter("_low < _high")
        left = open_.count()
        if not left:
            break
        states = cut_lineage(_refine(rows, open_, bins, left <= BROADCAST_STATES))
    return done.select(F.col("_group").alias(group), F.col("_share").alias("share"), F.col("_n").alias("rows"), F.col("_quantile").alias("quantile"))


def _refine(rows: DataFrame, states: DataFrame, bins: int, few: bool) -> DataFrame:
    """The states with the bounds of the bin that holds their rank."""
    s = states.withColumnRenamed("_group", "_of")
    inside = rows.join(F.broadcast(s) if few else s, F.col("_group").eqNullSafe(F.col("_of")) & F.col("_value").between(F.col("_low"), F.col("_high")))
    exact = isinstance(rows.schema["_value"].dataType, T.IntegralType)  # differences of long numbers need more digits
    value, low, high = (F.col(c).cast("decimal(20,0)") if exact else F.col(c) for c in ("_value", "_low", "_high"))
    place = F.try_divide((value - low).cast("double"), (high - low).cast("double"))
    # where infinite bounds make no step, the lowest value has one of its own; NaN is the greatest
    ends = F.when(F.col("_value") == F.col("_low"), F.lit(0)).otherwise(F.lit(bins - 1))
    step = F.when((place >= 0) & (place <= 1), F.least(F.floor(place * bins), F.lit(bins - 1))).otherwise(ends)
    bin_ = F.when(F.isnan(F.col("_high").cast("double")), F.when(F.isnan(F.col("_value").cast("double")), bins - 1).otherwise(0)).otherwise(step).cast("int")
    key = ["_group", "_share", "_n", "_rank"]
    counted = inside.groupBy(*key, bin_.alias("_bin")).agg(
        F.count(F.lit(1)).alias("_here"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    upto = F.sum("_here").over(Window.partitionBy("_group", "_share").orderBy("_bin"))  # at most ``bins`` rows
    counted = counted.withColumn("_upto", upto)
    found = counted.filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_here") < F.col("_rank")))
    return found.select("_group", "_n", "_low", "_high", "_share", (F.col("_rank") - F.col("_upto") + F.col("_here")).alias("_rank"))
