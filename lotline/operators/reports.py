"""Report shapes over the gold tables (D-24 ... D-27, X-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def breakdown(df: DataFrame, *keys: str, ordered: bool = False) -> DataFrame:
    """Row count per key combination (D-26); ``ordered``: largest first, then by key (L-1, L-2)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.col("count").desc(), *[F.col(k).asc() for k in keys]) if ordered else out


def top_k(df: DataFrame, measure: str, k: int, tie_key: str | Sequence[str],
          cols: Sequence[str] | None = None) -> DataFrame:
    """k rows with the largest ``measure`` (nulls last), ties broken by
    ``tie_key`` ascending so the result is unique (D-27).  Plans as
    TakeOrderedAndProject: each task keeps its own top k, only k rows per
    task reach the final merge."""
    ties = [tie_key] if isinstance(tie_key, str) else list(tie_key)
    out = df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(k)
    return out.select(*cols) if cols else out


def first_k(df: DataFrame, key: str | Sequence[str], k: int, cols: Sequence[str] | None = None) -> DataFrame:
    """The k rows with the smallest key (L-5; the reference samples its demo
    rows this way).  Plans as TakeOrderedAndProject."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.orderBy(*[F.col(c).asc() for c in keys]).limit(k)
    return out.select(*cols) if cols else out


def avg_cycle_days(lifecycle: DataFrame, stage: str = "SOLD") -> DataFrame:
    """Average purchase-to-sale days over vehicles whose current stage is
    ``stage`` (D-25)."""
    return lifecycle.filter(F.col("current_stage") == stage).agg(
        F.avg("total_days_purchase_to_sale").alias("avg_days_purchase_to_sale"))


def review_kpis(review_queue: DataFrame) -> DataFrame:
    """Review-queue operations KPIs (X-12) per source and status."""
    return review_queue.groupBy("source_key", "status").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.round(F.avg("confidence_score"), 4).alias("avg_confidence"),
        F.count("resolved_date_key").alias("resolved"),
        F.round(F.avg("resolution_hours"), 2).alias("avg_resolution_hours"))


def status_report(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """All breakdowns in one pass (D-26, A-1, A-2): (report, key1, key2, level, count).

    ``tables``: (report, table, one or two key columns).  The tables' keys are
    tagged and put together, and one aggregation over GROUPING SETS gives the
    count of every key combination (level 0), of the first key of two (level
    1) and of the whole report (level 3), told apart by ``grouping_id``, so a
    null key is not a total.
    """
    tagged = None
    for name, df, keys in tables:
        two = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * (2 - len(keys))
        t = df.select(F.lit(name).alias("report"), F.lit(len(keys)).alias("_keys"), two[0].alias("key1"), two[1].alias("key2"))
        tagged = t if tagged is None else tagged.unionByName(t)
    one, two, three = ["report", "_keys"], ["report", "_keys", "key1"], ["report", "_keys", "key1", "key2"]
    sets = tagged.groupingSets([[F.col(c) for c in s] for s in (three, two, one)], *[F.col(c) for c in three])
    out = sets.agg(F.count(F.lit(1)).alias("count"), F.grouping_id().cast("int").alias("level"))
    # a report by one key has its detail without the second one
    return out.filter("not (_keys = 1 and level = 0)").withColumn("level", F.expr("if(_keys = 1 and level = 1, 0, level)")).select("report", "key1", "key2", "level", "count")
