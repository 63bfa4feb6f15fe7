"""Incremental refresh of the profit fact (D-10, X-4, X-8).

What changed between two states of a silver table is a set of signed rows: -1
for a row that is gone or was otherwise, 1 for one that is new.  Costs are sums,
so the signed rows' partial sums are added to the old fact.  Revenue is a
maximum, which a lost row can lower, so it is taken anew, for the touched
vehicles alone.  Vehicles that nothing touches keep their row and its time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions.money import pct
from lotline.operators.facts import current
from lotline.operators.profit import AMOUNT, REVENUE_STATUSES, _ts


def signed_changes(old: DataFrame, new: DataFrame, columns: Sequence[str] | None = None, weight: str = "weight") -> DataFrame:
    """The rows in which two states of a table differ, with ``weight`` (negative: only in ``old``, positive: only in ``new``).

    Rows are compared whole (``columns``; null equals null) and counted, so
    repeated rows are kept apart; one shuffle with partial sums, of which
    equal rows cancel out.
    """
    columns = list(columns or new.columns)
    tagged = old.select(*columns, F.lit(-1).cast("long").alias(weight)).unionByName(new.select(*columns, F.lit(1).cast("long").alias(weight)))
    return tagged.groupBy(*columns).agg(F.sum(weight).alias(weight)).filter(F.col(weight) != 0)


def refresh_profit(fact: DataFrame, dim_vehicle: DataFrame, cost_changes: Sequence[tuple[DataFrame, str]], sale_changes: DataFrame,
                   fact_sale: DataFrame, as_of=None, revenue_statuses=REVENUE_STATUSES) -> DataFrame:
    """The profit fact after a batch of changes.

    ``cost_changes``: (signed fact rows with vehicle_key and weight, their
    amount column) for purchases, repairs or expenses.  ``sale_changes``: rows
    with the vehicle_key of changed sales, ``fact_sale`` all sales as they are
    now.  Vehicles without a row in ``fact`` get one; those no longer current
    lose theirs.  ``calculated_at`` is ``as_of`` where cost or revenue differ
    from the old row, else the old time.  No changes: the old fact.
    """
    none = F.lit(None).cast(AMOUNT)
    touched = sale_changes.select("vehicle_key").distinct()
    revenue = fact_sale.join(touched, "vehicle_key", "left_semi").filter(F.col("status").isin(*revenue_statuses))
    parts = [df.select("vehicle_key", (F.col(amount).cast(AMOUNT) * F.col("weight")).cast(AMOUNT).alias("_cost"), none.alias("_revenue"), F.lit(False).alias("_sales"))
             for df, amount in cost_changes]
    parts.append(touched.select("vehicle_key", none.alias("_cost"), none.alias("_revenue"), F.lit(True).alias("_sales")))
    parts.append(revenue.select("vehicle_key", none.alias("_cost"), F.col("agreed_price_ngn").cast(AMOUNT).alias("_revenue"), F.lit(True).alias("_sales")))
    signed = parts[0]
    for p in parts[1:]:
        signed = signed.unionByName(p)
    changes = signed.groupBy("vehicle_key").agg(F.sum("_cost").alias("_cost"), F.max("_revenue").alias("_revenue"), F.bool_or("_sales").alias("_sales"))
    old = fact.select("vehicle_key", F.col("total_cost_ngn").cast(AMOUNT).alias("_old_cost"), F.col("total_revenue_ngn").cast(AMOUNT).alias("_old_revenue"),
                      F.col("calculated_at").alias("_old_time"), F.lit(True).alias("_was"))
    j = current(dim_vehicle).select("vehicle_key").join(old, "vehicle_key", "left").join(changes, "vehicle_key", "left")
    zero = F.lit(0).cast(AMOUNT)
    cost = (F.coalesce("_old_cost", zero) + F.coalesce("_cost", zero)).cast(AMOUNT)
    now = F.when(F.coalesce("_sales", F.lit(False)), F.col("_revenue")).otherwise(F.col("_old_revenue"))
    j = j.withColumns({"total_cost_ngn": cost, "total_revenue_ngn": now})
    profit = F.when(F.col("total_revenue_ngn").isNotNull(), F.col("total_revenue_ngn") - F.col("total_cost_ngn"))
    same = F.col("_was").isNotNull() & (F.col("total_cost_ngn") == F.col("_old_cost")) & F.col("total_revenue_ngn").eqNullSafe(F.col("_old_revenue"))
    j = j.withColumn("profit_ngn", profit)
    return j.select("vehicle_key", "total_cost_ngn", "total_revenue_ngn", "profit_ngn", pct("profit_ngn", "total_revenue_ngn").alias("margin_pct"),
                    F.when(same, F.col("_old_time")).otherwise(_ts(as_of)).alias("calculated_at"))
