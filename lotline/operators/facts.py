"""Transaction facts (D-6 ... D-8, X-3).

Star lookup: natural key -> surrogate key.  The vehicle lookup is an
*inner* join to the current vehicle dimension (rows of deleted or unknown
vehicles drop out); every other lookup is a *left* join.  The current
vehicle row already carries ``branch_id``, so one join gives both the
vehicle key and the branch (the reference joined the silver vehicle table
and the dimension separately on the same key; for a unique vehicle id the
results are equal and one shuffle is saved).

No broadcast hints: small dimensions are broadcast by Spark's size-checked
``autoBroadcastJoinThreshold`` or by AQE from runtime sizes; large ones
(vehicle, customer, part) stay shuffle joins.  ``dims=None`` gives the lean
fact (vehicle key, date keys, measures) used when only measures are needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions.dates import date_key

FX_RATE = Decimal("1600.00")


def current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current")) if "is_current" in dim.columns else dim


def _vehicle_keys(dim_vehicle: DataFrame) -> DataFrame:
    return current(dim_vehicle).select("vehicle_key", "vehicle_id", "branch_id")


def _lookup(df: DataFrame, dims: dict | None, dim_name: str, key: str, natural: str,
            fact_col: str | None = None, out_key: str | None = None) -> DataFrame:
    """Left join ``dims[dim_name]`` on natural key -> add its surrogate key."""
    out_key = out_key or key
    fact_col = fact_col or natural
    if dims is None or dims.get(dim_name) is None:
        return df.withColumn(out_key, F.lit(None).cast("long"))
    d = current(dims[dim_name]).select(F.col(key).alias(out_key), F.col(natural).alias("_nk"))
    return df.join(d, df[fact_col] == d["_nk"], "left").drop("_nk")


def fact_purchase(purchase: DataFrame, dim_vehicle: DataFrame, dims: dict | None = None,
                  fx_rate: Decimal = FX_RATE, keep: Sequence[str] = ()) -> DataFrame:
    """One row per purchase of a current vehicle; no status or soft-delete
    filter (as in the reference).  NGN = USD price x fx_rate, exact decimal.
    ``keep``: further columns of ``purchase`` (a weight, for instance)."""
    f = purchase.join(_vehicle_keys(dim_vehicle), "vehicle_id")
    f = _lookup(f, dims, "auction_house", "auction_house_key", "auction_house_id")
    f = _lookup(f, dims, "staff", "staff_key", "staff_id", "buyer_staff_id", "buyer_staff_key")
    f = _lookup(f, dims, "branch", "branch_key", "branch_id")
    f = _lookup(f, dims, "source", "source_key", "source_id")
    fx = F.lit(fx_rate).cast("decimal(10,4)")
    return f.select(
        "vehicle_key", "auction_house_key", "buyer_staff_key", "branch_key",
        date_key("purchase_date").alias("purchase_date_key"), "source_key",
        F.col("price_amount").alias("price_amount_usd"),
        (F.col("price_amount") * fx).cast("decimal(20,2)").alias("price_amount_ngn"),
        fx.alias("fx_rate_used"), *keep)


def repair_lines(repair_job_part: DataFrame, repair_job: DataFrame) -> DataFrame:
    """Part lines at job grain: line ⋈ job on repair_job_id (J-13)."""
    jobs = repair_job.select("repair_job_id", "vehicle_id", "mechanic_staff_id", "start_date", "end_date",
                             F.col("source_id").alias("job_source_id"))
    return repair_job_part.join(jobs, "repair_job_id")


def fact_repair(repair_job_part: DataFrame, repair_job: DataFrame, dim_vehicle: DataFrame,
                dims: dict | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per part line of a current vehicle's repair job;
    line_cost = unit_cost x qty (exact decimal).  ``keep``: further columns
    of the lines."""
    f = repair_lines(repair_job_part, repair_job).join(_vehicle_keys(dim_vehicle), "vehicle_id")
    f = _lookup(f, dims, "staff", "staff_key", "staff_id", "mechanic_staff_id", "mechanic_staff_key")
    f = _lookup(f, dims, "part", "part_key", "part_id")
    f = _lookup(f, dims, "vendor", "vendor_key", "vendor_id")
    f = _lookup(f, dims, "branch", "branch_key", "branch_id")
    f = _lookup(f, dims, "source", "source_key", "source_id", "job_source_id")
    return f.select(
        "vehicle_key", "mechanic_staff_key", "part_key", "vendor_key", "branch_key",
        date_key("start_date").alias("repair_start_date_key"),
        date_key("end_date").alias("repair_end_date_key"), "source_key",
        "qty", F.col("unit_cost").alias("unit_cost_ngn"),
        (F.col("unit_cost") * F.col("qty").cast("decimal(10,0)")).cast("decimal(20,2)").alias("line_cost_ngn"), *keep)


def fact_sale(sale: DataFrame, dim_vehicle: DataFrame, dims: dict | None = None) -> DataFrame:
    """One row per sale of a current vehicle, every status kept."""
    f = sale.join(_vehicle_keys(dim_vehicle), "vehicle_id")
    f = _lookup(f, dims, "customer", "customer_key", "customer_id")
    f = _lookup(f, dims, "staff", "staff_key", "staff_id", "salesperson_staff_id", "salesperson_staff_key")
    f = _lookup(f, dims, "branch", "branch_key", "branch_id")
    f = _lookup(f, dims, "source", "source_key", "source_id")
    return f.select(
        "vehicle_key", "customer_key", "salesperson_staff_key", "branch_key",
        date_key("sale_date").alias("sale_date_key"), "source_key",
        F.col("agreed_price").alias("agreed_price_ngn"), "status")


def fact_expense(expense: DataFrame, dim_vehicle: DataFrame, dims: dict | None = None) -> DataFrame:
    """Expenses (X-3).  The vehicle is optional (null = overhead), so the
    vehicle lookup is a left join here."""
    vk = current(dim_vehicle).select("vehicle_key", F.col("vehicle_id").alias("_vid"))
    f = expense.join(vk, expense["vehicle_id"] == vk["_vid"], "left").drop("_vid")
    f = _lookup(f, dims, "expense_category", "category_key", "category_code", "category")
    f = _lookup(f, dims, "source", "source_key", "source_id")
    return f.select("vehicle_key", "category_key", date_key("expense_date").alias("expense_date_key"),
                    "source_key", F.col("amount").alias("amount_ngn"), "currency")
