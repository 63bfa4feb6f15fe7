"""Dimensions of the star schema (D-1 ... D-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.functions.dates import calendar_parts
from lotline.operators.keys import dense_key

# The two static code lists of the reference, keyed 1..n in
# list order.
EXPENSE_CATEGORIES = ("CUSTOMS", "TRANSPORT", "REPAIR", "MISC")
PAYMENT_METHODS = ("BANK_TRANSFER", "POS", "CASH")

DATE_DIM_COLUMNS = ("date_key", "full_date", "day_of_week", "week_of_year", "month_no",
                    "month_name", "quarter", "year", "is_weekend")


def dim_date_from_bounds(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (D-1).

    ``bounds`` has one row per range; the calendar is generated on the
    executors with ``sequence``/``explode``, never on the driver.
    """
    days = bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"),
                                              F.expr("interval 1 day"))).alias("d"))
    parts = calendar_parts("d")
    return days.select(*[parts[c].alias(c) for c in DATE_DIM_COLUMNS])


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar between two literal dates (the reference's 2025-01-01 ...
    2027-12-31 is ``dim_date(spark, "2025-01-01", "2027-12-31")``)."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return dim_date_from_bounds(bounds)


def dim_date_covering(df: DataFrame, *date_cols: str) -> DataFrame:
    """Calendar spanning the min ... max of the given date columns of ``df``."""
    lo = F.least(*[F.min(F.col(c).cast("date")) for c in date_cols]) if len(date_cols) > 1 \
        else F.min(F.col(date_cols[0]).cast("date"))
    hi = F.greatest(*[F.max(F.col(c).cast("date")) for c in date_cols]) if len(date_cols) > 1 \
        else F.max(F.col(date_cols[0]).cast("date"))
    return dim_date_from_bounds(df.agg(lo.alias("start"), hi.alias("end")))


def build_dim(df: DataFrame, cols: Sequence[str | Column], key_name: str, natural_key: str) -> DataFrame:
    """Projection plus a dense surrogate key in natural-key order (D-3).

    The output has the key first, then ``cols``.
    """
    projected = df.select(*cols)
    keyed = dense_key(projected, natural_key, key_name)
    return keyed.select(key_name, *[c for c in projected.columns])


def dim_vehicle(vehicle: DataFrame) -> DataFrame:
    """Current, non-deleted vehicles with SCD2 columns (D-2).

    effective_from = created_at, effective_to = null, is_current = true;
    key 1..n by vehicle_id.
    """
    base = vehicle.filter(~F.col("is_deleted")).select(
        "vehicle_id", "vin", "make", "model", "model_year", "branch_id",
        F.col("current_stage").alias("stage"), F.col("current_status").alias("status"),
        F.col("created_at").alias("effective_from"))
    keyed = dense_key(base, "vehicle_id", "vehicle_key")
    return keyed.select(
        "vehicle_key", "vehicle_id", "vin", "make", "model", "model_year", "branch_id", "stage", "status",
        "effective_from", F.lit(None).cast(keyed.schema["effective_from"].dataType).alias("effective_to"),
        F.lit(True).alias("is_current"))


def dim_staff(staff: DataFrame, staff_role: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Staff with their alphabetically first role (D-4).

    Role validity dates are ignored, as in the reference.  ``effective_from``
    is the as-of time (current time when not given).
    """
    roles = staff_role.groupBy("staff_id").agg(F.min("role_code").alias("primary_role"))
    full = staff.select("staff_id", "name", "branch_id").join(roles, "staff_id", "left")
    keyed = dense_key(full, "staff_id", "staff_key")
    eff = F.current_timestamp() if as_of is None else (
        F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of)
    eff_type = "timestamp_ntz" if isinstance(as_of, str) else "timestamp"
    return keyed.select("staff_key", "staff_id", "name", "branch_id", "primary_role",
                        eff.alias("effective_from"), F.lit(None).cast(eff_type).alias("effective_to"),
                        F.lit(True).alias("is_current"))


def static_dim(spark: SparkSession, codes: Sequence[str], key_name: str, code_name: str) -> DataFrame:
    """Literal code list keyed 1..n in list order (D-5)."""
    schema = T.StructType([T.StructField(key_name, T.LongType(), False),
                           T.StructField(code_name, T.StringType(), False)])
    return spark.createDataFrame([(i, c) for i, c in enumerate(codes, start=1)], schema)


def dim_expense_category(spark: SparkSession) -> DataFrame:
    return static_dim(spark, EXPENSE_CATEGORIES, "category_key", "category_code")


def dim_payment_method(spark: SparkSession) -> DataFrame:
    return static_dim(spark, PAYMENT_METHODS, "method_key", "method_code")
