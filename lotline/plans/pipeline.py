"""End-to-end layer builds over a lakehouse root.

``build_gold`` reads the silver tables by (layer, name), builds every
dimension and fact and writes them to the gold layer; ``build_triage``
turns raw messages and receipt lines into extracted events, review tasks
and the review-queue fact.  Each written table is read back before the next
step uses it, so every gold table is computed once and later steps start
from files, not from re-derived plans.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.operators import dims as D
from lotline.operators import facts as FX
from lotline.operators import lifecycle as L
from lotline.operators import profit as P
from lotline.operators import triage as TR
from lotline.operators import dml, scd2
from lotline.sources.lakehouse import read_table, table_exists, write_table, write_version

MILESTONE_TABLES = ("purchase", "shipment", "port_arrival", "pickup", "office_intake", "inspection",
                    "repair_job", "cleaning_task", "listing", "sale")


def _write_read(spark: SparkSession, df: DataFrame, root: str, layer: str, name: str, mode: str = "overwrite"):
    """Readers keep the old version until the new one is whole."""
    if mode == "overwrite":
        write_version(df, root, layer, name)
    else:
        write_table(df, root, layer, name, mode=mode)
    return read_table(spark, root, layer, name)


def _versioned_dim(spark: SparkSession, root: str, name: str, built: DataFrame, key: str, surrogate: str, run_ts: str | None,
                   tracked: list[str], overwritten: list[str] = ()) -> DataFrame:
    """The dimension as first built, or the one there is with changed and gone rows closed and new versions opened at ``run_ts``.

    Keys of unchanged rows stay, so facts and histories of earlier runs keep
    their meaning.  ``overwritten``: columns without versions (the stage has
    its own history)."""
    if not table_exists(spark, root, "gold", name):
        return built
    now = run_ts if run_ts is not None else F.current_timestamp()
    return scd2.scd2_refresh(read_table(spark, root, "gold", name), built, key, tracked, now, surrogate, overwritten)


def build_gold(spark: SparkSession, root: str, calendar: tuple[str, str] = ("2025-01-01", "2027-12-31"),
               fx_rate: Decimal = Decimal("1600.00"), run_ts: str | None = None,
               reason: str = "initial calculation") -> dict[str, DataFrame]:
    """Build and write the gold layer from the silver tables under ``root``.

    Returns the written tables (read back from the gold layer).
    """
    s = lambda name: read_table(spark, root, "silver", name)
    out: dict[str, DataFrame] = {}
    w = lambda df, name: out.__setitem__(name, _write_read(spark, df, root, "gold", name))

    w(D.dim_date(spark, *calendar), "dim_date")
    w(_versioned_dim(spark, root, "dim_vehicle", D.dim_vehicle(s("vehicle")), "vehicle_id", "vehicle_key", run_ts,
                     tracked=["vin", "make", "model", "model_year", "branch_id"], overwritten=["stage", "status"]), "dim_vehicle")
    dims = {
        "branch": D.build_dim(s("branch"), ["branch_id", "name", "is_active"], "branch_key", "branch_id"),
        "staff": D.dim_staff(s("staff"), s("staff_role"), as_of=run_ts),
        "auction_house": D.build_dim(s("auction_house"), ["auction_house_id", "name", "country"],
                                     "auction_house_key", "auction_house_id"),
        "vendor": D.build_dim(s("vendor"), ["vendor_id", "name"], "vendor_key", "vendor_id"),
        "part": D.build_dim(s("part"), ["part_id", "name", "category"], "part_key", "part_id"),
        "customer": D.build_dim(s("customer"), ["customer_id", "name", "phone"], "customer_key", "customer_id"),
        "source": D.build_dim(s("data_source"), ["source_id", "source_code"], "source_key", "source_id"),
    }
    table_of = {name: ("dim_data_source" if name == "source" else f"dim_{name}") for name in dims}
    dims["staff"] = _versioned_dim(spark, root, "dim_staff", dims["staff"], "staff_id", "staff_key", run_ts, tracked=["name", "branch_id", "primary_role"])
    for name, df in dims.items():
        w(df, table_of[name])
    gdims = {name: out[table_of[name]] for name in dims}
    w(D.dim_expense_category(spark), "dim_expense_category")
    w(D.dim_payment_method(spark), "dim_payment_method")

    dv = out["dim_vehicle"]
    w(FX.fact_purchase(s("purchase"), dv, gdims, fx_rate), "fact_purchase")
    w(FX.fact_repair(s("repair_job_part"), s("repair_job"), dv, gdims), "fact_repair")
    w(FX.fact_sale(s("sale"), dv, gdims), "fact_sale")

    ms = L.milestones(**{t: s(t) for t in MILESTONE_TABLES})
    w(L.fact_vehicle_lifecycle(s("vehicle"), dv, ms), "fact_vehicle_lifecycle")
    w(P.fact_profit(dv, out["fact_purchase"], out["fact_repair"], out["fact_sale"], as_of=run_ts), "fact_profit")

    # append-only audit history: keys continue after the last run's maximum
    if table_exists(spark, root, "gold", "fact_profit_history"):
        snap = P.profit_changes(out["fact_profit"], read_table(spark, root, "gold", "fact_profit_history"), reason)
    else:
        snap = P.profit_snapshot(out["fact_profit"], None, reason)
    write_table(snap, root, "gold", "fact_profit_history", mode="append")
    out["fact_profit_history"] = read_table(spark, root, "gold", "fact_profit_history")
    return out


def sync_current_state(spark: SparkSession, root: str, sources, as_of: str | None = None) -> None:
    """Bring silver up to date (D-20, D-21): the vehicles' stages from their
    milestones (``sources`` as in ``lifecycle.stage_events``), and listings of
    sold vehicles; each as a new version of its table."""
    history = L.stage_history(L.stage_events(sources))
    vehicle = L.sync_current_stage(read_table(spark, root, "silver", "vehicle"), history, as_of=as_of)
    write_version(vehicle, root, "silver", "vehicle")
    listing = read_table(spark, root, "silver", "listing")
    sold = read_table(spark, root, "silver", "sale").filter(F.col("status").isin("FINALIZED", "PENDING_PAYMENT")).select("vehicle_id")
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    write_version(dml.update_where_in(listing, sold, "vehicle_id", {"status": F.lit("SOLD"), "updated_at": now.cast(listing.schema["updated_at"].dataType)}),
                  root, "silver", "listing")


def build_triage(spark: SparkSession, root: str, run_ts: str | None = None) -> dict[str, DataFrame]:
    """Extracted events, scored receipt lines, review tasks (events first,
    receipts numbered after them) and the review-queue fact."""
    out: dict[str, DataFrame] = {}
    events = TR.extracted_event(read_table(spark, root, "bronze", "raw_message"),
                                read_table(spark, root, "silver", "vehicle"))
    out["extracted_event"] = _write_read(spark, events, root, "silver", "extracted_event")
    lines = TR.score_receipts(read_table(spark, root, "silver", "extracted_receipt_line"),
                              read_table(spark, root, "silver", "purchase"))
    out["extracted_receipt_line"] = _write_read(spark, lines, root, "silver", "extracted_receipt_line_scored")
    ev_tasks = _write_read(spark, TR.review_tasks(out["extracted_event"], "event_id", "EXTRACTED_EVENT",
                                                  as_of=run_ts), root, "silver", "review_task")
    rc_tasks = TR.review_tasks(out["extracted_receipt_line"], "line_id", "EXTRACTED_RECEIPT_LINE",
                               existing=ev_tasks, as_of=run_ts)
    write_table(rc_tasks, root, "silver", "review_task", mode="append")
    out["review_task"] = read_table(spark, root, "silver", "review_task")
    queue = TR.fact_review_queue(out["review_task"], out["extracted_event"], out["extracted_receipt_line"],
                                 read_table(spark, root, "gold", "dim_staff"),
                                 read_table(spark, root, "gold", "dim_data_source"))
    out["fact_review_queue"] = _write_read(spark, queue, root, "gold", "fact_review_queue")
    return out


def write_driver_silver(silver, root: str) -> None:
    """Write the driver-table role mapping (``sources.driver.DriverSilver``)
    as a silver/bronze layer, the input ``build_gold`` expects."""
    tables = {
        "branch": silver.branch, "auction_house": silver.auction_house, "vendor": silver.vendor,
        "part": silver.part, "customer": silver.customer, "data_source": silver.data_source,
        "staff": silver.staff, "staff_role": silver.staff_role, "vehicle": silver.vehicle,
        "purchase": silver.purchase, "shipment": silver.shipment, "port_arrival": silver.port_arrival,
        "pickup": silver.intake, "office_intake": silver.intake, "inspection": silver.inspection,
        "repair_job": silver.repair_job, "repair_job_part": silver.repair_job_part,
        "cleaning_task": silver.cleaning_task, "listing": silver.listing, "sale": silver.sale,
        "extracted_receipt_line": silver.receipt_line,
    }
    for name, df in tables.items():
        write_table(df, root, "silver", name)
    write_table(silver.raw_message, root, "bronze", "raw_message")
