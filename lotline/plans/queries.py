"""Named queries over the driver tables: one per operator of SURVEY §2.

Each query takes (spark, sf_dir) and returns a DataFrame whose column names
match the oracle SQL of ``plans/oracle.py``.  Money leaves as double (cast
from exact decimals at the very end), so both engines hash equal values.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.operators import contracts as CO
from lotline.operators import dims as D
from lotline.operators import dml
from lotline.operators import facts as FX
from lotline.operators import incremental as IN
from lotline.operators import lifecycle as L
from lotline.operators import matching as MA
from lotline.operators import profit as P
from lotline.operators import quality as Q
from lotline.operators import quantiles as QU
from lotline.operators import reports as RP
from lotline.operators import rules as R
from lotline.operators import scd2
from lotline.operators import triage as TR
from lotline.functions.text import lookup
from lotline.sources.driver import AS_OF, EVENT_STAGES, FX_RATE, SEVERITY_OF_FLAG, DriverSilver
from lotline.operators.keys import dense_key
from lotline.session import cut_lineage, ensure_checkpoint_dir
from lotline.sources.lakehouse import read_table, read_version, write_table, write_version
from lotline.sources.landing import explode_payload, land_files, land_raw, read_landed

RUN_TS = f"{AS_OF} 00:00:00"
TASK_TS = "1995-01-01 06:30:00"
EVENTS_CUTOFF = "2024-01-15 00:00:00"

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def money_out(df: DataFrame) -> DataFrame:
    """Decimals -> double for the result hand-off."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _written(fn):
    """A table that several steps of one query read: written once to the
    shared checkpoint folder and read back."""
    attr = "_w_" + fn.__name__

    @functools.wraps(fn)
    def wrapper(self):
        if attr not in self.__dict__:
            self.__dict__[attr] = cut_lineage(fn(self))
        return self.__dict__[attr]
    return wrapper


class LazyDims(dict):
    """Dimension lookups built on first use.  Numbering writes them, so their
    size is known: Spark broadcasts the small ones by it, and only joins on the
    large ones shuffle."""

    def __init__(self, s: DriverSilver):
        super().__init__()
        self._build = {
            "auction_house": lambda: D.build_dim(s.auction_house, ["auction_house_id", "name", "country"],
                                                 "auction_house_key", "auction_house_id"),
            "staff": lambda: D.dim_staff(s.staff, s.staff_role, as_of=RUN_TS),
            "branch": lambda: D.build_dim(s.branch, ["branch_id", "name", "is_active"], "branch_key", "branch_id"),
            "source": lambda: D.build_dim(s.data_source, ["source_id", "source_code"], "source_key", "source_id"),
            "part": lambda: D.build_dim(s.part, ["part_id", "name", "category"], "part_key", "part_id"),
            "vendor": lambda: D.build_dim(s.vendor, ["vendor_id", "name"], "vendor_key", "vendor_id"),
            "customer": lambda: D.build_dim(s.customer, ["customer_id", "name", "phone"], "customer_key", "customer_id"),
            "expense_category": lambda: D.dim_expense_category(s.spark),
        }

    def __missing__(self, key):
        if key not in self._build:
            raise KeyError(key)
        self[key] = self._build[key]()
        return self[key]

    def get(self, key, default=None):
        return self[key] if key in self._build else default


class Gold:
    """Dimensions and facts of one query over one scale folder.

    Tables that several steps read are written to the shared checkpoint folder
    first, as a pipeline writes its layers; nothing is kept from one query to
    the next.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.s = DriverSilver(spark, sf_dir)

    @functools.cached_property
    def dim_vehicle(self) -> DataFrame:
        return D.dim_vehicle(self.s.vehicle_rows)

    @functools.cached_property
    def dims(self) -> "LazyDims":
        return LazyDims(self.s)

    def fact_purchase(self, full: bool = True) -> DataFrame:
        return FX.fact_purchase(self.s.purchase, self.dim_vehicle, self.dims if full else None, FX_RATE)

    def fact_repair(self, full: bool = True) -> DataFrame:
        return FX.fact_repair(self.s.repair_job_part, self.s.repair_job, self.dim_vehicle,
                              self.dims if full else None)

    def fact_sale(self, full: bool = True) -> DataFrame:
        return FX.fact_sale(self.s.sale, self.dim_vehicle, self.dims if full else None)

    @_written
    def fact_profit(self) -> DataFrame:
        return P.fact_profit(self.dim_vehicle, self.fact_purchase(False), self.fact_repair(False),
                             self.fact_sale(False), as_of=RUN_TS)

    def milestones(self) -> DataFrame:
        s = self.s
        return L.milestones(purchase=s.purchase, shipment=s.shipment, port_arrival=s.port_arrival,
                            pickup=s.intake, office_intake=s.intake, inspection=s.inspection,
                            repair_job=s.repair_job, cleaning_task=s.cleaning_task, listing=s.listing,
                            sale=s.sale)

    @_written
    def lifecycle(self) -> DataFrame:
        return L.fact_vehicle_lifecycle(self.s.vehicle, self.dim_vehicle, self.milestones())

    @_written
    def vehicle_history(self) -> DataFrame:
        s = self.s
        src = [
            (s.purchase, "purchase_date", "PURCHASED", None),
            (s.shipment, "etd", "SHIPPED", None),
            (s.port_arrival, "arrival_date", "AT_PORT", None),
            (s.port_arrival, "cleared_date", "CLEARED", F.col("clearance_status") == "CLEARED"),
            (s.intake, "pickup_date", "PICKED_UP", None),
            (s.intake, "intake_date", "AT_OFFICE", None),
            (s.inspection, "inspection_date", "INSPECTING", F.col("round_no") == 1),
            (s.repair_job, "start_date", "IN_REPAIR", None),
            (s.cleaning_task, "task_date", "CLEANED", F.col("status") == "DONE"),
            (s.listing, "listed_date", "LISTED", None),
            (s.sale, "sale_date", "SOLD", None),
        ]
        return L.stage_history(L.stage_events(src))

    @_written
    def events_history(self) -> DataFrame:
        return L.stage_history(self.s.stage_events, EVENT_STAGES)

    @_written
    def extracted_event(self) -> DataFrame:
        return TR.extracted_event(self.s.raw_message, self.s.vehicle)

    @_written
    def receipt_lines(self) -> DataFrame:
        return TR.score_receipts(self.s.receipt_line, self.s.purchase)

    @_written
    def review_tasks(self) -> DataFrame:
        ev_tasks = TR.review_tasks(self.extracted_event(), "event_id", "EXTRACTED_EVENT", as_of=TASK_TS)
        rc_tasks = TR.review_tasks(self.receipt_lines(), "line_id", "EXTRACTED_RECEIPT_LINE",
                                   existing=ev_tasks, as_of=TASK_TS)
        tasks = ev_tasks.unionByName(rc_tasks)
        # tasks of final orders have been resolved since
        return dml.merge_matched(tasks, self.s.resolution, "source_id", {
            "status": F.lit("RESOLVED"), "resolved_at": F.col("u.resolved_at")})


# ----------------------------------------------------------------- dims

@query("dim_date_orders")
def q_dim_date(spark, sf):
    return D.dim_date_covering(DriverSilver(spark, sf).raw("orders"), "o_orderdate")


@query("dim_vehicle")
def q_dim_vehicle(spark, sf):
    return Gold(spark, sf).dim_vehicle


@query("dim_staff")
def q_dim_staff(spark, sf):
    return Gold(spark, sf).dims["staff"]


@query("dim_part")
def q_dim_part(spark, sf):
    return Gold(spark, sf).dims["part"]


@query("dim_customer")
def q_dim_customer(spark, sf):
    return Gold(spark, sf).dims["customer"]


@query("dim_vendor")
def q_dim_vendor(spark, sf):
    return Gold(spark, sf).dims["vendor"]


@query("dim_branch")
def q_dim_branch(spark, sf):
    return Gold(spark, sf).dims["branch"]


@query("dim_auction_house")
def q_dim_auction(spark, sf):
    return Gold(spark, sf).dims["auction_house"]


@query("dim_data_source")
def q_dim_source(spark, sf):
    return Gold(spark, sf).dims["source"]


# ----------------------------------------------------------------- facts

@query("fact_purchase")
def q_fact_purchase(spark, sf):
    return money_out(Gold(spark, sf).fact_purchase())


@query("fact_repair")
def q_fact_repair(spark, sf):
    return money_out(Gold(spark, sf).fact_repair())


@query("fact_sale")
def q_fact_sale(spark, sf):
    return money_out(Gold(spark, sf).fact_sale())


@query("fact_profit")
def q_fact_profit(spark, sf):
    return money_out(Gold(spark, sf).fact_profit())


@query("profit_summary")
def q_profit_summary(spark, sf):
    return money_out(P.profit_summary(Gold(spark, sf).fact_profit()))


@query("top_profits")
def q_top_profits(spark, sf):
    fp = Gold(spark, sf).fact_profit().filter(F.col("profit_ngn").isNotNull())
    return money_out(RP.top_k(fp, "profit_ngn", 10, "vehicle_key",
                              ["vehicle_key", "total_cost_ngn", "total_revenue_ngn", "profit_ngn", "margin_pct"]))


@query("profit_history_append")
def q_profit_history(spark, sf):
    """Two runs appended: the first snapshot (repair lines shipped by the
    cut-off only), then the re-run audit of vehicles whose profit changed."""
    g = Gold(spark, sf)
    dv = g.dim_vehicle
    early_lines = g.s.repair_job_part.filter(F.col("created_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    first = P.fact_profit(dv, g.fact_purchase(False), FX.fact_repair(early_lines, g.s.repair_job, dv),
                          g.fact_sale(False), as_of="2001-01-01 00:00:00")
    hist = P.profit_snapshot(first, None, "initial calculation")
    changes = P.profit_changes(g.fact_profit(), hist, "late repair costs")
    cols = ["profit_history_key", "vehicle_key", "total_cost_ngn", "profit_ngn", "reason"]
    return money_out(hist.select(*cols).unionByName(changes.select(*cols)))


@query("fact_expense")
def q_fact_expense(spark, sf):
    g = Gold(spark, sf)
    li = g.s.raw("lineitem")
    expense = li.select(
        F.col("l_orderkey").alias("vehicle_id"),
        F.when(F.col("l_returnflag") == "A", "CUSTOMS").when(F.col("l_returnflag") == "N", "TRANSPORT")
        .when(F.col("l_returnflag") == "R", "REPAIR").otherwise("MISC").alias("category"),
        (F.col("l_extendedprice").cast("decimal(14,2)") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(14,2)")
        .alias("amount"), F.lit("NGN").alias("currency"), F.to_date("l_shipdate").alias("expense_date"),
        F.col("l_linenumber").cast("long").alias("source_id"))
    return money_out(FX.fact_expense(expense, g.dim_vehicle, g.dims))


@query("fact_profit_incremental")
def q_profit_incremental(spark, sf):
    """The profit fact brought up to date by what changed alone: late repair
    lines (a batch of their own), corrected prices of the first source's
    purchases, and sales that were booked as reversed at first."""
    g, root = Gold(spark, sf), f"{ensure_checkpoint_dir(spark).rstrip('/')}/lotline-tables/{uuid.uuid4().hex}"
    s, dv = g.s, g.dim_vehicle
    late = F.col("created_at") >= F.lit("1998-01-01").cast("timestamp_ntz")
    write_table(s.repair_job_part.withColumn("batch", F.when(late, 2).otherwise(1)), root, "silver", "repair_job_part", partition_by=["batch"])
    half = (F.col("price_amount") / 2).cast("decimal(14,2)")
    write_version(s.purchase.withColumn("price_amount", F.when(F.col("source_id") == 1, half).otherwise(F.col("price_amount"))), root, "silver", "purchase")
    write_version(s.purchase, root, "silver", "purchase")
    write_version(s.sale.withColumn("status", F.when(F.col("status") == "PENDING_PAYMENT", "REVERSED").otherwise(F.col("status"))), root, "silver", "sale")
    write_version(s.sale, root, "silver", "sale")
    repair_job = cut_lineage(s.repair_job)
    at = lambda table, n: read_version(spark, root, "silver", table, n)
    lines = read_table(spark, root, "silver", "repair_job_part")
    old = cut_lineage(P.fact_profit(dv, FX.fact_purchase(at("purchase", 1), dv), FX.fact_repair(lines.filter("batch = 1"), repair_job, dv),
                                    FX.fact_sale(at("sale", 1), dv), as_of="2001-01-01 00:00:00"))
    new_lines = FX.fact_repair(lines.filter("batch > 1").withColumn("weight", F.lit(1).cast("long")), repair_job, dv, keep=["weight"])
    # rows are told apart by what the facts take of them
    changed = IN.signed_changes(at("purchase", 1), at("purchase", 2), ["vehicle_id", "purchase_date", "price_amount"])
    repriced = FX.fact_purchase(changed, dv, keep=["weight"])
    resold = FX.fact_sale(IN.signed_changes(at("sale", 1), at("sale", 2), ["vehicle_id", "sale_date", "agreed_price", "status"]), dv)
    return money_out(IN.refresh_profit(old, dv, [(new_lines, "line_cost_ngn"), (repriced, "price_amount_ngn")], resold,
                                       FX.fact_sale(at("sale", 2), dv), as_of=RUN_TS))


# ----------------------------------------------------------------- lifecycle

@query("fact_vehicle_lifecycle")
def q_lifecycle(spark, sf):
    return Gold(spark, sf).lifecycle()


@query("avg_cycle_days")
def q_avg_cycle(spark, sf):
    return RP.avg_cycle_days(Gold(spark, sf).lifecycle())


@query("top_longest_cycles")
def q_top_cycles(spark, sf):
    return RP.top_k(Gold(spark, sf).lifecycle(), "total_days_purchase_to_sale", 10, "vehicle_key",
                    ["vehicle_key", "current_stage", "total_days_purchase_to_sale"])


@query("stage_history_events")
def q_hist_events(spark, sf):
    return Gold(spark, sf).events_history()


@query("stage_history_vehicles")
def q_hist_vehicles(spark, sf):
    return Gold(spark, sf).vehicle_history()


@query("vehicle_stage_sync")
def q_stage_sync(spark, sf):
    g = Gold(spark, sf)
    v = L.sync_current_stage(g.s.vehicle, g.vehicle_history(), as_of=RUN_TS)
    return v.select("vehicle_id", "current_stage", "current_status", "updated_at")


@query("time_in_stage")
def q_time_in_stage(spark, sf):
    sla = spark.createDataFrame([(s, d) for s, d in zip(EVENT_STAGES, (3, 2, 2, 5, 1))],
                                "stage string, sla_days int")
    return L.time_in_stage(Gold(spark, sf).events_history(), sla, as_of="2024-01-31 00:00:00")


@query("stage_duration_quantiles")
def q_quantiles(spark, sf):
    """Exact median, 90 % and 99 % of the microseconds that users stay in a state."""
    v = q_scd2(spark, sf).filter("effective_to is not null")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    spent = cut_lineage(v.select("event_type", (micros("effective_to") - micros("effective_from")).alias("micros")))
    return QU.exact_quantiles(spent, "event_type", "micros", [0.5, 0.9, 0.99])


@query("stage_stock_by_day")
def q_stock(spark, sf):
    """How many vehicles are in each stage on each day."""
    return L.stage_stock_by_day(Gold(spark, sf).vehicle_history())


@query("listing_sold_sync")
def q_listing_sync(spark, sf):
    g = Gold(spark, sf)
    sold = g.s.sale.filter(F.col("status").isin("FINALIZED", "PENDING_PAYMENT")).select("vehicle_id")
    out = dml.update_where_in(g.s.listing, sold, "vehicle_id",
                              {"status": F.lit("SOLD"), "updated_at": F.lit(RUN_TS).cast("timestamp_ntz")})
    return money_out(out)


# ----------------------------------------------------------------- reports

@query("status_shipment")
def q_st_ship(spark, sf):
    return RP.breakdown(DriverSilver(spark, sf).shipment, "shipment_status")


@query("status_clearance")
def q_st_clear(spark, sf):
    return RP.breakdown(DriverSilver(spark, sf).port_arrival, "clearance_status")


@query("status_inspection")
def q_st_insp(spark, sf):
    return RP.breakdown(DriverSilver(spark, sf).inspection, "round_no", "overall_result")


@query("status_repair")
def q_st_repair(spark, sf):
    return RP.breakdown(DriverSilver(spark, sf).repair_job, "status")


@query("status_sale")
def q_st_sale(spark, sf):
    return RP.breakdown(DriverSilver(spark, sf).sale, "status")


@query("status_cleaning")
def q_st_clean(spark, sf):
    return RP.breakdown(DriverSilver(spark, sf).cleaning_task, "status")


@query("status_listing")
def q_st_listing(spark, sf):
    return RP.breakdown(q_listing_sync(spark, sf), "status")


@query("status_report")
def q_st_report(spark, sf):
    """All status breakdowns with subtotals and totals, in one aggregation."""
    g = Gold(spark, sf)
    s = g.s
    return RP.status_report([
        ("shipment", s.shipment, ["shipment_status"]), ("clearance", s.port_arrival, ["clearance_status"]),
        ("inspection", s.inspection, ["round_no", "overall_result"]), ("repair", s.repair_job, ["status"]),
        ("cleaning", s.cleaning_task, ["status"]), ("sale", s.sale, ["status"]), ("vehicle", s.vehicle, ["current_stage", "current_status"])])


@query("first_purchases")
def q_first_purchases(spark, sf):
    return money_out(RP.first_k(DriverSilver(spark, sf).purchase, "vehicle_id", 10,
                                ["vehicle_id", "price_amount", "purchase_date"]))


@query("landed_events")
def q_landed(spark, sf):
    raw = land_raw(spark, f"{sf.rstrip('/')}/events.parquet",
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", fmt="parquet", as_of=RUN_TS)
    return raw.withColumn("source_file", F.regexp_extract("source_file", r"[^/]+$", 0))


@query("status_dim_vehicle")
def q_st_dim(spark, sf):
    return RP.breakdown(Gold(spark, sf).dim_vehicle, "stage", "status")


# ----------------------------------------------------------------- rules

@query("shipments")
def q_shipments(spark, sf):
    return DriverSilver(spark, sf).shipment.select("vehicle_id", "etd", "eta", "ata", "shipment_status")


@query("port_arrivals")
def q_port(spark, sf):
    return DriverSilver(spark, sf).port_arrival.select("vehicle_id", "arrival_date", "clearance_status",
                                                       "cleared_date", "hold_reason")


@query("pickups")
def q_pickups(spark, sf):
    return DriverSilver(spark, sf).intake.select("vehicle_id", "pickup_date", "intake_date")


def _open_lines(s: DriverSilver) -> DataFrame:
    """Open lines of orders whose first inspection failed: the failed items."""
    fail1 = s.inspection_r1.filter(F.col("overall_result") == "FAIL").select("inspection_id", "vehicle_id")
    li = s.raw("lineitem").filter("l_linestatus = 'O'")
    return fail1.join(li, F.col("vehicle_id") == F.col("l_orderkey")).select(
        "inspection_id", F.col("l_linenumber").cast("long").alias("item_id"), "l_partkey", "l_returnflag")


def _results(s: DriverSilver) -> DataFrame:
    return R.expand_checklist(s.inspection, s.checklist, _open_lines(s))


@query("inspection_results")
def q_results(spark, sf):
    return _results(DriverSilver(spark, sf))


@query("damage_items")
def q_damage(spark, sf):
    s = DriverSilver(spark, sf)
    found = _open_lines(s).groupBy("inspection_id", "item_id").agg(
        F.min("l_partkey").alias("part_id"), F.max("l_returnflag").alias("_flag"))
    found = found.select("inspection_id", "item_id", "part_id", lookup(F.col("_flag"), SEVERITY_OF_FLAG).alias("severity"))
    damage = R.damage_items(_results(s), found).withColumn("damage_id", F.col("inspection_id") * 10 + F.col("item_id"))
    return damage.select("damage_id", "inspection_id", "item_id", "part_id", "severity")


@query("repair_jobs")
def q_repair_jobs(spark, sf):
    return DriverSilver(spark, sf).repair_job


@query("latest_passed")
def q_latest_passed(spark, sf):
    return R.latest_passed(DriverSilver(spark, sf).inspection)


@query("cleaning_tasks")
def q_cleaning(spark, sf):
    return DriverSilver(spark, sf).cleaning_task


@query("repair_cost")
def q_repair_cost(spark, sf):
    s = DriverSilver(spark, sf)
    return money_out(R.repair_cost(s.repair_job_part, s.repair_job))


@query("listings")
def q_listings(spark, sf):
    return money_out(DriverSilver(spark, sf).listing.select("listing_id", "vehicle_id", "price_amount",
                                                            "listed_date"))


def _matured(s: DriverSilver) -> DataFrame:
    terms = s.plan.select("vehicle_id", "sale_days", "discount", "installment")
    return R.matured_sales(s.listing.join(terms, "vehicle_id"), AS_OF)


@query("matured_sales")
def q_matured(spark, sf):
    return money_out(_matured(DriverSilver(spark, sf)).select("vehicle_id", "sale_date", "agreed_price"))


@query("first_payments")
def q_payments(spark, sf):
    return money_out(R.first_payment(_matured(DriverSilver(spark, sf)))
                     .select("vehicle_id", "sale_status", "payment_amount"))


# ----------------------------------------------------------------- triage

@query("extracted_event")
def q_extracted(spark, sf):
    return Gold(spark, sf).extracted_event().drop("reviewed_at")


@query("receipt_scores")
def q_receipts(spark, sf):
    return money_out(Gold(spark, sf).receipt_lines().select("line_id", "vehicle_id", "amount",
                                                           "confidence_score", "review_status"))


@query("receipt_matches")
def q_receipt_matches(spark, sf):
    """Receipt lines and the purchases of their day and currency, matched one to one within 5 %."""
    s = Gold(spark, sf).s
    lines = cut_lineage(s.receipt_line.select("line_id", "currency", "receipt_date", "amount"))
    bought = cut_lineage(s.purchase.select("purchase_id", F.col("price_currency").alias("currency"), F.col("purchase_date").alias("receipt_date"), "price_amount"))
    pairs = MA.match_amounts(lines, bought, ["currency", "receipt_date"], "amount", "price_amount", "line_id", "purchase_id", 0.05)
    out = lines.join(pairs, "line_id", "left").join(bought.select("purchase_id", "price_amount"), "purchase_id", "left")
    return money_out(out.select("line_id", "purchase_id", "amount", "price_amount"))


@query("review_tasks")
def q_review_tasks(spark, sf):
    return Gold(spark, sf).review_tasks()


@query("fact_review_queue")
def q_review_queue(spark, sf):
    g = Gold(spark, sf)
    ev, rc = g.extracted_event(), g.receipt_lines()
    return TR.fact_review_queue(g.review_tasks(), ev, rc, g.dims["staff"], g.dims["source"])


@query("review_kpis")
def q_review_kpis(spark, sf):
    return RP.review_kpis(q_review_queue(spark, sf))


@query("status_review")
def q_st_review(spark, sf):
    return RP.breakdown(Gold(spark, sf).review_tasks(), "source_type", "status")


# ----------------------------------------------------------------- declared

@query("scd2_user_versions")
def q_scd2(spark, sf):
    ev = DriverSilver(spark, sf).raw("events")
    return scd2.scd2_from_changes(ev, "user_id", ["event_type"], "ts", "event_id", surrogate="version_key")


@query("scd2_apply_batch")
def q_scd2_apply(spark, sf):
    """Versions from events before the cut-off, then one batch: each user's
    last event type after the cut-off."""
    ev = DriverSilver(spark, sf).raw("events")
    cut = F.lit(EVENTS_CUTOFF).cast("timestamp_ntz")
    dim = scd2.scd2_from_changes(ev.filter(F.col("ts") < cut), "user_id", ["event_type"], "ts", "event_id",
                                 surrogate="version_key")
    dim = dim.withColumn("effective_to", F.coalesce("effective_to", F.lit(None).cast("timestamp_ntz")))
    changes = dml.dedup_latest(ev.filter(F.col("ts") >= cut).select("user_id", "event_type", "ts", "event_id"),
                               "user_id", ["ts", "event_id"]).select("user_id", "event_type")
    return scd2.scd2_apply(dim, changes, "user_id", ["event_type"], "2024-01-31 00:00:00", surrogate="version_key")


@query("state_as_of")
def q_state_as_of(spark, sf):
    v = q_scd2(spark, sf)
    return scd2.state_as_of(v, EVENTS_CUTOFF).select("user_id", "event_type", "effective_from")


@query("state_as_of_join")
def q_state_as_of_join(spark, sf):
    """Each event's user a day before the event: the state then, if there was one."""
    v = cut_lineage(q_scd2(spark, sf))
    times = DriverSilver(spark, sf).raw("events").select("event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("asked_at"))
    found = scd2.state_as_of_join(times, v.withColumnRenamed("event_type", "state"), "user_id", "asked_at", ["state", "version_key"])
    return found.select("event_id", "user_id", "asked_at", "state", "version_key")


@query("scd2_late_changes")
def q_scd2_late(spark, sf):
    """All changes in three batches that are mixed in time, the last third first."""
    ev = DriverSilver(spark, sf).raw("events").select("user_id", "event_type", "ts", "event_id")
    batch = lambda i: ev.filter(F.col("event_id") % 3 == i)
    dim = cut_lineage(scd2.scd2_from_changes(batch(2), "user_id", ["event_type"], "ts", "event_id", surrogate="version_key"))
    log = batch(2)
    for i in (0, 1):
        dim, log = scd2.scd2_splice(dim, log, batch(i), "user_id", ["event_type"], "ts", "event_id", surrogate="version_key")
        dim = cut_lineage(dim)
    return dim.drop("version_key")


@query("dedup_messages")
def q_dedup(spark, sf):
    conv = DriverSilver(spark, sf).raw("conversations")
    a = conv.withColumn("ingested_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    b = conv.withColumn("ingested_at", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")) \
        .withColumn("text", F.concat("text", F.lit(" (edited)")))
    return dml.dedup_latest(a.unionByName(b), ["conv_id", "turn"], "ingested_at")


@query("upsert_vehicles")
def q_upsert(spark, sf):
    """Base: vehicles of the first order years; load: all vehicles, their stage
    changed, of which those before the watermark are not taken."""
    v = DriverSilver(spark, sf).vehicle
    base = v.filter(F.col("updated_at") < F.lit("1998-07-01").cast("timestamp_ntz"))
    load = v.withColumn("current_stage", F.concat(F.col("current_stage"), F.lit("_LOADED")))
    out = dml.upsert_since(base, load, "vehicle_id", "1998-01-01 00:00:00", tie_break="vin")
    return out.select("vehicle_id", "current_stage", "current_status", "updated_at")


@query("soft_delete_reversed")
def q_soft_delete(spark, sf):
    s = DriverSilver(spark, sf)
    ids = s.sale.filter(F.col("status") == "REVERSED").select("vehicle_id")
    out = dml.soft_delete(s.vehicle, ids, "vehicle_id", RUN_TS)
    return out.select("vehicle_id", "is_deleted", "deleted_at")


@query("contract_violations")
def q_violations(spark, sf):
    g = Gold(spark, sf)
    s = g.s
    v = Q.violations(s.repair_job_part, "repair_job_part", not_null=["line_id", "part_id"], unique=[["line_id"]],
                     foreign_keys=[("part_id", s.part, "part_id"), ("repair_job_id", s.repair_job, "repair_job_id")])
    p = Q.violations(s.purchase, "purchase", not_null=["vehicle_id", "price_amount"], unique=[["purchase_id"]],
                     allowed={"price_currency": ["USD", "NGN"]},
                     foreign_keys=[("buyer_staff_id", s.staff, "staff_id")])
    rt = Q.violations(g.review_tasks(), "review_task", not_null=["source_id"],
                      allowed={"status": ["OPEN", "IN_PROGRESS", "RESOLVED", "DISMISSED"]},
                      polymorphic=[("source_type", "source_id", {
                          "EXTRACTED_EVENT": (s.raw_message, "message_id"),
                          "EXTRACTED_RECEIPT_LINE": (s.receipt_line, "line_id")})])
    return v.unionByName(p).unionByName(rt)


@query("contract_quarantine")
def q_quarantine(spark, sf):
    """Rows of nine tables that break a rule, each with its reasons, beside
    the number of the table's clean rows (``row_key`` null).  The vehicle
    table is the one without deleted vehicles, so what refers to them fails."""
    s = DriverSilver(spark, sf)
    tables = {"vehicle": s.vehicle.filter("not is_deleted"), "branch": s.branch, "staff": s.staff, "part": s.part, "vendor": s.vendor,
              "purchase": s.purchase, "sale": s.sale, "repair_job": s.repair_job, "repair_job_part": s.repair_job_part}
    ref = CO.Reference
    contracts = {
        "vehicle": CO.Contract("vehicle_id", ["vehicle_id", "branch_id"], [["vin"], ["make", "model", "model_year"]], {}, [ref("branch_id", "branch")]),
        "branch": CO.Contract("branch_id", ["branch_id", "name"], [["name"]]),
        "staff": CO.Contract("staff_id", ["staff_id", "name"], [["staff_id"]], {}, [ref("branch_id", "branch")]),
        "part": CO.Contract("part_id", ["part_id", "name"]),
        "vendor": CO.Contract("vendor_id", ["vendor_id", "name"], [["name"]]),
        "purchase": CO.Contract("purchase_id", ["vehicle_id", "price_amount"], [["purchase_id"]], {"price_currency": ["USD", "NGN"]},
                                [ref("vehicle_id", "vehicle"), ref("buyer_staff_id", "staff")]),
        "sale": CO.Contract("sale_id", ["vehicle_id", "customer_id"], [["sale_id"]], {"status": ["FINALIZED", "PENDING_PAYMENT"]},
                            [ref("vehicle_id", "vehicle"), ref("salesperson_staff_id", "staff")]),
        "repair_job": CO.Contract("repair_job_id", ["vehicle_id", "start_date"], [["repair_job_id"]], {"status": ["COMPLETED", "IN_PROGRESS", "PENDING", "BLOCKED_WAITING_PART"]},
                                  [ref("vehicle_id", "vehicle")]),
        "repair_job_part": CO.Contract("line_id", ["qty", "unit_cost"], [["line_id"]], {},
                                       [ref("repair_job_id", "repair_job"), ref("part_id", "part"), ref("vendor_id", "vendor")]),
    }
    out = None
    for name, (clean, rejected) in CO.quarantine(tables, contracts).items():
        bad = rejected.select(F.lit(name).alias("table"), F.col(contracts[name].key).alias("row_key"), F.array_join("reasons", ";").alias("reasons"), F.lit(None).cast("long").alias("clean"))
        good = clean.agg(F.count(F.lit(1)).alias("clean")).select(F.lit(name).alias("table"), F.lit(None).cast("long").alias("row_key"), F.lit(None).cast("string").alias("reasons"), "clean")
        both = bad.unionByName(good)
        out = both if out is None else out.unionByName(both)
    return out


@query("source_mix")
def q_source_mix(spark, sf):
    s = DriverSilver(spark, sf)
    return Q.source_mix([("purchase", s.purchase), ("sale", s.sale), ("repair_job", s.repair_job)])


@query("source_mix_by_branch_and_date")
def q_source_mix_keys(spark, sf):
    s = DriverSilver(spark, sf)
    branch = s.vehicle.select("vehicle_id", "branch_id")
    of = lambda df, day: df.join(branch, "vehicle_id").withColumn("day", F.col(day))
    return Q.source_mix([("purchase", of(s.purchase, "purchase_date")), ("sale", of(s.sale, "sale_date"))], keys=["branch_id", "day"])


@query("payload_fields")
def q_payload(spark, sf):
    ev = DriverSilver(spark, sf).raw("events")
    return explode_payload(ev, "props", "k int", keep=("event_id", "event_type"))


@query("landed_rejected")
def q_landed_rejected(spark, sf):
    """Events as JSON lines in two folders, of which some are cut off, hold a
    value of another type, or have a field more: landed folder by folder, and
    all once more.  Records and rejected lines."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lotline-tables/{uuid.uuid4().hex}"
    ev = DriverSilver(spark, sf).raw("events")
    kind = F.col("event_type")
    line = (F.when(kind == "error", F.format_string('{"event_id":%d,"user_id":', "event_id"))
            .when(kind == "signup", F.format_string('{"event_id":%d,"user_id":"user %d","event_type":"%s"}', "event_id", "user_id", "event_type"))
            .when(kind == "click", F.format_string('{"event_id":%d,"user_id":%d,"event_type":"%s","device":"d%d"}', "event_id", "user_id", "event_type", F.col("user_id") % 7))
            .otherwise(F.format_string('{"event_id":%d,"event_type":"%s"}', "event_id", "event_type")))
    lines = ev.select(line.alias("value"), F.when(F.col("value") > 50, "a").otherwise("b").alias("folder"))
    lines.write.partitionBy("folder").text(f"{root}/incoming")
    schema = "event_id long, user_id long, event_type string"
    land = lambda path: land_files(spark, path, root, "events", schema, as_of=RUN_TS)
    land(f"{root}/incoming/folder=a")
    land(f"{root}/incoming")
    land(f"{root}/incoming")
    good = read_landed(spark, root, "events").select(
        "event_id", "user_id", "event_type", F.col("extra")["device"].alias("device"), F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("reason"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("event_id", "long"), ("user_id", "long"), ("event_type", "string"), ("device", "string"))]
    return good.unionByName(read_landed(spark, root, "events", rejected=True).select(*none, "record", "reason"))


@query("payload_items")
def q_payload_items(spark, sf):
    """The array branch of a payload: the letters' groups of each event's type, empty and missing arrays included."""
    ev = DriverSilver(spark, sf).raw("events")
    parts = F.when(F.col("event_type") == "view", F.array().cast("array<string>")).when(F.col("event_type") != "error", F.split("event_type", "[cs]"))
    raw = ev.select("event_id", F.to_json(F.struct(F.col("user_id").alias("u"), parts.alias("parts"))).alias("payload"))
    return explode_payload(raw, "payload", "u long, parts array<string>", array_col="parts", keep=("event_id",)).withColumnRenamed("parts", "part")


@query("customers_by_name")
def q_by_name(spark, sf):
    """Dense keys over a string column, and previous and next rows (W-2, W-6)."""
    c = DriverSilver(spark, sf).raw("customer").select("c_name", "c_mktsegment")
    k = dense_key(c, ["c_mktsegment", "c_name"], "name_key", prev=["c_name"], nxt=["c_name"])
    return k.select("name_key", "c_mktsegment", "c_name", F.col("_prev.c_name").alias("prev_name"), F.col("_next.c_name").alias("next_name"))


@query("sold_by_date")
def q_sold_by_date(spark, sf):
    """Dense keys over a column with nulls (nulls first), hot days and ties split by the order key."""
    o = DriverSilver(spark, sf).raw("orders")
    sold = F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate"))
    return dense_key(o.select(sold.alias("sold_date"), "o_orderkey"), ["sold_date", "o_orderkey"], "sale_no")


@query("status_sale_ordered")
def q_st_sale_ordered(spark, sf):
    """Breakdown in order, the largest count first (L-1, L-2), with its place."""
    b = RP.breakdown(DriverSilver(spark, sf).sale, "status")
    return dense_key(b.withColumn("_minus", -F.col("count")), ["_minus", "status"], "place").drop("_minus")


@query("fact_profit_with_expenses")
def q_profit_expenses(spark, sf):
    g = Gold(spark, sf)
    li = g.s.raw("lineitem")
    expense = li.select(F.col("l_orderkey").alias("vehicle_id"), F.lit("CUSTOMS").alias("category"),
                        (F.col("l_extendedprice").cast("decimal(14,2)") * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(14,2)").alias("amount"),
                        F.lit("NGN").alias("currency"), F.to_date("l_shipdate").alias("expense_date"), F.lit(None).cast("long").alias("source_id"))
    expenses = FX.fact_expense(expense, g.dim_vehicle, None)
    return money_out(P.fact_profit(g.dim_vehicle, g.fact_purchase(False), g.fact_repair(False), g.fact_sale(False),
                                   as_of=RUN_TS, expense=expenses))


@query("benchmark_in_documents")
def q_contained(spark, sf):
    """Documents that hold a benchmark passage word for word (J-9, J-10)."""
    s = DriverSilver(spark, sf)
    return TR.contains_join(s.raw("documents").select("doc_id", "text"), s.raw("benchmark"), text_id="doc_id", text="text",
                            pattern_id="item_id", pattern="text", k=24)


@query("versioned_listing")
def q_versioned(spark, sf):
    """Write all orders, rewrite them without the pending ones as a new version, append those, and read back (S-1, S-10, S-11)."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lotline-tables/{uuid.uuid4().hex}"
    o = DriverSilver(spark, sf).raw("orders").select("o_orderkey", "o_orderstatus", F.lit(0).alias("version"))
    write_table(o, root, "silver", "orders")
    write_version(read_table(spark, root, "silver", "orders").filter("o_orderstatus <> 'P'").withColumn("version", F.lit(1)), root, "silver", "orders")
    write_table(o.filter("o_orderstatus = 'P'").withColumn("version", F.lit(2)), root, "silver", "orders", mode="append")
    return read_table(spark, root, "silver", "orders")


def registry() -> dict[str, QueryFn]:
    return dict(REGISTRY)
