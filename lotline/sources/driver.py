"""Role mapping: the driver's TPC-H-like tables projected into the shapes of
the dealership tables (FIXTURES.md §4).

Every table here is derived by Spark from the given parquet files, so the
work of every query grows with them.  What the rules of ``operators.rules``
take as input columns (days, flags, rates) comes from the order's own lines:
quantities, flags, discounts and taxes.  "Today" is the ``as_of`` date.
``plans/oracle.py`` restates the mapping in SQL for the DuckDB oracle, with
its own constants.
"""

from __future__ import annotations

import functools
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions.text import form_id, lookup
from lotline.operators import rules as R
from lotline.operators.keys import dense_key, next_keys
from lotline.session import cut_lineage

AS_OF = "2001-09-01"
FX_RATE = Decimal("1600.00")
EVENT_STAGES = ("signup", "view", "click", "purchase", "error")
# checklist items are the line numbers of an order's lines, with a category
CHECKLIST = ((1, "ENGINE"), (2, "ENGINE"), (3, "BODY"), (4, "BODY"), (5, "ELECTRICAL"), (6, "ELECTRICAL"), (7, "INTERIOR"), (8, "TIRES"))
SEVERITY_OF_FLAG = {"N": "LOW", "A": "MEDIUM", "R": "HIGH"}
# one keyword of the classifier per priority; 5-LOW has none
KEYWORD_OF_PRIORITY = {"1-URGENT": "arrived", "2-HIGH": "customs", "3-MEDIUM": "fixed", "4-NOT SPECIFIED": "picked up"}


def lot_no(key, status) -> "F.Column":
    """Auction lot; pending orders have one of another shape."""
    return F.when(status == "P", F.format_string("Hall %d/P", key)).otherwise(F.format_string("LOT-%05d", key))


def source_of(priority: str) -> "F.Column":
    """Source id: the number that an order's priority begins with."""
    return F.substring(priority, 1, 1).cast("long")


class DriverSilver:
    """Lazily built silver-shaped DataFrames over one driver scale dir.

    Tables that several steps of one query read (vehicle, sale, the plan, the
    rule-chain stages, cleaning, listing) are silver-table boundaries, written to the
    shared checkpoint folder and read back, as a pipeline writes its silver
    layer before it builds gold.  An instance serves one query; nothing is
    kept from one query to the next.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF, materialize_chain: bool = True):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir.rstrip("/"), as_of
        self.materialize_chain = materialize_chain
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """One scan per table and instance (schema read once, plans share it)."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def _boundary(self, df: DataFrame) -> DataFrame:
        return cut_lineage(df) if self.materialize_chain else df

    # ------------------------------------------------------------ lookups
    @functools.cached_property
    def branch(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").cast("long").alias("branch_id"),
                                         F.col("n_name").alias("name"), F.lit(None).cast("string").alias("address"),
                                         F.lit(True).alias("is_active"))

    @functools.cached_property
    def auction_house(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").cast("long").alias("auction_house_id"),
                                         F.col("r_name").alias("name"), F.lit(None).cast("string").alias("country"))

    @functools.cached_property
    def vendor(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("name"))

    @functools.cached_property
    def part(self) -> DataFrame:
        return self.raw("part").select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("name"),
                                       F.col("p_type").alias("category"))

    @functools.cached_property
    def customer(self) -> DataFrame:
        return self.raw("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                                           F.lit(None).cast("string").alias("phone"))

    @functools.cached_property
    def data_source(self) -> DataFrame:
        """Upper-cased event types plus the two agent codes, ids 1..n by code."""
        codes = (self.raw("events").select(F.upper("event_type").alias("source_code")).distinct()
                 .unionByName(self.spark.createDataFrame([("WHATSAPP_GROUP_AGENT",), ("RECEIPT_AGENT",)],
                                                         "source_code string"))
                 .distinct())
        return dense_key(codes, "source_code", "source_id").select("source_id", "source_code")

    @functools.cached_property
    def staff(self) -> DataFrame:
        """Every customer doubles as a member of staff."""
        return (self.raw("customer")
                .select(F.col("c_custkey").alias("staff_id"), F.col("c_nationkey").cast("long").alias("branch_id"),
                        F.col("c_name").alias("name"), F.lit(True).alias("is_active")))

    @functools.cached_property
    def staff_role(self) -> DataFrame:
        c = self.raw("customer")
        seg = c.select(F.col("c_custkey").alias("staff_id"), F.col("c_mktsegment").alias("role_code"))
        extra = c.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("staff_id"),
                                                             F.lit("INSPECTOR").alias("role_code"))
        return seg.unionByName(extra).select("staff_id", "role_code", F.lit(None).cast("date").alias("valid_from"),
                                             F.lit(None).cast("date").alias("valid_to"))

    @functools.cached_property
    def checklist(self) -> DataFrame:
        return self.spark.createDataFrame([(i, c, True, i) for i, c in CHECKLIST],
                                          "item_id long, category string, is_active boolean, sort_order long")

    # ------------------------------------------------------------ vehicles
    @functools.cached_property
    def orders_plus(self) -> DataFrame:
        """Orders with the customer's name, nation and region (left joins)."""
        c = self.raw("customer").select("c_custkey", "c_name", "c_nationkey")
        n = self.raw("nation").select("n_nationkey", "n_regionkey")
        return (self.raw("orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left"))

    @functools.cached_property
    def vehicle(self) -> DataFrame:
        return self._boundary(self.vehicle_rows)

    @functools.cached_property
    def vehicle_rows(self) -> DataFrame:
        """The vehicles, not written: for steps that read them once, and write what they make of them."""
        o = self.orders_plus
        k = F.col("o_orderkey")
        deleted = F.col("o_totalprice") < 10000
        return o.select(
            k.alias("vehicle_id"), F.format_string("VIN%014d", k).alias("vin"), lot_no(k, F.col("o_orderstatus")).alias("auction_lot_no"),
            F.col("o_orderpriority").alias("make"), F.col("c_name").alias("model"),
            F.year("o_orderdate").alias("model_year"), F.col("c_nationkey").cast("long").alias("branch_id"),
            F.when(F.col("o_orderstatus") == "F", "SOLD").when(F.col("o_orderstatus") == "P", "LISTED")
            .otherwise("IN_REPAIR").alias("current_stage"),
            F.when(F.col("o_orderstatus") == "F", "SOLD").otherwise("ACTIVE").alias("current_status"),
            F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"),
            deleted.alias("is_deleted"), F.when(deleted, F.col("o_orderdate")).alias("deleted_at"))

    @functools.cached_property
    def purchase(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.orders_plus.select(
            k.alias("purchase_id"), k.alias("vehicle_id"), F.col("n_regionkey").cast("long").alias("auction_house_id"),
            F.col("o_custkey").alias("buyer_staff_id"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("price_amount"), F.lit("USD").alias("price_currency"),
            F.to_date("o_orderdate").alias("purchase_date"), F.lit("CONFIRMED").alias("status"),
            source_of("o_orderpriority").alias("source_id"), form_id("FORM-PUR", k).alias("source_record_id"),
            F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"),
            F.lit(False).alias("is_deleted"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"))

    @functools.cached_property
    def sale(self) -> DataFrame:
        li = self.raw("lineitem")
        net = li.groupBy("l_orderkey").agg(
            F.sum(F.col("l_extendedprice").cast("decimal(14,2)")
                  * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(14,2)").alias("agreed_price"),
            F.max(F.to_date("l_shipdate")).alias("sale_date"))
        o = self.raw("orders")
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        return self._boundary(o.join(net, o["o_orderkey"] == net["l_orderkey"]).select(
            k.alias("sale_id"), k.alias("vehicle_id"), k.alias("listing_id"), c.alias("customer_id"),
            c.alias("salesperson_staff_id"), "agreed_price", F.lit("NGN").alias("currency"),
            "sale_date",
            F.when(F.col("o_orderstatus") == "F", "FINALIZED").when(F.col("o_orderstatus") == "P", "PENDING_PAYMENT")
            .otherwise("REVERSED").alias("status"),
            source_of("o_orderpriority").alias("source_id")))

    @functools.cached_property
    def repair_job_part(self) -> DataFrame:
        li = self.raw("lineitem")
        qty = F.col("l_quantity").cast("int")
        unit = (F.col("l_extendedprice").cast("decimal(14,2)") / qty.cast("decimal(10,0)")).cast("decimal(12,2)")
        return li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line_id"),
                         F.col("l_orderkey").alias("repair_job_id"), F.col("l_partkey").alias("part_id"),
                         F.col("l_suppkey").alias("vendor_id"), qty.alias("qty"), unit.alias("unit_cost"),
                         F.lit("NGN").alias("currency"), F.col("l_shipdate").alias("created_at"))

    # ------------------------------------------------------------ rule chain
    @functools.cached_property
    def plan(self) -> DataFrame:
        """Orders with what the rules need, taken from their lines; written, since most steps of the chain read it."""
        pct = lambda c: F.round(F.max(c) * 100).cast("int")
        lines = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.count(F.lit(1)).cast("int").alias("n_lines"), F.max("l_quantity").cast("int").alias("most"), F.min("l_quantity").cast("int").alias("least"),
            F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.bool_and(F.col("l_linestatus") == "F").alias("all_done"),
            pct("l_discount").alias("discount_pct"), pct("l_tax").alias("tax_pct"))
        return self._boundary(self.raw("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.col("o_orderkey").alias("vehicle_id"), F.col("o_custkey").alias("customer_key"), F.to_date("o_orderdate").alias("purchase_date"),
            F.col("most").alias("shipping_days"), F.col("n_lines").alias("clear_days"), F.col("returned").alias("delayed"), F.col("least").alias("extra_days"),
            F.col("o_orderpriority").alias("hold_reason_draw"), F.col("all_done").alias("passed_first"),
            (F.col("n_lines") * 2).alias("repair_days"), (F.col("discount_pct") >= 10).alias("blocked"),
            (F.col("o_orderstatus") != "P").alias("passed_second"), (F.col("tax_pct") >= 8).alias("redo"),
            ((F.lit(120) + F.col("discount_pct") + F.col("tax_pct")).cast("decimal(7,2)") * F.lit(Decimal("0.01"))).cast("decimal(5,2)").alias("markup"),
            F.col("most").alias("sale_days"), (F.col("discount_pct").cast("decimal(7,3)") * F.lit(Decimal("0.01"))).cast("decimal(4,3)").alias("discount"),
            (F.col("o_orderpriority") == "1-URGENT").alias("installment"), source_of("o_orderpriority").alias("source_id")))

    @functools.cached_property
    def shipment(self) -> DataFrame:
        return R.shipment_status(self.plan, self.as_of)

    @functools.cached_property
    def port_arrival(self) -> DataFrame:
        arrived = self.shipment.filter(F.col("shipment_status") == "ARRIVED").withColumn("arrival_date", F.col("ata"))
        return R.clearance_status(arrived, self.as_of)

    @functools.cached_property
    def intake(self) -> DataFrame:
        # a silver table boundary: written once (reliable checkpoint) so the
        # later rules do not re-derive, and re-inline, the whole chain
        return self._boundary(R.pickup_and_intake(self.port_arrival, self.as_of))

    @functools.cached_property
    def inspection_r1(self) -> DataFrame:
        return R.first_inspection(self.intake, self.as_of).withColumn(
            "inspection_id", F.col("vehicle_id") * 10 + 1)

    @functools.cached_property
    def repair_chain(self) -> DataFrame:
        return self._boundary(R.repair_status(self.inspection_r1, self.as_of))

    @functools.cached_property
    def repair_job(self) -> DataFrame:
        k = F.col("vehicle_id")
        return self.repair_chain.select(
            k.alias("repair_job_id"), "vehicle_id", F.col("customer_key").alias("mechanic_staff_id"),
            "start_date", "end_date", F.col("repair_status").alias("status"), "source_id")

    @functools.cached_property
    def inspection(self) -> DataFrame:
        cols = ["inspection_id", "vehicle_id", "inspection_date", "overall_result", "round_no"]
        r2 = R.reinspection(self.repair_chain, self.as_of).withColumn("inspection_id", F.col("vehicle_id") * 10 + 2)
        return self.inspection_r1.select(*cols).unionByName(r2.select(*cols))

    @functools.cached_property
    def cleaning_task(self) -> DataFrame:
        passed = R.latest_passed(self.inspection)
        draws = self.plan.select("vehicle_id", "redo")
        return self._boundary(R.cleaning_tasks(passed.join(draws, "vehicle_id"), self.as_of)
                              .select(F.col("vehicle_id").alias("cleaning_id"), "vehicle_id", "task_date",
                                      F.col("cleaning_status").alias("status")))

    @functools.cached_property
    def listing(self) -> DataFrame:
        costs = R.repair_cost(self.repair_job_part, self.repair_job)
        cleaned = self.cleaning_task.withColumnRenamed("status", "cleaning_status").join(
            self.plan.select("vehicle_id", "markup"), "vehicle_id")
        lp = R.list_price(cleaned, self.purchase, costs, self.as_of, FX_RATE)
        return self._boundary(lp.select(F.col("vehicle_id").alias("listing_id"), "vehicle_id",
                                        F.col("list_price").alias("price_amount"), F.lit("NGN").alias("currency"),
                                        "listed_date", F.lit("ACTIVE").alias("status"),
                                        F.col("listed_date").cast("timestamp_ntz").alias("updated_at")))

    # ------------------------------------------------------------ triage
    @functools.cached_property
    def raw_message(self) -> DataFrame:
        """One message per order: the priority's keyword and what the order's
        status names (F: the lot; O: make and model; P: the odd lot).  And one
        per turn of every conversation, numbered behind them by (conv_id, turn):
        what is said, after the message of the order of the same number, if any."""
        k, status = F.col("o_orderkey"), F.col("o_orderstatus")
        named = F.when(status == "O", F.concat_ws(" ", "o_orderpriority", "c_name")).otherwise(lot_no(k, status))
        about = F.concat_ws(" ", lookup(F.col("o_orderpriority"), KEYWORD_OF_PRIORITY), named)
        orders = self.orders_plus.select(k.alias("_key"), F.col("o_orderdate").alias("sent_at"), about.alias("_about"))
        turns = next_keys(self.raw("conversations").select("conv_id", "turn", "text"), ["conv_id", "turn"], "message_id", self.raw("orders"), "o_orderkey")
        said = turns.join(orders, F.col("conv_id") == F.col("_key"), "left").select(
            "message_id", "sent_at", F.concat_ws(" ", "_about", "text").alias("message_text"))
        both = orders.select(F.col("_key").alias("message_id"), "sent_at", F.col("_about").alias("message_text")).unionByName(said)
        return self._boundary(both.select(
            "message_id", F.lit(1).cast("long").alias("group_id"), F.lit(None).cast("string").alias("sender_phone"), "sent_at", "message_text"))

    @functools.cached_property
    def receipt_line(self) -> DataFrame:
        """One receipt line per purchase: the price paid where the order is
        final, the sum of its lines' prices elsewhere (which differs)."""
        lines = self.raw("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("decimal(14,2)").alias("_lines"))
        o = self.raw("orders").select("o_orderkey", "o_orderstatus")
        p = self.purchase.join(o, F.col("purchase_id") == F.col("o_orderkey")).join(lines, F.col("purchase_id") == F.col("l_orderkey"), "left")
        amount = F.when(F.col("o_orderstatus") == "F", F.col("price_amount")).otherwise(F.coalesce("_lines", "price_amount"))
        return p.select(F.col("purchase_id").alias("line_id"), F.col("purchase_id").alias("receipt_id"),
                        "vehicle_id", amount.alias("amount"), F.col("price_currency").alias("currency"),
                        F.col("purchase_date").alias("receipt_date"))

    @functools.cached_property
    def resolution(self) -> DataFrame:
        """(source_id, resolved_at): final orders' tasks are resolved with their last line."""
        last = self.raw("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("resolved_at"))
        o = self.raw("orders").filter("o_orderstatus <> 'P'").select("o_orderkey")
        return o.join(last, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("source_id"), "resolved_at")

    # ------------------------------------------------------------ events
    @functools.cached_property
    def stage_events(self) -> DataFrame:
        """events as (vehicle_id = user, stage = event type, d = day, tb = event id)."""
        return self.raw("events").select(F.col("user_id").alias("vehicle_id"), F.col("event_type").alias("stage"),
                                         F.to_date("ts").alias("d"), F.col("event_id").alias("tb"))
