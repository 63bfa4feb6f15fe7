"""Vehicle lifecycle: milestones, accumulating-snapshot fact, stage history,
current-stage sync, time in stage (D-9, D-19, D-20, X-6).

Milestones are one tidy DataFrame ``(vehicle_id, m, d, d2, n, flag)``, one
row per source row (purchase, shipment, ...).  The lifecycle fact is one
conditional aggregate over it plus one join to the vehicle keys: two
exchanges instead of eleven for ten aggregate-then-join branches, and the
aggregate is partial (map-side combine), so a hot vehicle does not pile up
in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.dates import date_key, day_diff, midnight
from lotline.operators.facts import current
from lotline.operators.keys import dense_key
from lotline.operators.ordered import ranged, running_total
from lotline.session import cut_lineage

# The stage names in the order the reference lists its
# milestones; the position is the tie-break for stages on the same date.
STAGES = ("PURCHASED", "SHIPPED", "AT_PORT", "CLEARED", "PICKED_UP", "AT_OFFICE",
          "INSPECTING", "IN_REPAIR", "CLEANED", "LISTED", "SOLD")

MILESTONE_SCHEMA = "vehicle_id long, m string, d date, d2 date, n int, flag boolean"


def _m(df: DataFrame, m: str, d, d2=None, n=None, flag=None) -> DataFrame:
    lit_null = F.lit(None)
    return df.select(
        F.col("vehicle_id").cast("long").alias("vehicle_id"), F.lit(m).alias("m"),
        F.col(d).cast("date").alias("d"),
        (F.col(d2).cast("date") if d2 else lit_null.cast("date")).alias("d2"),
        (F.col(n).cast("int") if n else lit_null.cast("int")).alias("n"),
        (flag if flag is not None else lit_null.cast("boolean")).alias("flag"))


def milestones(purchase: DataFrame | None = None, shipment: DataFrame | None = None,
               port_arrival: DataFrame | None = None, pickup: DataFrame | None = None,
               office_intake: DataFrame | None = None, inspection: DataFrame | None = None,
               repair_job: DataFrame | None = None, cleaning_task: DataFrame | None = None,
               listing: DataFrame | None = None, sale: DataFrame | None = None) -> DataFrame:
    """Tagged union of every milestone source (missing sources are skipped)."""
    parts = []
    if purchase is not None:
        parts.append(_m(purchase, "purchase", "purchase_date"))
    if shipment is not None:
        parts.append(_m(shipment, "ship", "etd"))
    if port_arrival is not None:
        parts.append(_m(port_arrival, "port", "arrival_date", "cleared_date",
                        flag=F.col("clearance_status") == "CLEARED"))
    if pickup is not None:
        parts.append(_m(pickup, "pickup", "pickup_date"))
    if office_intake is not None:
        parts.append(_m(office_intake, "intake", "intake_date"))
    if inspection is not None:
        parts.append(_m(inspection, "inspection", "inspection_date", n="round_no",
                        flag=F.col("overall_result") == "PASS"))
    if repair_job is not None:
        parts.append(_m(repair_job, "repair", "start_date", "end_date", flag=F.col("status") == "DONE"))
    if cleaning_task is not None:
        parts.append(_m(cleaning_task, "cleaning", "task_date", flag=F.col("status") == "DONE"))
    if listing is not None:
        parts.append(_m(listing, "listing", "listed_date"))
    if sale is not None:
        parts.append(_m(sale, "sale", "sale_date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _when(m: str, value: Column, cond: Column | None = None) -> Column:
    c = F.col("m") == m
    if cond is not None:
        c = c & cond
    return F.when(c, value)


MILESTONE_AGGS = {
    "purchase_date": lambda: F.min(_when("purchase", F.col("d"))),
    "ship_date": lambda: F.min(_when("ship", F.col("d"))),
    "port_arrival_date": lambda: F.min(_when("port", F.col("d"))),
    "cleared_date": lambda: F.max(_when("port", F.col("d2"), F.col("flag"))),
    "pickup_date": lambda: F.min(_when("pickup", F.col("d"))),
    "office_intake_date": lambda: F.min(_when("intake", F.col("d"))),
    "first_inspection_date": lambda: F.min(_when("inspection", F.col("d"), F.col("n") == 1)),
    "inspection_pass_date": lambda: F.max(_when("inspection", F.col("d"), F.col("flag"))),
    "inspection_rounds_count": lambda: F.max(_when("inspection", F.col("n"))),
    "repair_start_date": lambda: F.min(_when("repair", F.col("d"))),
    "repair_end_date": lambda: F.max(_when("repair", F.col("d2"), F.col("flag"))),
    "cleaning_complete_date": lambda: F.min(_when("cleaning", F.col("d"), F.col("flag"))),
    "listed_date": lambda: F.min(_when("listing", F.col("d"))),
    "sold_date": lambda: F.min(_when("sale", F.col("d"))),
}

DATE_KEYS = ("purchase_date", "ship_date", "port_arrival_date", "cleared_date", "pickup_date",
             "office_intake_date", "first_inspection_date", "inspection_pass_date",
             "repair_start_date", "repair_end_date", "cleaning_complete_date", "listed_date", "sold_date")

GAPS = (
    ("days_purchase_to_port", "purchase_date", "port_arrival_date"),
    ("days_port_to_clearance", "port_arrival_date", "cleared_date"),
    ("days_clearance_to_pickup", "cleared_date", "pickup_date"),
    ("days_pickup_to_intake", "pickup_date", "office_intake_date"),
    ("days_intake_to_inspection", "office_intake_date", "first_inspection_date"),
    ("days_inspection_to_repair_complete", "first_inspection_date", "repair_end_date"),
    ("days_repair_to_cleaning", "repair_end_date", "cleaning_complete_date"),
    ("days_cleaning_to_listed", "cleaning_complete_date", "listed_date"),
    ("days_listed_to_sold", "listed_date", "sold_date"),
    ("total_days_purchase_to_sale", "purchase_date", "sold_date"),
)


def milestone_dates(milestone_rows: DataFrame) -> DataFrame:
    """vehicle_id -> the 13 milestone dates and the inspection round count."""
    return milestone_rows.groupBy("vehicle_id").agg(
        *[f().alias(name) for name, f in MILESTONE_AGGS.items()])


def fact_vehicle_lifecycle(vehicle: DataFrame, dim_vehicle: DataFrame, milestone_rows: DataFrame) -> DataFrame:
    """Accumulating snapshot per current vehicle (D-9): milestone date keys,
    rounds, day gaps (b - a, may be negative), current stage, last update."""
    dates = milestone_dates(milestone_rows)
    base = (current(dim_vehicle).select("vehicle_key", "vehicle_id")
            .join(vehicle.select("vehicle_id", "current_stage", "updated_at"), "vehicle_id")
            .join(dates, "vehicle_id", "left"))
    return base.select(
        "vehicle_key",
        *[date_key(c).alias(f"{c}_key") for c in DATE_KEYS[:8]],
        "inspection_rounds_count",
        *[date_key(c).alias(f"{c}_key") for c in DATE_KEYS[8:]],
        *[day_diff(a, b).alias(name) for name, a, b in GAPS],
        "current_stage", F.col("updated_at").alias("last_updated_at"))


# ---------------------------------------------------------------- history

def stage_events(sources: Sequence[tuple[DataFrame, str, str, Column | str | None]],
                 entity: str = "vehicle_id", tiebreak: str | None = None) -> DataFrame:
    """Union of ``(df, date_col, stage, filter)`` extractions (U-1, P-15):
    ``(entity, stage, d, tb)``; rows with a null date are dropped."""
    out = None
    for df, date_col, stage, cond in sources:
        if cond is not None:
            df = df.filter(cond)
        part = df.select(F.col(entity).cast("long").alias("vehicle_id"), F.lit(stage).alias("stage"),
                         F.col(date_col).cast("date").alias("d"),
                         (F.col(tiebreak).cast("long") if tiebreak else F.lit(0).cast("long")).alias("tb"))
        part = part.filter(F.col("d").isNotNull())
        out = part if out is None else out.unionByName(part)
    return out


def stage_history(events: DataFrame, stage_order: Sequence[str] = STAGES, source_id: int = 1) -> DataFrame:
    """Per-vehicle stage history (D-19).

    ``events``: (vehicle_id, stage, d, tb).  Order per vehicle is
    (date, stage position in ``stage_order``, tb).  ``history_id`` is dense
    1..n over (vehicle, date, position, tb); ``from_stage`` is the previous
    row's stage of the same vehicle.

    No window is partitioned by vehicle: ``dense_key`` numbers the rows in
    ranges of the whole order and hands the previous row over at their
    edges, so one vehicle with a third of all rows spreads over many tasks.
    """
    pos = F.array_position(F.array(*[F.lit(s) for s in stage_order]), F.col("stage")).cast("int")
    ev = events.withColumn("ord", pos)
    order = ["vehicle_id", "d", "ord", "tb"]
    j = dense_key(ev, order, "history_id", prev=["vehicle_id", "stage"])
    return (j.select("history_id", "vehicle_id",
                    F.when(F.col("_prev.vehicle_id") == F.col("vehicle_id"), F.col("_prev.stage")).alias("from_stage"),
                    F.col("stage").alias("to_stage"), midnight("d").alias("changed_at"),
                    F.lit(source_id).cast("long").alias("source_id"),
                    F.lit(None).cast("string").alias("source_record_id")))


def latest_stage(history: DataFrame) -> DataFrame:
    """vehicle_id -> last to_stage (A-14): ``max_by`` over the history id,
    a partial aggregate."""
    return history.groupBy("vehicle_id").agg(F.max_by("to_stage", "history_id").alias("current_stage"))


def stage_updates(history: DataFrame) -> DataFrame:
    """Updates for the vehicle table (D-20): last stage, status SOLD when the
    last stage is SOLD, else ACTIVE (overwrites ON_HOLD / CANCELLED)."""
    return latest_stage(history).withColumn(
        "current_status", F.when(F.col("current_stage") == "SOLD", "SOLD").otherwise("ACTIVE"))


def sync_current_stage(vehicle: DataFrame, history: DataFrame, as_of=None) -> DataFrame:
    """New vehicle table state after the MERGE of D-20."""
    from lotline.operators.dml import merge_matched
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast(vehicle.schema["updated_at"].dataType)
    return merge_matched(vehicle, stage_updates(history), "vehicle_id",
                         {"current_stage": F.col("u.current_stage"),
                          "current_status": F.col("u.current_status"),
                          "updated_at": ts})


def time_in_stage(history: DataFrame, sla: DataFrame | None = None, as_of=None) -> DataFrame:
    """Days spent in each stage (X-6): next change of the same vehicle minus
    this change (open stages run to ``as_of`` when given, else null), joined
    to an optional ``sla`` table (stage, sla_days) for a breach flag.

    The next row is found by an equi-join on ``history_id + 1`` (no window
    partitioned by vehicle)."""
    nxt = history.select((F.col("history_id") - 1).alias("history_id"), F.col("vehicle_id").alias("_nv"),
                         F.col("changed_at").alias("_nt"))
    j = history.join(nxt, "history_id", "left")
    end = F.when(F.col("_nv") == F.col("vehicle_id"), F.col("_nt"))
    if as_of is not None:
        end = F.coalesce(end, F.lit(as_of).cast(history.schema["changed_at"].dataType))
    out = j.select("history_id", "vehicle_id", F.col("to_stage").alias("stage"),
                   F.col("changed_at").alias("entered_at"), end.alias("left_at"))
    out = out.withColumn("days_in_stage", F.datediff(F.to_date("left_at"), F.to_date("entered_at")))
    if sla is not None:
        out = (out.join(sla.select("stage", "sla_days"), "stage", "left")
               .withColumn("sla_breached", F.col("days_in_stage") > F.col("sla_days")))
    return out


def stage_stock_by_day(history: DataFrame) -> DataFrame:
    """(stage, day, entered, left, in_stage) for every stage and day of the history's calendar.

    ``in_stage`` counts the vehicles in the stage at the day's end: the
    running total of entries less exits, over days without any as well.  A
    vehicle leaves a stage on the day of its next change.  Entries and exits
    are summed per stage and day before the running total, which goes over
    ranges of (stage, day).
    """
    spans = dense_key(history.select("history_id", "vehicle_id", "to_stage", "changed_at"), "history_id", "_n", nxt=["vehicle_id", "changed_at"])
    spans = spans.withColumn("_left", F.when(F.col("_next.vehicle_id") == F.col("vehicle_id"), F.to_date("_next.changed_at")))
    moves = F.array(F.struct(F.to_date("changed_at").alias("day"), F.lit(1).cast("long").alias("entered"), F.lit(0).cast("long").alias("left")),
                    F.struct(F.col("_left").alias("day"), F.lit(0).cast("long").alias("entered"), F.lit(1).cast("long").alias("left")))
    daily = spans.select(F.col("to_stage").alias("stage"), F.explode(moves).alias("_m")).select("stage", "_m.*").filter("day is not null")
    daily = cut_lineage(daily.groupBy("stage", "day").agg(F.sum("entered").alias("entered"), F.sum("left").alias("left")))
    # the calendar of one row per stage; its ends are scalars
    first, last = daily.agg(F.min("day")).scalar(), daily.agg(F.max("day")).scalar()
    calendar = daily.select("stage").distinct().select("stage", F.explode(F.sequence(first, last)).alias("day"))
    days = calendar.join(daily, ["stage", "day"], "left").na.fill(0, ["entered", "left"])
    cut = ranged(days.withColumn("_change", F.col("entered") - F.col("left")), ["stage", "day"])
    return running_total(cut, "stage", "_change", "in_stage").select("stage", "day", "entered", "left", "in_stage")
