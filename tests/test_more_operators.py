import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF, rows
from lotline.operators import quality as Q
from lotline.operators import rules as R
from lotline.operators import scd2
from lotline.sources import lakehouse as LH
from lotline.sources.landing import explode_payload

ts = dt.datetime
d = dt.date


def test_scd2_apply_cases(spark):
    dim = spark.createDataFrame([
        (1, 10, "A", ts(2025, 1, 1), None, True),
        (2, 11, "B", ts(2025, 1, 1), None, True),
        (3, 12, None, ts(2025, 1, 1), None, True),
        (4, 10, "Z", ts(2024, 1, 1), ts(2025, 1, 1), False)],
        "sk long, id long, attr string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    changes = spark.createDataFrame([(10, "A"), (11, "C"), (12, "X"), (13, "N")], "id long, attr string")
    out = scd2.scd2_apply(dim, changes, "id", ["attr"], "2025-06-01 00:00:00")
    got = rows(out, "sk", "id", "attr", "effective_to", "is_current")
    assert got == [
        (1, 10, "A", None, True),                    # unchanged
        (2, 11, "B", ts(2025, 6, 1), False),         # closed
        (3, 12, None, ts(2025, 6, 1), False),        # null -> value closes too
        (4, 10, "Z", ts(2025, 1, 1), False),         # history passes through
        (5, 11, "C", None, True), (6, 12, "X", None, True), (7, 13, "N", None, True)]
    cur = out.filter("is_current").groupBy("id").count().filter("count > 1").count()
    assert cur == 0


def test_scd2_from_changes_and_as_of(spark):
    ch = spark.createDataFrame([
        (1, "a", ts(2025, 1, 1), 1), (1, "a", ts(2025, 1, 2), 2), (1, "b", ts(2025, 1, 3), 3),
        (2, "x", ts(2025, 1, 1), 4)], "k long, t string, ts timestamp_ntz, eid long")
    v = scd2.scd2_from_changes(ch, "k", ["t"], "ts", "eid")
    assert rows(v, "sk", "k", "t", "effective_to", "is_current") == [
        (1, 1, "a", ts(2025, 1, 3), False), (2, 1, "b", None, True), (3, 2, "x", None, True)]
    # boundary: valid from <= t < to
    assert rows(scd2.state_as_of(v, "2025-01-03 00:00:00"), "k", "t") == [(1, "b"), (2, "x")]
    assert rows(scd2.state_as_of(v, "2025-01-02 23:59:59"), "k", "t") == [(1, "a"), (2, "x")]


def test_rule_chain_branches(spark):
    plans = spark.createDataFrame([
        (1, d(2025, 1, 1), 20, 3, False, 10, "r"),   # arrives 01-23, cleared 01-26
        (2, d(2025, 1, 30), 20, 3, False, 10, "r"),  # 1 day old: no shipment
        (3, d(2025, 1, 1), 20, 3, True, 10, "r"),    # delayed: on hold
        (4, d(2025, 1, 20), 20, 3, False, 10, "r")], # in transit
        "vehicle_id long, purchase_date date, shipping_days int, clear_days int, delayed boolean, extra_days int, "
        "hold_reason_draw string")
    as_of = "2025-01-31"
    sh = R.shipment_status(plans, as_of)
    assert rows(sh, "vehicle_id", "shipment_status", "ata") == [
        (1, "ARRIVED", d(2025, 1, 23)), (3, "ARRIVED", d(2025, 1, 23)), (4, "IN_TRANSIT", None)]
    pa = R.clearance_status(sh.filter("shipment_status = 'ARRIVED'").withColumn("arrival_date", F.col("ata")), as_of)
    assert rows(pa, "vehicle_id", "clearance_status", "cleared_date", "hold_reason") == [
        (1, "CLEARED", d(2025, 1, 26), None), (3, "ON_HOLD", None, "r")]
    pi = R.pickup_and_intake(pa, as_of)
    assert rows(pi, "vehicle_id", "pickup_date", "intake_date") == [(1, d(2025, 1, 27), d(2025, 1, 27))]


def test_repair_status_rules(spark):
    insp = spark.createDataFrame([
        (1, d(2025, 1, 1), "FAIL", 1, 5, False),
        (2, d(2025, 1, 1), "FAIL", 1, 10, True),     # blocked, 23 days < 10 + 15
        (3, d(2025, 1, 1), "FAIL", 1, 40, False),    # 23 >= 0.4 * 40
        (4, d(2025, 1, 20), "FAIL", 1, 12, False),   # 4 < 0.4 * 12
        (5, d(2025, 1, 1), "PASS", 1, 5, False), (6, d(2025, 1, 1), "FAIL", 2, 5, False)],
        "vehicle_id long, inspection_date date, overall_result string, round_no int, repair_days int, blocked boolean")
    rs = R.repair_status(insp, "2025-01-25")
    assert rows(rs, "vehicle_id", "repair_status", "end_date") == [
        (1, "DONE", d(2025, 1, 7)), (2, "BLOCKED_PARTS", None), (3, "IN_PROGRESS", None), (4, "OPEN", None)]


def test_list_price_and_sales(spark):
    cleaned = spark.createDataFrame([(1, d(2025, 1, 1), "DONE", 1.25), (2, d(2025, 1, 1), "REDO_REQUIRED", 1.3)],
                                    "vehicle_id long, task_date date, cleaning_status string, markup double")
    purchase = spark.createDataFrame([(1, Decimal("1000.00"))], "vehicle_id long, price_amount decimal(14,2)")
    costs = spark.createDataFrame([(1, Decimal("2000.00"))], "vehicle_id long, repair_cost decimal(24,2)")
    lp = R.list_price(cleaned, purchase, costs, "2025-02-01")
    # (1000 * 1600 + 2000) * 1.25 = 2002500 -> /5000 = 400.5 -> half-even 400 -> 2000000
    assert rows(lp, "vehicle_id", "listed_date", "list_price") == [(1, d(2025, 1, 2), Decimal("2000000.00"))]
    listing = spark.createDataFrame([(1, d(2025, 1, 2), Decimal("1000005.00"), 10, Decimal("0.010"), True),
                                     (2, d(2025, 1, 30), Decimal("5.00"), 10, Decimal("0"), False)],
                                    "vehicle_id long, listed_date date, price_amount decimal(14,2), sale_days int, "
                                    "discount decimal(4,3), installment boolean")
    ms = R.matured_sales(listing, "2025-02-01")
    assert rows(ms, "vehicle_id", "sale_date", "agreed_price") == [(1, d(2025, 1, 12), Decimal("990005.00"))]
    pay = R.first_payment(ms)
    assert rows(pay, "sale_status", "payment_amount") == [("PENDING_PAYMENT", Decimal("495002.00"))]


def test_checklist_expansion_and_damage(spark):
    insp = spark.createDataFrame([(11,), (21,)], "inspection_id long")
    items = spark.createDataFrame([(i, True) for i in range(1, 9)], "item_id long, is_active boolean")
    fails = spark.createDataFrame([(11, 3), (11, 6)], "inspection_id long, item_id long")
    res = R.expand_checklist(insp, items, fails)
    assert res.count() == 16 and rows(res.filter("pass_fail = 'FAIL'"), "inspection_id", "item_id") == [(11, 3), (11, 6)]
    found = spark.createDataFrame([(11, 3, 7, "HIGH"), (11, 4, 8, "LOW")], "inspection_id long, item_id long, part_id long, severity string")
    assert rows(R.damage_items(res, found), "item_id", "part_id", "severity") == [(3, 7, "HIGH"), (6, None, None)]
    many = spark.range(1200).select(F.col("id").alias("item_id"), F.lit(True).alias("is_active"))
    assert R.expand_checklist(insp, many, fails).distinct().count() == 2 * 1200


def test_violations_and_source_mix(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    df = spark.createDataFrame([(1, 1, "USD"), (1, 3, "EUR"), (2, None, None)], "k long, fk long, cur string")
    v = {(r.rule, r.column): r.failing for r in Q.violations(
        df, "t", not_null=["fk"], unique=[["k"]], allowed={"cur": ["USD"]},
        foreign_keys=[("fk", parent, "id")]).collect()}
    assert v == {("not_null", "fk"): 1, ("unique", "k"): 2, ("allowed_values", "cur"): 1, ("foreign_key", "fk"): 1}
    a = spark.createDataFrame([(1,), (1,), (2,)], "source_id long")
    mix = rows(Q.source_mix([("a", a)]), "source_id", "records", "pct_of_records")
    assert mix == [(1, 2, 66.67), (2, 1, 33.33)]


def test_versioned_table_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="lotline-lh-")
    v1 = spark.createDataFrame([(1, "ACTIVE"), (2, "ACTIVE")], "id long, status string")
    LH.write_table(v1, root, "silver", "listing")
    cur = LH.read_table(spark, root, "silver", "listing")
    new = cur.withColumn("status", F.when(F.col("id") == 2, "SOLD").otherwise(F.col("status")))
    LH.write_version(new, root, "silver", "listing")          # reads the old state while writing the new
    assert rows(LH.read_table(spark, root, "silver", "listing")) == [(1, "ACTIVE"), (2, "SOLD")]
    assert os.path.exists(os.path.join(root, "silver", "listing", "_current"))
    # an append after the switch is read back, an overwrite is a new version
    LH.write_table(spark.createDataFrame([(3, "ACTIVE")], "id long, status string"), root, "silver", "listing", mode="append")
    assert rows(LH.read_table(spark, root, "silver", "listing")) == [(1, "ACTIVE"), (2, "SOLD"), (3, "ACTIVE")]
    LH.write_table(LH.read_table(spark, root, "silver", "listing").filter("id > 1"), root, "silver", "listing")
    assert rows(LH.read_table(spark, root, "silver", "listing")) == [(2, "SOLD"), (3, "ACTIVE")]
    like = LH.read_like(spark, LH.table_path(root, "silver", "listing") + "/" + LH._current_version(spark, LH.table_path(root, "silver", "listing")), v1)
    assert like.schema == v1.schema and like.count() == 2


def test_only_a_missing_pointer_means_plain(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="lotline-lh-")
    LH.write_table(spark.range(3), root, "silver", "t")
    assert LH.table_exists(spark, root, "silver", "t") and not LH.table_exists(spark, root, "silver", "u")
    assert LH._current_version(spark, LH.table_path(root, "silver", "t")) is None
    LH.write_version(spark.range(5), root, "silver", "t")
    # a pointer that cannot be read is an error, not a plain table
    folder = os.path.join(root, "silver", "t", "_current")
    for name in os.listdir(folder):
        if not name.startswith((".", "_")):
            os.truncate(os.path.join(folder, name), 0)
            os.replace(os.path.join(folder, name), os.path.join(folder, name + ".gz"))
            with open(os.path.join(folder, name + ".gz"), "w") as f:
                f.write("no gzip")
    with pytest.raises(Exception):
        LH.read_table(spark, root, "silver", "t").count()


def test_payload_and_driver_entry(spark):
    ev = spark.createDataFrame([(1, '{"k": 5}'), (2, "not json"), (3, None)], "event_id long, props string")
    assert rows(explode_payload(ev, "props", "k int", keep=("event_id",))) == [(1, 5), (2, None), (3, None)]
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "profit_ngn" in df.columns
    from lotline.plans.queries import registry
    assert set(registry()) <= set(E.oracle_sql()) <= set(E.queries())


def test_streaming_triage_matches_batch(spark):
    from lotline.sources.driver import DriverSilver
    from lotline.operators.triage import extracted_event
    from lotline.streaming.triage_stream import message_stream, start_triage
    s = DriverSilver(spark, SF)
    msgs = s.raw_message.select("message_id", "message_text", F.col("sent_at").cast("timestamp").alias("sent_at"))
    src = tempfile.mkdtemp(prefix="lotline-src-")
    msgs.filter("message_id % 2 = 0").write.mode("overwrite").parquet(f"{src}/part1")
    msgs.write.mode("overwrite").parquet(f"{src}/part2")        # second copy: duplicates to drop
    out, ck = tempfile.mkdtemp(prefix="lotline-out-"), tempfile.mkdtemp(prefix="lotline-ck-")
    stream = message_stream(spark, f"{src}/*", msgs.schema, watermark="100000 days")
    q = start_triage(stream, s.vehicle, out, ck)
    q.awaitTermination(300)
    got = spark.read.parquet(out).select("event_id", "vehicle_id", "confidence_score")
    want = extracted_event(msgs, s.vehicle).select("event_id", "vehicle_id", "confidence_score")
    assert got.count() == want.count() == msgs.count()
    assert got.exceptAll(want).count() == 0


def test_land_raw_json_and_array_payload(spark):
    from lotline.sources.landing import land_raw
    d0 = tempfile.mkdtemp(prefix="lotline-raw-")
    with open(os.path.join(d0, "m.json"), "w") as f:
        f.write('{"message_id": 1, "raw_payload": "{\\"media_urls\\": [\\"a.jpg\\", \\"b.jpg\\"]}"}\n')
        f.write('{"message_id": 2, "raw_payload": "{\\"media_urls\\": []}"}\n')
        f.write('{"message_id": 3, "extra": "ignored"}\n')
    raw = land_raw(spark, d0, "message_id long, raw_payload string", fmt="json", as_of="2025-01-01 00:00:00")
    assert rows(raw, "message_id", "ingested_at") == [(1, ts(2025, 1, 1)), (2, ts(2025, 1, 1)), (3, ts(2025, 1, 1))]
    assert all(r.source_file.endswith("m.json") for r in raw.collect())
    media = explode_payload(raw, "raw_payload", "media_urls array<string>", array_col="media_urls",
                            keep=("message_id",))
    # explode_outer keeps messages with an empty or missing array
    assert rows(media) == [(1, "a.jpg"), (1, "b.jpg"), (2, None), (3, None)]


def test_catalog_namespace_and_named_table(spark):
    import pytest
    LH.create_namespace(spark, "silver_t")
    with pytest.raises(ValueError):
        LH.create_namespace(spark, "bad; drop")
    loc = tempfile.mkdtemp(prefix="lotline-cat-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    LH.save_as_table(df, "silver_t.branch", path=f"{loc}/branch")
    LH.save_as_table(df.filter("id = 2"), "silver_t.branch", path=f"{loc}/branch")   # overwrite by name
    assert rows(spark.table("silver_t.branch")) == [(2, "b")]
