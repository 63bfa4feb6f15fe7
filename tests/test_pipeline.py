import tempfile

from conftest import SF
from lotline.plans.pipeline import build_gold, build_triage, sync_current_state, write_driver_silver
from lotline.plans.queries import registry
from lotline.sources.driver import DriverSilver
from lotline.sources.lakehouse import read_table, write_version
from pyspark.sql import functions as F


def test_gold_layer_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="lotline-lake-")
    write_driver_silver(DriverSilver(spark, SF), root)
    gold = build_gold(spark, root, run_ts="2001-09-01 00:00:00")
    assert gold["dim_date"].count() == 1095
    q = registry()
    for table, query in [("dim_vehicle", "dim_vehicle"), ("fact_purchase", "fact_purchase"),
                         ("fact_repair", "fact_repair"), ("fact_vehicle_lifecycle", "fact_vehicle_lifecycle")]:
        assert gold[table].count() == q[query](spark, SF).count(), table
    fp = gold["fact_profit"].select("vehicle_key", "profit_ngn")
    ref = q["fact_profit"](spark, SF).select("vehicle_key", "profit_ngn")
    assert fp.selectExpr("vehicle_key", "cast(profit_ngn as double) profit_ngn").exceptAll(ref).count() == 0
    tri = build_triage(spark, root, run_ts="2001-09-01 00:00:00")
    assert tri["fact_review_queue"].count() == q["fact_review_queue"](spark, SF).count()
    # silver is brought up to date as new versions
    s = DriverSilver(spark, SF)
    sync_current_state(spark, root, [(s.purchase, "purchase_date", "PURCHASED", None), (s.sale, "sale_date", "SOLD", None)], as_of="2001-09-01 00:00:00")
    assert {r[0] for r in read_table(spark, root, "silver", "vehicle").select("current_stage").distinct().collect()} == {"PURCHASED", "SOLD"}
    assert read_table(spark, root, "silver", "listing").filter("status = 'SOLD'").count() > 0
    # a second run appends what has changed to the history, with keys after the first run's
    n_profit = gold["fact_profit"].count()   # count before the re-run overwrites the files
    one = gold["dim_vehicle"].agg(F.min("vehicle_id")).first()[0]
    dearer = read_table(spark, root, "silver", "purchase").withColumn(
        "price_amount", F.when(F.col("vehicle_id") == one, F.col("price_amount") + 1).otherwise(F.col("price_amount")).cast("decimal(14,2)"))
    write_version(dearer, root, "silver", "purchase")
    gold2 = build_gold(spark, root, run_ts="2001-09-02 00:00:00", reason="re-run")
    keys = [r[0] for r in gold2["fact_profit_history"].select("profit_history_key").collect()]
    assert sorted(keys) == list(range(1, n_profit + 2))
