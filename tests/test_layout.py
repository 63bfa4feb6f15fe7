"""Co-partitioned tables and partitions that are overwritten alone."""
import os

import pytest
from conftest import SF, plan_text, rows
from lotline.operators import profit
from lotline.plans.queries import Gold
from lotline.sources import lakehouse
from pyspark.sql import functions as F


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_profit_has_no_exchange(spark, tmp_path, shuffled_joins):
    g = Gold(spark, SF)
    tables = {"dim_vehicle": g.dim_vehicle, "fact_purchase": g.fact_purchase(False), "fact_repair": g.fact_repair(False), "fact_sale": g.fact_sale(False)}
    names = {}
    for name, df in tables.items():
        names[name] = f"bucketed_{name}"
        lakehouse.save_bucketed(df, names[name], "vehicle_key", 4, path=f"{tmp_path}/{name}")
    try:
        t = {name: lakehouse.read_named(spark, n) for name, n in names.items()}
        built = profit.fact_profit(t["dim_vehicle"], t["fact_purchase"], t["fact_repair"], t["fact_sale"], as_of="2001-09-01 00:00:00", copartitioned=True)
        assert "SortMergeJoin" in plan_text(built) and "Exchange" not in plan_text(built)
        plain = profit.fact_profit(*tables.values(), as_of="2001-09-01 00:00:00")
        assert "Exchange" in plan_text(plain) and rows(built) == rows(plain)
    finally:
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_untouched_partitions_stay(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("date_key"))
    root = str(tmp_path)
    lakehouse.write_table(df, root, "gold", "fact", partition_by=["date_key"])
    files = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/gold/fact") for f in fs if f.endswith(".parquet")}
    before = files()
    late = spark.range(100, 110).select("id", F.lit(2).cast("long").alias("date_key"))
    lakehouse.overwrite_partitions(late, root, "gold", "fact", ["date_key"])
    after = files()
    assert all("date_key=2" in f for f in set(before) ^ set(after)) and all(after[f] == t for f, t in before.items() if "date_key=2" not in f)
    got = lakehouse.read_table(spark, root, "gold", "fact")
    assert got.filter("date_key = 2").count() == 10 and got.count() == 85
