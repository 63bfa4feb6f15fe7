import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from conftest import plan_text, rows
from lotline.operators import dml
from lotline.operators.keys import dense_key, next_keys


def test_dense_key_with_gaps(spark):
    df = spark.createDataFrame([(i,) for i in (5, 1, 900, 42, 7, 100000)], "k long")
    assert rows(dense_key(df, "k", "sk"), "k", "sk") == [(1, 1), (5, 2), (7, 3), (42, 4), (900, 5), (100000, 6)]


def _reference(df, order):
    w = Window.orderBy(*order)
    return df.select("*", F.row_number().over(w).cast("long").alias("sk"), F.lag(order[0]).over(w).alias("p"), F.lead(order[-1]).over(w).alias("n"))


@pytest.mark.parametrize("case", ["numbers", "hot", "nulls", "strings", "outlier"])
def test_dense_key_equals_global_window(spark, case):
    n = 5000
    data = {
        "numbers": [((i * 7) % 5003, i % 11) for i in range(n)],
        "hot": [(1 if i % 3 else i, i) for i in range(n)],  # one leading value holds most rows
        "nulls": [(None if i % 4 == 0 else i, i) for i in range(n)],
        "strings": [(f"name {i * 31 % n}", i) for i in range(n)] + [(None, -1)],
        "outlier": [(i, i) for i in range(n)] + [(10 ** 15, 1)],
    }[case]
    df = spark.createDataFrame(data, f"k {'string' if case == 'strings' else 'long'}, v long")
    got = dense_key(df, ["k", "v"], "sk", prev=["k"], nxt=["v"]).select("k", "v", "sk", F.col("_prev.k").alias("p"), F.col("_next.v").alias("n"))
    ref = _reference(df, ["k", "v"])
    assert got.count() == len(data)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_ranges_are_even(spark):
    """Neither an outlier nor a hot leading value fills one range; no raw rows meet in a single task."""
    for k in (F.when(F.col("id") == 0, 10 ** 15).otherwise(F.col("id")), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id"))):
        df = spark.range(40_000).select(k.alias("k"), F.col("id").alias("v"))
        out = dense_key(df, ["k", "v"], "sk")
        plan = plan_text(out)
        # a projection of what has been written: nothing is brought together any more
        assert "SinglePartition" not in plan and "Exchange" not in plan and "Join" not in plan
        sizes = [r["count"] for r in df.repartitionByRange(8, "k", "v").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * 40_000 / 8


def test_dense_key_empty_and_continuation(spark):
    empty = spark.createDataFrame([], "k long")
    assert dense_key(empty, "k", "sk").count() == 0
    existing = spark.createDataFrame([(10,), (3,)], "task_id long")
    new = spark.createDataFrame([(7,), (2,)], "k long")
    assert rows(next_keys(new, "k", "sk", existing, "task_id"), "k", "sk") == [(2, 11), (7, 12)]
    none_yet = spark.createDataFrame([], "task_id long")
    assert rows(next_keys(new, "k", "sk", none_yet, "task_id"), "k", "sk") == [(2, 1), (7, 2)]


def _vehicles(spark):
    return spark.createDataFrame([(1, "PURCHASED", "ACTIVE"), (2, "SHIPPED", "ON_HOLD"), (3, "LISTED", "ACTIVE")],
                                 "vehicle_id long, current_stage string, current_status string")


def test_merge_matched_only(spark):
    src = spark.createDataFrame([(2, "SOLD", "SOLD"), (9, "SOLD", "SOLD")],
                                "vehicle_id long, current_stage string, current_status string")
    out = dml.merge_matched(_vehicles(spark), src, "vehicle_id",
                            {"current_stage": F.col("u.current_stage"), "current_status": F.col("u.current_status")})
    assert rows(out) == [(1, "PURCHASED", "ACTIVE"), (2, "SOLD", "SOLD"), (3, "LISTED", "ACTIVE")]
    empty = spark.createDataFrame([], "vehicle_id long, current_stage string, current_status string")
    same = dml.merge_matched(_vehicles(spark), empty, "vehicle_id", {"current_stage": F.col("u.current_stage")})
    assert rows(same) == rows(_vehicles(spark))


def test_merge_duplicate_source_key_fails(spark):
    src = spark.createDataFrame([(2, "SOLD"), (2, "LISTED")], "vehicle_id long, current_stage string")
    out = dml.merge_matched(_vehicles(spark), src, "vehicle_id", {"current_stage": F.col("u.current_stage")})
    with pytest.raises(Exception, match="duplicate"):
        out.collect()


def test_update_where_in_and_soft_delete(spark):
    listing = spark.createDataFrame([(1, 10, "ACTIVE"), (2, 11, "ACTIVE"), (3, 12, "ACTIVE")],
                                    "listing_id long, vehicle_id long, status string")
    sold = spark.createDataFrame([(11,), (11,), (99,)], "vehicle_id long")
    out = dml.update_where_in(listing, sold, "vehicle_id", {"status": F.lit("SOLD")})
    assert rows(out, "listing_id", "status") == [(1, "ACTIVE"), (2, "SOLD"), (3, "ACTIVE")]
    nothing = dml.update_where_in(listing, spark.createDataFrame([], "v long"), "vehicle_id", {"status": F.lit("SOLD")})
    assert rows(nothing) == rows(listing)
    v = spark.createDataFrame([(1, False, None), (2, False, None)], "vehicle_id long, is_deleted boolean, deleted_at timestamp_ntz")
    d = dml.soft_delete(v, spark.createDataFrame([(2,)], "id long"), "vehicle_id", "2025-01-01 00:00:00")
    assert rows(d) == [(1, False, None), (2, True, dt.datetime(2025, 1, 1))]
    assert rows(dml.live(d), "vehicle_id") == [(1,)]


def test_dedup_latest_and_upsert(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "x", 1)], "k long, v string, ts long")
    assert rows(dml.dedup_latest(df, "k", "ts")) == [(1, "b", 3), (2, "x", 1)]
    target = spark.createDataFrame([(1, "old", 1), (2, "keep", 1)], "k long, v string, ts long")
    src = spark.createDataFrame([(1, "new", 5), (3, "ins", 6), (2, "stale", 0)], "k long, v string, ts long")
    out = dml.upsert_since(target, src, "k", 2, ts_col="ts")
    assert rows(out) == [(1, "new", 5), (2, "keep", 1), (3, "ins", 6)]


def test_neighbours_need_no_window_over_the_rows(spark):
    df = spark.createDataFrame([(i % 3, i, f"v{i}" if i % 4 else None) for i in range(500)], "a long, b long, c string")
    k = dense_key(df, ["a", "b"], "key", prev=["b", "c"], nxt=["c"])
    got = sorted(k.collect(), key=lambda r: r.key)
    want = sorted(((r.a, r.b, r.c) for r in df.collect()), key=lambda t: t[:2])
    assert [(r.a, r.b, r.c) for r in got] == want
    assert [r._prev and tuple(r._prev) for r in got] == [None, *[t[1:] for t in want[:-1]]]
    assert [r._next and tuple(r._next) for r in got] == [*[(t[2],) for t in want[1:]], None]
    assert "hashpartitioning(_range" not in plan_text(k.select("a", "b", "key", "_prev")).split("BroadcastExchange")[0]
