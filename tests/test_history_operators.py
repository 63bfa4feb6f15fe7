"""Incremental refresh, as-of joins, stock by day and spliced versions against plain Python."""
import bisect
import datetime as dt
import itertools
import random

import pytest
from conftest import SF, plan_text, rows
from lotline.operators import incremental, lifecycle, ordered, scd2, triage
from lotline.plans.queries import Gold
from lotline.session import cut_lineage
from lotline.sources import lakehouse
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)
at = lambda n: None if n is None else T0 + dt.timedelta(hours=n)


def test_scans_along_an_order(spark):
    """One group with a third of the rows, null groups, null values, empty input."""
    rng = random.Random(1)
    data = [(rng.choice([7, 7, 7, None, *range(6)]), i, rng.choice([None, rng.randint(-5, 5)])) for i in range(900)]
    df = spark.createDataFrame(data, "g int, i int, v long").repartition(7)
    cut = ordered.ranged(df, ["g", "i"])
    got = ordered.running_total(ordered.carry_last(cut, F.col("v"), "last"), "g", "v", "total").collect()
    data.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    last, totals, want = None, {}, {}
    for g, i, v in data:
        last = v if v is not None else last
        totals[g] = totals.get(g, 0) + (v or 0)
        want[i] = (last, totals[g])
    assert all(want[r.i] == (r["last"], r["total"] or 0) or r["total"] is None for r in got) and len(got) == 900
    assert ordered.carry_last(ordered.ranged(df.limit(0), ["g", "i"]), F.col("v"), "last").count() == 0


def test_as_of_join(spark):
    rng = random.Random(2)
    versions, times = [], []
    for key in [0] * 1 + list(range(1, 40)):
        cuts = sorted(rng.sample(range(0, 2000), 300 if key == 0 else rng.randint(0, 5)))
        for a, b in itertools.zip_longest(cuts, cuts[1:]):
            if b is None or rng.random() < 0.9:  # some versions end before the next one begins
                versions.append((key, at(a), at(b if b is None or rng.random() < 0.8 else b - 1) if b != a + 1 else at(b), f"{key}:{a}"))
    versions.append((3, at(50), at(50), "no duration"))
    for i in range(900):
        times.append((i, rng.choice([0, 0, None, *range(1, 45)]), at(rng.choice([None, *range(-5, 2100)])), "x"))
    v = spark.createDataFrame(versions, "k int, effective_from timestamp_ntz, effective_to timestamp_ntz, state string")
    t = spark.createDataFrame(times, "id int, key int, at timestamp_ntz, _kind string")
    got = {r.id: r for r in scd2.state_as_of_join(t, v, "key", "at", ["state"], versions_key="k").collect()}
    for i, key, when, _ in times:
        hits = [s for k, a, b, s in versions if k == key and when is not None and a <= when and (b is None or when < b)]
        assert len(hits) <= 1 and got[i].state == (hits[0] if hits else None) and got[i]["_kind"] == "x"
    assert len(got) == len(times)
    assert scd2.state_as_of_join(t.limit(0), v, "key", "at", ["state"], versions_key="k").count() == 0
    assert scd2.state_as_of_join(t, v.limit(0), "key", "at", ["state"], versions_key="k").filter("state is null").count() == len(times)


def test_late_changes_in_any_order(spark):
    rng = random.Random(3)
    schema = "key int, state string, ts timestamp_ntz, id long"
    changes = [(rng.choice([0, 0, 0, 1, 2, 3]), rng.choice("ABC"), at(i), i) for i in range(40)]
    log0 = [(9, "Z", at(0), 1000), (0, "A", at(-5), 1001)]
    first = cut_lineage(scd2.scd2_from_changes(spark.createDataFrame(log0, schema), "key", ["state"], "ts", "id"))
    whole = rows(scd2.scd2_from_changes(spark.createDataFrame(log0 + changes, schema), "key", ["state"], "ts", "id").drop("sk"))
    for seed in (1, 2):
        random.Random(seed).shuffle(changes)
        dim, log = first, spark.createDataFrame(log0, schema)
        for part in (changes[:15], changes[15:17], changes[10:]):  # the last batch repeats some
            before = {(r.key, r.effective_from, r.state): r.sk for r in dim.collect()}
            dim, log = scd2.scd2_splice(dim, log, spark.createDataFrame(part, schema), "key", ["state"], "ts", "id")
            dim = cut_lineage(dim)
            after = dim.collect()
            assert len({r.sk for r in after}) == len(after)
            assert all(before.get((r.key, r.effective_from, r.state), r.sk) == r.sk for r in after)
        assert rows(dim.drop("sk")) == whole and [r.sk for r in dim.collect() if r.key == 9] == [before[9, at(0), "Z"]]
        assert log.count() == len(log0) + len(changes)


def test_snapshot_closes_versions(spark):
    schema = "sk long, id int, make string, stage string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"
    dim = spark.createDataFrame([(1, 1, "a", "x", at(0), None, True), (2, 2, "b", "x", at(0), None, True), (3, 3, "c", "x", at(0), None, True), (4, 3, "old", "x", at(-9), at(0), False)], schema)
    now = spark.createDataFrame([(1, "a", "y"), (2, "B", "y"), (5, "e", "y")], "id int, make string, stage string")
    got = rows(scd2.scd2_refresh(dim, now, "id", ["make"], "2024-01-02 00:00:00", "sk", ["stage"]), *dim.columns)
    end = dt.datetime(2024, 1, 2)
    assert got == [(1, 1, "a", "y", at(0), None, True), (2, 2, "b", "x", at(0), end, False), (3, 3, "c", "x", at(0), end, False), (4, 3, "old", "x", at(-9), at(0), False),
                   (5, 2, "B", "y", end, None, True), (6, 5, "e", "y", end, None, True)]


def test_stock_by_day(spark):
    rng = random.Random(4)
    history, n = [], 0
    for v in range(30):
        for d in sorted(rng.sample(range(0, 60), rng.randint(1, 6)) if v else [i // 3 for i in range(120)]):
            n += 1
            history.append((n, v, rng.choice("ABC"), T0 + dt.timedelta(days=d)))
    got = {(r.stage, r.day): (r.entered, r.left, r.in_stage) for r in lifecycle.stage_stock_by_day(
        spark.createDataFrame(history, "history_id long, vehicle_id int, to_stage string, changed_at timestamp_ntz")).collect()}
    nxt = {h[0]: (b[3].date() if b and b[1] == h[1] else None) for h, b in itertools.zip_longest(history, history[1:])}
    days = [min(h[3] for h in history).date() + dt.timedelta(days=i) for i in range((max(h[3] for h in history) - min(h[3] for h in history)).days + 1)]
    assert set(got) == set(itertools.product("ABC", days))
    for stage, day in got:
        mine = [(h[3].date(), nxt[h[0]]) for h in history if h[2] == stage]
        assert got[stage, day] == (sum(a == day for a, _ in mine), sum(b == day for _, b in mine), sum(a <= day and (b is None or b > day) for a, b in mine))


def test_signed_changes(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (4, "e"), (4, "e")], "k int, v string")
    assert rows(incremental.signed_changes(old, new)) == [(1, "a", -1), (3, "c", -1), (3, "d", 1), (4, "e", 2)]
    assert incremental.signed_changes(old, old).count() == 0


def test_refresh_equals_rebuild(spark):
    """Lost and lowered sales, costs taken back, new vehicles, untouched rows with their time."""
    from lotline.operators import profit
    dv = spark.createDataFrame([(i, i, 1, True) for i in range(1, 8)], "vehicle_key long, vehicle_id long, branch_id long, is_current boolean")
    cost = "vehicle_key long, price_amount_ngn decimal(20,2)"
    sale = "vehicle_key long, agreed_price_ngn decimal(14,2), status string"
    from decimal import Decimal as D
    p0, p1 = [(i, D(100 * i)) for i in range(1, 7)], [(i, D(100 * i) if i != 2 else D(150)) for i in range(1, 8)]
    s0 = [(1, D(500), "FINALIZED"), (1, D(700), "FINALIZED"), (2, D(900), "PENDING_PAYMENT"), (3, D(10), "FINALIZED")]
    s1 = [(1, D(500), "FINALIZED"), (2, D(900), "REVERSED"), (3, D(10), "FINALIZED"), (7, D(5), "FINALIZED")]
    repair = spark.createDataFrame([], "vehicle_key long, line_cost_ngn decimal(20,2)")
    df = lambda x, schema: spark.createDataFrame(x, schema)
    whole = lambda p, s, t: profit.fact_profit(dv, df(p, cost), repair, df(s, sale), as_of=t)
    old = whole(p0, s0, "2024-01-01 00:00:00")
    late = [(4, D(33)), (4, D(-3))]
    got = incremental.refresh_profit(old, dv, [(incremental.signed_changes(df(p0, cost), df(p1, cost)), "price_amount_ngn"),
                                               (df(late, cost).withColumn("weight", F.lit(1)), "price_amount_ngn")],
                                     incremental.signed_changes(df(s0, sale), df(s1, sale)), df(s1, sale), as_of="2024-02-01 00:00:00")
    want = whole(p1 + late, s1, "2024-02-01 00:00:00")
    assert rows(got.drop("calculated_at")) == rows(want.drop("calculated_at"))
    assert {r.vehicle_key for r in got.collect() if r.calculated_at.month == 2} == {1, 2, 4, 7}


def test_refresh_reads_the_late_batch_only(spark, tmp_path):
    lines = Gold(spark, SF).s.repair_job_part
    lakehouse.write_table(lines.withColumn("batch", F.when(F.col("qty") > 40, 2).otherwise(1)), str(tmp_path), "silver", "parts", partition_by=["batch"])
    late = lakehouse.read_table(spark, str(tmp_path), "silver", "parts").filter("batch > 1")
    assert "PartitionFilters: [isnotnull(batch" in plan_text(late)
    assert all("batch=2" in r[0] for r in late.select(F.input_file_name()).distinct().collect())
    assert late.count() == lines.filter("qty > 40").count()


def test_rewrites_that_meet(spark, tmp_path):
    root, df = str(tmp_path), spark.range(5)
    lakehouse.write_version(df, root, "silver", "t")
    number = lakehouse.version_number(spark, root, "silver", "t")
    lakehouse.write_version(df.filter("id > 1"), root, "silver", "t", based_on=number)
    with pytest.raises(lakehouse.ConcurrentRewrite):
        lakehouse.write_version(df.filter("id > 3"), root, "silver", "t", based_on=number)
    assert lakehouse.read_table(spark, root, "silver", "t").count() == 3
    assert lakehouse.read_version(spark, root, "silver", "t", 1).count() == 5
    with pytest.raises(ValueError):
        lakehouse.read_version(spark, root, "silver", "t", 9)


@pytest.mark.parametrize("models", [20, 400])
def test_matcher_stays_linear(spark, models):
    """Messages that name one make and one model give one pair each, however many models share the make."""
    vehicles = spark.range(models).select(F.col("id").alias("vehicle_id"), F.lit("toyota").alias("make"), F.format_string("model %04d", "id").alias("model"))
    messages = spark.range(50).select(F.col("id").alias("message_id"), F.format_string("the Toyota Model %04d has arrived", F.col("id") % 20).alias("message_text"))
    pairs = vehicles.select(F.lower("make").alias("mk"), F.lower("model").alias("md")).distinct()
    assert triage.named_pairs(messages, pairs).count() == 50
    assert triage.make_model_candidates(messages, vehicles).filter("n_candidates = 1 and cand_min_id = message_id % 20").count() == 50
