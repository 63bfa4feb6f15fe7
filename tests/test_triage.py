import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_text, rows
from lotline.operators import triage as TR

VEH = [
    # vehicle_id, lot, make, model
    (1, "LOT-12345", "Toyota", "Camry"),
    (2, "LOT-123456", "Toyota", "Corolla"),
    (3, "LOT-00007", "Honda", "Civic"),
    (4, None, "Honda", "Civic"),
    (5, "", "Lexus", "RX350"),
    (6, "AB-9", "Ford", "Edge"),          # lot of another shape
    (7, "LOT-55555", None, "Murano"),     # null make never matches
]


def _vehicles(spark):
    return spark.createDataFrame(VEH, "vehicle_id long, auction_lot_no string, make string, model string")


def _brute(messages, vehicles):
    """Row-by-row restatement of the reference rule (lowest id first)."""
    out = {}
    for mid, text in messages:
        t = (text or "").lower()
        et = "IGNORE"
        if text is not None:
            for label, words in (("PICKUP", ("picked up", "picking up")), ("OFFICE_ARRIVAL", ("arrived", "at the office")),
                                 ("REPAIR_PROGRESS", ("fixed", "bumper", "headlight", "repair", "working on")),
                                 ("CUSTOMS_UPDATE", ("held", "duty", "customs"))):
                if any(w in t for w in words):
                    et = label
                    break
        if et == "IGNORE":
            out[mid] = (et, None, 0.10)
            continue
        lot = [v for v, lot, _, _ in sorted(VEH) if lot and lot in text]
        if lot:
            out[mid] = (et, lot[0], 0.95)
            continue
        c = [v for v, _, mk, md in sorted(VEH) if mk is not None and md is not None and mk and md
             and mk.lower() in t and md.lower() in t]
        out[mid] = (et, c[0], 0.60) if len(c) == 1 else ((et, None, 0.35) if c else (et, None, 0.30))
    return out


MESSAGES = [
    (1, "Picked up LOT-12345 today"),                 # lot hit
    (2, "Picked up LOT-123456 today"),                # contains LOT-12345 too -> lowest id 1
    (3, "Fixed LOT-00007 and LOT-12345"),             # two lots -> lowest
    (4, "fixed lot-00007"),                           # lower-case lot: no hit, no names -> 0.30
    (5, "The honda civic arrived"),                   # two Civics -> 0.35
    (6, "the toyota camry is at the office"),         # one candidate -> 0.60
    (7, "Good morning"),                              # IGNORE
    (8, None),                                        # null -> IGNORE
    (9, "customs held AB-9 at port"),                 # other-shaped lot
    (10, "duty paid for the nissan murano"),          # null make -> no candidate
]


def test_match_entity_branches(spark):
    msgs = spark.createDataFrame(MESSAGES, "message_id long, message_text string")
    got = {r.message_id: (r.event_type, r.vehicle_id, r.confidence_score)
           for r in TR.match_entity(msgs, _vehicles(spark)).collect()}
    assert got == _brute(MESSAGES, VEH)
    assert got[2] == ("PICKUP", 1, 0.95) and got[5][2] == 0.35 and got[6] == ("OFFICE_ARRIVAL", 1, 0.60)


def test_matcher_plan_has_no_nested_loop_over_dictionary(spark):
    msgs = spark.createDataFrame(MESSAGES, "message_id long, message_text string")
    p = plan_text(TR.match_entity(msgs, _vehicles(spark)))
    assert "CartesianProduct" not in p and "BatchEvalPython" not in p


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abAB-1 ", min_size=0, max_size=12), min_size=1, max_size=8),
       st.lists(st.text(alphabet="abAB-1", min_size=0, max_size=4), min_size=1, max_size=6))
def test_contains_join_equals_brute_force(spark, texts, pats):
    t = spark.createDataFrame(list(enumerate(texts)), "text_id long, text string")
    p = spark.createDataFrame(list(enumerate(pats)), "pattern_id long, pattern string")
    got = set(tuple(r) for r in TR.contains_join(t, p, k=3).collect())
    want = {(i, j) for i, x in enumerate(texts) for j, y in enumerate(pats) if y and y in x}
    assert got == want


def test_extracted_event_and_tasks(spark):
    msgs = spark.createDataFrame(MESSAGES, "message_id long, message_text string")
    ev = TR.extracted_event(msgs, _vehicles(spark))
    st_ = {r.event_id: r.review_status for r in ev.collect()}
    assert st_[1] == "AUTO_ACCEPTED" and st_[7] == "AUTO_REJECTED" and st_[5] == "PENDING"
    tasks = TR.review_tasks(ev, "event_id", "EXTRACTED_EVENT", as_of="2025-01-01 00:00:00")
    pend = sorted(k for k, v in st_.items() if v == "PENDING")
    assert rows(tasks, "task_id", "source_id") == [(i + 1, s) for i, s in enumerate(pend)]


def test_score_receipts_and_review_queue(spark):
    purchase = spark.createDataFrame([(1, 100.0), (2, 200.0)], "vehicle_id long, price_amount double") \
        .withColumn("price_amount", F.col("price_amount").cast("decimal(14,2)"))
    lines = spark.createDataFrame([(10, 1, 100.0), (11, 2, 210.0)], "line_id long, vehicle_id long, amount double") \
        .withColumn("amount", F.col("amount").cast("decimal(14,2)"))
    scored = TR.score_receipts(lines, purchase)
    assert rows(scored, "line_id", "confidence_score", "review_status") == [
        (10, 0.92, "AUTO_ACCEPTED"), (11, 0.55, "PENDING")]
    events = spark.createDataFrame([(5, 0.35)], "event_id long, confidence_score double")
    tasks = spark.createDataFrame([
        (1, "EXTRACTED_EVENT", 5, 1, "OPEN", dt.datetime(2025, 1, 1), None),
        (2, "EXTRACTED_RECEIPT_LINE", 11, 1, "RESOLVED", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2, 6)),
        (3, "SOMETHING_ELSE", 11, 99, "OPEN", dt.datetime(2025, 1, 1), None),   # unknown type -> receipt
    ], "task_id long, source_type string, source_id long, assigned_to_staff_id long, status string, "
       "created_at timestamp_ntz, resolved_at timestamp_ntz")
    staff = spark.createDataFrame([(1, 1, True)], "staff_key long, staff_id long, is_current boolean")
    src = spark.createDataFrame([(7, "WHATSAPP_GROUP_AGENT"), (8, "RECEIPT_AGENT")], "source_key long, source_code string")
    q = TR.fact_review_queue(tasks, events, scored, staff, src)
    assert rows(q, "task_key", "source_key", "assigned_staff_key", "confidence_score", "resolution_hours",
                "resolved_date_key") == [
        (1, 7, 1, 0.35, None, None), (2, 8, 1, 0.55, 30.0, 20250102), (3, 8, None, 0.55, None, None)]


def test_lot_prefix_semantics_on_driver_shape(spark):
    # widened keys: LOT-10000 is a substring of LOT-100000
    v = spark.createDataFrame([(10000, "LOT-10000", "A", "B"), (100000, "LOT-100000", "A", "B")],
                              "vehicle_id long, auction_lot_no string, make string, model string")
    m = spark.createDataFrame([(1, "picked up LOT-100000")], "message_id long, message_text string")
    assert TR.match_entity(m, v).first().vehicle_id == 10000


@pytest.mark.parametrize("anchors", [0, 200, 10**6])
def test_contains_join_long_patterns(spark, monkeypatch, anchors):
    cuts, cut = [], TR.cut_lineage
    monkeypatch.setattr(TR, "ANCHORS", anchors)
    monkeypatch.setattr(TR, "cut_lineage", lambda df: cuts.append(cut(df)) or cuts[-1])
    names = [f"customer#{i:09d}" for i in range(300)] + ["the quick brown fox jumps over the lazy dog", "lazy dog", "x\u00e9"]
    texts = [f"fixed {names[i]} x\u00e9" for i in range(0, 300, 7)] + ["a" * n + names[300] + "\n" for n in range(17)] + [names[300][1:], "", None]
    t = spark.createDataFrame(list(enumerate(texts)), "text_id long, text string")
    p = spark.createDataFrame(list(enumerate(names)) * 2, "pattern_id long, pattern string")
    got = [tuple(r) for r in TR.contains_join(t, p).collect()]
    assert sorted(got) == sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(names) if x and y in x)
    # anchors of a large dictionary of like names are rare: hardly a candidate that is no hit
    assert cuts[-1].columns == ["_tid", "_pid", "_pat"] and cuts[-1].count() <= len(got) + 2


def test_contains_join_reads_long_patterns_in_blocks(spark, monkeypatch):
    plans, cut = {}, TR.cut_lineage
    monkeypatch.setattr(TR, "cut_lineage", lambda df: plans.update({tuple(df.columns): plan_text(df)}) or cut(df))
    passage = "".join(f"{i} " for i in range(40))
    t = spark.createDataFrame([(i, "-" * i + passage + "end") for i in range(24)] + [(99, passage[1:])], "text_id long, text string")
    p = spark.createDataFrame([(1, passage), (2, passage[:47])], "pattern_id long, pattern string")
    got = TR.contains_join(t, p, k=24).collect()
    assert sorted(map(tuple, got)) == [(i, j) for i in range(24) for j in (1, 2)]
    plan = plans[("_tid", "_pid", "_pat")]
    assert "(?s)(.{24})" in plan and "(?=" not in plan


@pytest.mark.parametrize("anchors", [0, 10**6])
def test_contains_join_reads_blocks_for_a_long_list_too(spark, monkeypatch, anchors):
    plans, cut = {}, TR.cut_lineage
    monkeypatch.setattr(TR, "ANCHORS", anchors)
    monkeypatch.setattr(TR, "cut_lineage", lambda df: plans.update({tuple(df.columns): plan_text(df)}) or cut(df))
    # alike but for the middle; one is listed under two ids, one under none
    passages = ["the same beginning " * 3 + f"no {i} of 60 é\U0001f600\n" + "and the same end " * 3 for i in range(60)]
    listed = [(i, x) for i, x in enumerate(passages)] + [(100, passages[7]), (None, passages[8]), (200, ""), (201, None)]
    texts = [(i, "-" * i + passages[i] + passages[-1 - i]) for i in range(30)] + [(7, passages[7][1:]), (7, passages[9]), (90, "".join(passages)), (91, None)]
    t = spark.createDataFrame(texts, "text_id long, text string")
    p = spark.createDataFrame(listed, "pattern_id long, pattern string")
    got = map(tuple, TR.contains_join(t, p, k=24).collect())
    assert sorted(got, key=str) == sorted(((i, j) for i, x in texts for j, y in listed if x and y and y in x), key=str)
    plan = plans[("_tid", "_pid", "_pat")]
    assert "(?s)(.{24})" in plan and "(?=" not in plan
