"""Plan-shape regression checks over registered queries (sf0.001)."""

import sys

import pytest

from conftest import SF, plan_text
from lotline import session
from lotline.plans.queries import registry

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
CHECKED = ("fact_profit", "fact_purchase", "fact_vehicle_lifecycle", "stage_history_events", "extracted_event",
           "fact_review_queue", "scd2_apply_batch", "profit_history_append", "fact_expense", "state_as_of_join",
           "scd2_late_changes", "stage_stock_by_day", "fact_profit_incremental")


@pytest.mark.parametrize("name", CHECKED)
def test_no_nested_loops_or_python(spark, name, monkeypatch):
    """Of the result and of every table that the query writes on the way to it."""
    plans, write = [], session.cut_lineage

    def noted(df):
        plans.append(plan_text(df))
        return write(df)

    for module in [m for n, m in sys.modules.items() if n.startswith("lotline.") and getattr(m, "cut_lineage", None) is write]:
        monkeypatch.setattr(module, "cut_lineage", noted)
    plans.append(plan_text(registry()[name](spark, SF)))
    assert len(plans) > 1 and any("Join" in p or "Exchange" in p for p in plans)
    assert not [f for p in plans for f in FORBIDDEN if f in p]


def test_scans_prune_columns(spark):
    import re
    p = plan_text(registry()["repair_cost"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    li = [sc for sc in schemas if "l_orderkey" in sc]
    assert li, p
    # only the three columns the repair-line mapping uses reach the scan
    assert {c.split(":")[0] for c in li[0].split(",")} == {"l_orderkey", "l_quantity", "l_extendedprice"}
