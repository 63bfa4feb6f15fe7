"""Row-level contracts, exact quantiles and the one-pass status report against plain Python."""
import math
import random
from collections import Counter, defaultdict

import pytest
from conftest import plan_text, rows
from lotline.operators import contracts, quantiles, reports
from lotline.operators.contracts import Contract, Reference


def test_quarantine(spark):
    df = lambda data, schema: spark.createDataFrame(data, schema)
    tables = {
        "car": df([(1, "a", "NEW"), (2, "b", "ODD"), (3, "a", None), (None, None, "NEW"), (5, "c", "NEW"), (5, "c", "NEW")], "id long, vin string, state string"),
        "bill": df([(10, 1, 1), (11, 9, 1), (12, None, None), (13, 3, 2)] + [(100 + i, 1, 1) for i in range(200)], "id long, car long, n int"),
        "task": df([(1, "CAR", 1), (2, "CAR", 10), (3, "BILL", 10), (4, "BILL", 1), (5, None, 7)], "id long, kind string, of long"),
        "empty": df([], "id long"),
    }
    rules = {
        "car": Contract("id", ["id"], [["vin"], ["id", "state"]], {"state": ["NEW"]}),
        "bill": Contract("id", ["n"], [["id"]], {}, [Reference("car", "car")]),
        "task": Contract("id", ["kind"], [], {}, [Reference("of", "car", ("kind", "CAR")), Reference("of", "bill", ("kind", "BILL"))]),
        "empty": Contract("id", ["id"], [["id"]], {}, [Reference("id", "car")]),
    }
    got = contracts.quarantine(tables, rules)
    bad = {name: [(r.id, list(r.reasons)) for r in sorted(rejected.collect(), key=lambda r: (r.id is not None, r.id or 0))] for name, (_, rejected) in got.items()}
    assert bad["car"] == [(None, ["not_null:id"]), (1, ["unique:vin"]), (2, ["allowed:state"]), (3, ["unique:vin"]),
                          (5, ["unique:id,state", "unique:vin"]), (5, ["unique:id,state", "unique:vin"])]
    assert bad["bill"] == [(11, ["reference:car"]), (12, ["not_null:n"])]
    assert bad["task"] == [(2, ["reference:of"]), (4, ["reference:of"]), (5, ["not_null:kind"])]
    for name, (clean, rejected) in got.items():
        assert clean.columns == tables[name].columns
        assert rows(clean.unionByName(rejected.drop("reasons"))) == rows(tables[name])
    with pytest.raises(ValueError):
        contracts.quarantine(tables, {"bill": rules["bill"]})


@pytest.mark.parametrize("kind, bins", [("long", 8), ("double", 4), ("decimal(20,4)", 1024)])
def test_exact_quantiles(spark, kind, bins):
    """A group with most rows, ties, one value, outliers far apart, nulls, values beyond a double's digits."""
    from decimal import Decimal
    rng = random.Random(bins)
    make = {"long": lambda x: int(x), "double": float, "decimal(20,4)": lambda x: Decimal(int(x * 10_000)) / 10_000}[kind]
    data = [(rng.choice(["hot", "hot", "a", None]), make(rng.choice([rng.gauss(0, 5), rng.gauss(0, 1e9), 3]))) for _ in range(600)]
    data += [("one", make(7)), ("none", None), ("hot", None)]
    if kind == "long":
        data += [("big", (1 << 62) + i) for i in range(5)] + [("big", -(1 << 62))]
    if kind == "double":
        data += [("far", x) for x in (float("inf"), float("-inf"), 1e308, -1e308, 5e-324, float("inf"))]
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(spark.createDataFrame(data, f"g string, v {kind}").repartition(4), "g", "v", shares, bins=bins)
    groups = defaultdict(list)
    for g, v in data:
        if v is not None:
            groups[g].append(v)
    want = {(g, s): (len(v), sorted(v)[max(1, math.ceil(s * len(v))) - 1]) for g, v in groups.items() for s in shares}
    assert {(r.g, r.share): (r.rows, r.quantile) for r in got.collect()} == want
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(spark.createDataFrame(data, f"g string, v {kind}"), "g", "v", [1.5])


def test_status_report(spark):
    a = spark.createDataFrame([("x", "p"), ("x", None), (None, "p"), (None, "p")], "s string, t string")
    b = spark.createDataFrame([(1,), (1,), (None,)], "n int")
    got = Counter(tuple(r) for r in reports.status_report([("a", a, ["s", "t"]), ("b", b, ["n"]), ("c", b.limit(0), ["n"])]).collect())
    assert got == Counter([("a", "x", "p", 0, 1), ("a", "x", None, 0, 1), ("a", None, "p", 0, 2), ("a", "x", None, 1, 2), ("a", None, None, 1, 2), ("a", None, None, 3, 4),
                           ("b", "1", None, 0, 2), ("b", None, None, 0, 1), ("b", None, None, 3, 3)])


@pytest.mark.parametrize("few", [0, 100])
def test_quarantine_rows_stay_in_place(spark, monkeypatch, few):
    plans, cut = {}, contracts.cut_lineage

    def watched(df):
        plans[tuple(df.columns)] = plan_text(df)
        return cut(df)

    monkeypatch.setattr(contracts, "cut_lineage", watched)
    monkeypatch.setattr(contracts, "FEW", few)
    tables = {"car": spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, vin string"),
              "bill": spark.createDataFrame([(i, i, i % 25) for i in range(200)], "id long, n long, car int")}
    rules = {"car": Contract("id", ["id"], [["vin"]]), "bill": Contract("id", [], [["id"], ["n", "car"]], {}, [Reference("car", "car")])}
    clean, rejected = contracts.quarantine(tables, rules)["bill"]
    assert clean.count() == 160 and rejected.count() == 40
    assert {tuple(r.reasons) for r in rejected.collect()} == {("reference:car",)}
    # no rule fails: the table is judged as it is read; few keys fail: they come to the rows
    assert "Exchange" not in plans[("id", "vin", "reasons")]
    assert "Exchange hashpartitioning" not in plans[("id", "n", "car", "reasons")]
