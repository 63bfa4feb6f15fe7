from conftest import rows
from lotline.operators import reports as RP


def test_top_k_ties_nulls_and_first_k(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, 9.0), (5, 1.0)], "k long, m double")
    assert [r.k for r in RP.top_k(df, "m", 3, "k").collect()] == [3, 4, 1]          # tie by key, nulls last
    assert [r.k for r in RP.top_k(df, "m", 5, "k").collect()] == [3, 4, 1, 5, 2]
    assert [r.k for r in RP.first_k(df, "k", 2, ["k"]).collect()] == [1, 2]


def test_breakdown_and_review_kpis(spark):
    q = spark.createDataFrame([(1, "OPEN", 0.35, None, None), (1, "OPEN", 0.55, None, None),
                               (2, "RESOLVED", 0.6, 20250102, 30.0)],
                              "source_key long, status string, confidence_score double, resolved_date_key int, "
                              "resolution_hours double")
    assert rows(RP.breakdown(q, "status")) == [("OPEN", 2), ("RESOLVED", 1)]
    assert rows(RP.review_kpis(q)) == [(1, "OPEN", 2, 0.45, 0, None), (2, "RESOLVED", 1, 0.6, 1, 30.0)]
