import hashlib

from lotline.llm import exact_dedup
from tests_llm_util import ODD, docs, small  # noqa: F401


def brute(rows, best):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = best(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(small):
    df, rows = small
    for keep, best in (("largest", max), ("smallest", min)):
        got = sorted((tuple(r) for r in exact_dedup.exact_dedup(df, keep=keep).collect()), key=str)
        assert got == brute([r[:2] for r in rows], best)


def test_odd_rows_and_copies(docs):
    rows = ODD + [(i, "copied") for i in range(500)]
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs(rows), keep="largest", radix=2, levels=3).collect()), key=str)
    assert got == brute(rows, max)
    left = exact_dedup.drop_copies(docs(rows), keep="largest")
    assert left.columns == docs(rows).columns
    texts = [(r.doc_id, r.text or "") for r in left.collect()]
    assert sorted(t for _, t in texts) == sorted({t or "" for _, t in rows})
    assert (499, "copied") in texts
    assert exact_dedup.exact_dedup(docs([])).count() == 0 and exact_dedup.drop_copies(docs([])).count() == 0


def test_colliding_digests_stay_apart(spark):
    runs = spark.createDataFrame([(r, 7, sha, 1, i, 1) for i, (r, sha) in enumerate([(0, "a"), (5, "a"), (5, "b"), (63, "b"), (9, "c")])],
                                 "_run int, _digest long, _sha string, _bytes int, _keep long, _n long")
    got = sorted((r._sha, r._keep, r._n) for r in exact_dedup.merge_runs(runs, "smallest").collect())
    assert got == [("a", 0, 2), ("b", 2, 2), ("c", 4, 1)]


def test_every_round_merges_sorted_runs(spark):
    schema = "_run int, _digest long, _sha string, _bytes int, _keep long, _n long"
    merged = exact_dedup.merge_runs(spark.createDataFrame([(0, 7, "a", 1, 1, 1)], schema), "largest", radix=2, levels=3)
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortAggregate") == 2 * 3 and "HashAggregate" not in plan


def test_identifiers_of_every_level_against_brute_force(spark):
    rows = [(r % 27, d % 11, "ab"[d % 2], d % 3, None if r % 5 == 0 else r * 31 % 101, 1) for r in range(40) for d in range(r % 7)]
    runs = spark.createDataFrame(rows, "_run int, _digest long, _sha string, _bytes int, _keep long, _n long")
    for keep, best in (("largest", max), ("smallest", min)):
        groups = {}
        for _, d, sha, size, i, _ in rows:
            groups.setdefault((d, sha, size), []).append(i)
        want = {k: (best([i for i in v if i is not None], default=None), len(v)) for k, v in groups.items()}
        got = {(r._digest, r._sha, r._bytes): (r._keep, r._n) for r in exact_dedup.merge_runs(runs, keep, radix=3, levels=3).collect()}
        assert got == want
