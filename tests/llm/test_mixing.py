import random
from collections import Counter, defaultdict

import pytest
from lotline.llm import mixing
from tests_llm_util import ODD, docs, small  # noqa: F401


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Clamp at the maximum and reshare what is over by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > epochs * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in open_}
        for s in full:
            target[s] = epochs * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def words(text):
    return len((text or "").encode().split())


def check(rows, got, whole=False):
    sizes, taken, biggest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r[3]] += words(r[1])
        biggest[r[3]] = max(biggest[r[3]], words(r[1]))
    want = brute_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= (biggest[s] if whole else 0.5 + 1e-6)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], words(r[1])) for r in rows)


def test_documents(small):
    df, rows = small
    first = [r.asDict() for r in mixing.mix(df).collect()]
    check(rows, first)
    key = lambda r: (r["doc_id"], r["taken"])
    again = [r.asDict() for r in mixing.mix(df.repartition(5)).collect()]
    assert sorted(first, key=key) == sorted(again, key=key)
    check(rows, [r.asDict() for r in mixing.mix(df, whole_documents=True).collect()], whole=True)


def test_hot_source_and_odd_rows(docs):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 30), None, "hot" if i % 3 else None) for i in range(3000)] + [r + (None, "odd") for r in ODD]
    check(rows, [r.asDict() for r in mixing.mix(docs(rows)).collect()])
    empty = mixing.mix(docs([(1, None, None, "a"), (2, "", None, None)])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0, 0), (0, 0)]
    assert mixing.mix(docs([])).count() == 0


def test_take_repeats_rows(docs, small):
    df, rows = small
    taken = {(r["doc_id"]): r["taken"] for r in mixing.mix(df, whole_documents=True).collect()}
    out = mixing.take(df)
    assert out.columns == df.columns
    times = Counter(r.doc_id for r in out.collect())
    assert all(times[i] * words(t) == taken[i] for i, t, *_ in rows)
    assert mixing.take(docs([])).count() == 0 and mixing.take(docs([(1, None, None, None)])).count() == 1


def test_cut_cells_agree_with_a_plain_sort(spark):
    """Many documents in one source: the two-level cut equals sorting all of them."""
    import hashlib
    rows = [(i, "x " * (i % 7 + 1), "b") for i in range(20_000)] + [(-1, "y " * 100_000, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    order = sorted((hashlib.md5(f"0:{i}".encode()).hexdigest(), i % 7 + 1, i) for i in range(20_000))
    size = sum(s for _, s, _ in order)
    target = round(brute_targets({"a": 100_000, "b": size})["b"])
    left = target - target // size * size
    want = defaultdict(int)
    for _, s, i in order:
        extra = min(s, max(0, left))
        want[i], left = target // size * s + extra, left - extra
    assert all(got[i] == want[i] for i in range(20_000))
