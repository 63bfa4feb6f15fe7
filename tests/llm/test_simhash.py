import random

import numpy as np
import pytest
import xxhash
from lotline.llm import simhash
from tests_llm_util import ODD, closure, docs, small  # noqa: F401


def brute_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius):
    """rows: (id, fingerprint) -> {index: smallest id reachable}"""
    n = len(rows)
    links = [(i, j) for i in range(n) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= radius]
    group = closure(n, links)
    least = {}
    for i, g in enumerate(group):
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return [least.get(g) for g in group]


def test_documents(spark, small):
    df, rows = small
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted((r[0], f"{f[1]:016x}", c) for r, f, c in zip(rows, fps, brute_components(fps, 2)))
    got = sorted(tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect())
    assert got == want
    left = simhash.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in want})


def test_odd_rows(docs):
    df = docs(ODD)
    fps = [(r[0], brute_fingerprint(r[1])) for r in ODD]
    want = sorted(((f[0], f"{f[1]:016x}", c) for f, c in zip(fps, brute_components(fps, 2))), key=str)
    got = sorted((tuple(r) for r in simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert got == want
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.drop_near_duplicates(docs([])).columns == df.columns


@pytest.mark.parametrize("node_rows", [4, 64, 16_384])
def test_links_of_dense_groups(spark, node_rows):
    """Balls of fingerprints, so that nodes are hot at every level; the factored index finds every component."""
    rng = random.Random(node_rows)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(120):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    as_long = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in as_long], "_fp long")
    got = {r._node: r._root for r in simhash.components(simhash.links(df, 2, node_rows)).collect()}
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    group = closure(len(fps), links)
    least = {}
    for g, x in zip(group, as_long):
        least[g] = min(least.get(g, x), x)
    assert [got.get(x, x) for x in as_long] == [least[g] for g in group]


def test_components_of_chains(spark):
    rng = random.Random(3)
    names = rng.sample(range(10_000), 300)
    edges = list(zip(names[:200], names[1:200])) + list(zip(names[201:], [names[200]] * 99))
    df = spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "_a long, _b long")
    got = {r._node: r._root for r in simhash.components(df).collect()}
    for part in (names[:200], names[200:]):
        assert {got.get(x, x) for x in part} == {min(part)}


def test_gray_rank_is_an_order():
    gray = np.arange(64, dtype=np.uint64) ^ (np.arange(64, dtype=np.uint64) >> np.uint64(1))
    assert simhash.gray_rank(gray).tolist() == list(range(64))
