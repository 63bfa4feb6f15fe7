import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from lotline.llm import vector_codes

COLUMNS = "vec_id long, embedding array<float>, label int, code string, _id int, _vector string, ids int"


def brute(rows, scale=1024, parts=4, entries=256, rounds=4):
    """The contract word by word, in integers of any size."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    part = lambda v, p: tuple(v[p * width : (p + 1) * width])
    head = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[part(v, p) for _, v, _ in head] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[near(part(v, p), books[p])[1]].append(part(v, p))
            books[p] = [tuple(sum(c) // len(c) for c in zip(*groups[i])) if i in groups else e for i, e in enumerate(books[p])]
    out, by_label = [], defaultdict(int)
    for i, v, lab in kept:
        found = [near(part(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), lab))
        by_label[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab], digest) for i, c, e, lab in out), key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, lab, "x", 1, "y", 2) for i, v, lab in rows], COLUMNS).repartition(5)
    out = vector_codes.compress(df, **how)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    hot = [rng.gauss(0, 0.2) for _ in range(8)]
    rows = [(i, hot if i % 3 == 0 else [rng.gauss(0, 0.2) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(-300, 300)]
    rows += [(1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] + [0.0] * 7, 1), (1003, [float("inf")] * 8, None)]
    rows += [(None, [0.5] * 8, None), (5, [0.5] * 8, 3), (5, [0.5] * 8, 3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, entries=7, rounds=2) == brute(rows, entries=7, rounds=2)


def test_few_and_large_values(spark):
    rows = [(2, [1e6, -1e6, 3.0, 0.0], 1), (1, [-5.0, 0.25, 1e-9, -1e-9], None)]
    got = run(spark, rows)
    held = [[max(-65536.0, min(65536.0, x)) for x in v] for _, v, _ in rows]
    assert got == brute([(i, v, lab) for (i, _, lab), v in zip(rows, held)]) and {r[2] for r in got} == {0}


def test_other_lengths_and_empty(spark):
    rows = [(i, [float(i)] * 6, 1) for i in range(3)] + [(9, [1.0], 1), (10, [], 2)]
    got = {r[0]: r for r in run(spark, rows)}
    assert got[9][1:4] == (None, None, 0) and got[10][1:4] == (None, None, None) and got[0][1:4] == ("00000000", 0, 0)
    assert run(spark, []) == []
    assert run(spark, [(1, [], 1), (2, [], None)]) == [(1, "00000000", 0, 0, hashlib.sha256(b"").hexdigest()), (2, "00000000", 0, 0, hashlib.sha256(b"").hexdigest())]


def test_gathers_equal_distances():
    rng = np.random.default_rng(1)
    for scale in (10, 1 << 25):
        x, e = rng.integers(-scale, scale, (700, 6)), rng.integers(-scale, scale, (9, 3))
        index, error = vector_codes.Block.of(x).nearest(e, 2)
        d = ((x[:, None, 2:5] - e[None]) ** 2).sum(axis=2)
        assert (index == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()


@pytest.mark.parametrize("dim, parts, want", [(8, 4, [(0, 2), (2, 4), (4, 6), (6, 8)]), (6, 4, [(0, 2), (2, 4), (4, 5), (5, 6)]), (0, 2, [(0, 0), (0, 0)])])
def test_cuts(dim, parts, want):
    assert vector_codes.cuts(dim, parts) == want
