import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from lotline.llm import prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string, conv string, depth int, ka string, _range int"


def originals(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest()
            convs[c].append((t is not None, t or 0, digest, r or "", x or ""))
    return {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in below)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], COLUMNS).repartition(5)
    out = prefix_trie.prefix_trie(df, **how)
    return sorted(tuple(r) for r in out.collect())


def made(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a", "é", "", None, "ab"])))
    return rows


def test_openings_against_brute_force(spark):
    rng = random.Random(2)
    rows = [r for r in made(rng, 150) if r[0] % 35 != 0]  # some groups have no first conversation
    rows += [(400, None, "user", "x"), (400, None, "user", "w"), (400, 3, "b", "x" * 70_000), (401, 1, "r", "t"), (401, 1, "r", "t"), (None, 1, "r", "t")]
    assert run(spark, rows, openings=5) == brute(rebuilt(originals(rows)))


@pytest.mark.parametrize("height", [2, 3, 16])
def test_deep_and_hot(spark, height):
    """One conversation with a third of all turns, copies of it, a first turn of all, and many equal ones."""
    rng = random.Random(height)
    long = [("user", str(rng.randint(0, 3))) for _ in range(150)]
    rows = [(0, t, *x) for t, x in enumerate(long)] + [(1, t, *x) for t, x in enumerate(long[:97])] + [(2, t, *x) for t, x in enumerate(long[:40] + [("z", "z")] * 30)]
    rows += [(c, t, "user", "same" if t == 0 else str(c % 3)) for c in range(10, 60) for t in range(c % 4 + 1)]
    assert run(spark, rows, height=height) == brute(originals(rows))


def test_pieces_of_end_lists(spark):
    rng = random.Random(5)
    ends = [(rng.randint(-2, 2), 7, c) for c in rng.sample(range(-5_000, 5_000), 900)] + [(9, 9, 1)]
    got = prefix_trie.end_digests(spark.createDataFrame(ends, "ka long, kb long, conv long").repartition(3), piece=11)
    want = defaultdict(list)
    for a, b, c in ends:
        want[a, b].append(c)
    assert {(r.ka, r.kb): r.ends_sha256 for r in got.collect()} == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "a", "b")], openings=5) == []
