import random

import pytest
from lotline.llm import line_dedup
from tests_llm_util import ODD, docs, small  # noqa: F401


def distance_one(a, b):
    """True if at most one word changed, added or removed turns a into b."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, min_words=5):
    lines, out = [], {}
    for i, t in sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate(t.split("\n")):
            w = line.encode().split()
            if not w:
                continue
            near = [p for p, x in lines if x == w or (max(len(x), len(w)) >= min_words and distance_one(x, w))]
            if near:
                out[i, k] = (min(near), all(x != w for p, x in lines if p == min(near)))
            lines.append(((i, k), w))
    return out


def found(df, **how):
    return {(r.doc_id, r.line): ((r.keep_id, r.keep_line), r.near) for r in line_dedup.repeated_lines(df, **how).distinct().collect()}


@pytest.mark.parametrize("block", [2, 256])
def test_random_lines(docs, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng = random.Random(block)
    base = [[rng.choice("abcdefgh") for _ in range(rng.randint(1, 14))] for _ in range(40)]
    rows = []
    for d in range(120):
        lines = []
        for _ in range(rng.randint(0, 5)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
                w[at : at + (kind < 2)] = [] if kind == 0 else [rng.choice("abcxyz")]
            lines.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((d, "\n".join(lines)))
    want = brute(rows)
    got = found(docs(rows))
    assert set(got) == set(want)
    # the line kept is the earliest that matches
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}


def test_documents(small):
    df, rows = small
    got, want = found(df), brute(rows)
    assert got == want and any(near for _, near in want.values())
    counts = line_dedup.line_counts(df).collect()
    assert sorted((r.doc_id, k) for r in counts for k in r.dropped) == sorted(want)
    cleaned = line_dedup.drop_repeated_lines(df)
    assert cleaned.columns == df.columns
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    for i, t, *_ in rows:
        assert texts[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in want)


def test_odd_rows(docs):
    rows = [r for r in ODD if r[0] is not None and r[0] != 5] + [(None, "a b c"), (30, "one"), (31, "\n\n"), (32, "x " * 3000 + "y"), (33, "x " * 3000)]
    assert {k: v[0] for k, v in found(docs(rows)).items()} == {k: v[0] for k, v in brute(rows).items()}
    out = line_dedup.line_counts(docs(ODD)).collect()
    assert len(out) == len(ODD)  # repeated rows too
    assert sum(r.doc_id == 5 and r.n_dropped == 0 for r in out) == 3
    assert [r.text for r in line_dedup.drop_repeated_lines(docs([(1, None), (2, "")])).orderBy("doc_id").collect()] == [None, ""]
    assert line_dedup.repeated_lines(docs([])).count() == 0 and line_dedup.line_counts(docs([])).count() == 0
