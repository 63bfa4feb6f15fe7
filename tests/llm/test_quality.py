import random
import re
from collections import Counter

import zstandard
from lotline.llm import quality
from tests_llm_util import ODD, docs, small  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)


def test_counts(small, docs):
    df, rows = small
    rng = random.Random(2)
    more = [(1000 + k, "".join(rng.choice(["a ", "b ", "c", "\n", "\t", "#", "\x1c", " ", "a b c "]) for _ in range(rng.randint(0, 60)))) for k in range(200)]
    for table, given in ((df, rows), (docs(ODD + more), ODD + more)):
        got = quality.quality(table).collect()
        assert len(got) == len(given)
        want = Counter((r[0], *brute(r[1])) for r in given)
        assert Counter(tuple(r)[:6] for r in got) == want
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.kept and r.base_failed)
    assert quality.quality(docs([])).count() == 0


def test_bands():
    rng = random.Random(3)
    zip_ = zstandard.ZstdCompressor(level=3)
    prose = " ".join(rng.choice(["river", "stone", "walks", "under", "the", "a", "green", "morning", "slowly", "found"]) + rng.choice("aeiou") * rng.randint(0, 2) for _ in range(4000))
    noise = bytes(rng.choice(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(30_000))
    ratio, bad = quality.compression(prose.encode(), zip_)
    assert quality.in_band(len(prose), ratio) and bad == 0
    ratio, bad = quality.compression(noise, zip_)
    assert not quality.in_band(len(noise), ratio) and bad == 1
    ratio, bad = quality.compression(b"same words again " * 2000, zip_)
    assert not quality.in_band(34_000, ratio) and bad == 1
    # half of it repeats itself: the chunks show it
    assert quality.compression(prose[:16_384].encode() + b"again " * 5000, zip_)[1] > 0.5
    assert quality.compression(b"", zip_) == (0.0, 0.0)


def test_mixed_texts(docs):
    """Prose with up to half of it noise or filler, from 8 to 64 KB: the whole text's ratio alone does not show it."""
    rng = random.Random(6)
    words = ["".join(rng.choice("etaoinshrdlucmfw") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = " ".join(rng.choice(words) for _ in range(12_000))
    noise = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(40_000))
    filler = "".join(f"line {i} of the very same filler text goes on here " for i in range(1000))
    rows = []
    for size in (8192, 16_384, 65_536):
        for kind, bad in enumerate(("", noise, filler)):
            for share in (0.5, 0.3) if bad else (0,):
                rows.append((1000 * len(rows) + kind, prose[: int(size * (1 - share))] + " " + bad[: int(size * share)]))
    got = {r.doc_id: r.kept for r in quality.quality(docs(rows), max_repeated=1.0).collect()}
    assert {i: k for i, k in got.items() if i % 1000 == 0} == {i: True for i, _ in rows if i % 1000 == 0}
    assert not [i for i, kept in got.items() if i % 1000 and kept]
