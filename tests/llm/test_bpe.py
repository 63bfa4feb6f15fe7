import hashlib
import random

import pytest
import public_tokenizers
from lotline.llm import bpe
from lotline.llm.queries import VOCABULARY, vocabulary
from tests_llm_util import ODD, docs, small  # noqa: F401
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def ours():
    return bpe.Bpe(vocabulary())


def both(library, ours, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = ours.encode([text])[0]
    return (want, library.decode(want, skip_special_tokens=False)), (bpe.id_array(got).tolist(), " ".join(w[2] for w in got))


def test_mixed_scripts_and_marks(library, ours):
    rng = random.Random(5)
    pool = [chr(c) for r in ((32, 0x250), (0x370, 0x530), (0x590, 0x700), (0x1E00, 0x2100), (0x3000, 0x3200), (0xF900, 0xFB10), (0x1F300, 0x1F700)) for c in range(*r)]
    bits = ["the", " ", "'s", "'", "'ll", "ing", "<|endoftext|>", "<|", "x", "1", "é", "Σ", "\x1c", " ", "!!", "İ", "ß", "aaaa", "ababab"]
    for k in range(6000):
        text = "".join(rng.choice(pool if k % 2 else bits) for _ in range(rng.randint(0, 14)))
        want, got = both(library, ours, text)
        assert got == want, text


def test_long_words(library, ours):
    rng = random.Random(6)
    for text in ("a" * 5000, "ab" * 120, "".join(rng.choice("etaoinshr") for _ in range(9000)), "".join(rng.choice("abc") for _ in range(250))):
        want, got = both(library, ours, text)
        assert got == want


def test_speculation_fails_and_is_merged(ours):
    """Some words need exact merging and some do not; compatible pairs are those that merging leaves alone."""
    import numpy as np
    words = [b"erthly", b"thinorsh", b"the", b"onenble", b"information"]
    text, size = np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.array([len(w) for w in words])
    begin = np.cumsum(size) - size
    flat, owner, failed = ours.propose(text, begin, size)
    proposals = [flat[owner == i].tolist() for i in range(len(words))]
    exact = [ours.merge(w) for w in words]
    pairs = [all(ours.compatible(np.array(p[:-1], int), np.array(p[1:], int))) for p in proposals]
    assert pairs == [p == e for p, e in zip(proposals, exact)]
    assert True in pairs and False in pairs
    ids, count = ours.merge_all(text, begin, size)
    assert [ids[i, : count[i]].tolist() for i in range(len(words))] == exact


def test_documents(spark, small, library):
    df, rows = small
    out = bpe.encode(df, vocabulary(), keep=["doc_id"])
    round_trip = {r.doc_id: r for r in bpe.decode(out, vocabulary()).collect()}
    for i, text, *_ in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        r, decoded = round_trip[i], library.decode(ids, skip_special_tokens=False)
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), decoded)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(docs, library):
    out = bpe.encode(docs(ODD), vocabulary())
    assert out.columns[:9] == docs(ODD).columns
    got = sorted((str(r.text), r.ids) for r in out.collect())
    assert got == sorted((str(t), library.encode(t or "", add_special_tokens=False).ids) for _, t in ODD)
    assert bpe.encode(docs([]), vocabulary()).count() == 0


def test_emptied_table_of_known_words(ours, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 2)
    for text in ("the quick brown fox", "jumps over", "the lazy dog"):
        want, got = both(library, ours, text)
        assert got == want
