import random

import public_tokenizers
import pytest
import sentencepiece
from lotline.llm import token_count
from tests_llm_util import ODD, docs, small  # noqa: F401

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


@pytest.fixture(scope="module")
def whole():
    sp = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    return lambda t: len(sp.encode(t))


def test_documents(small, whole):
    df, rows = small
    got = {r.doc_id: r for r in token_count.count_tokens(df, MODEL, chunk=500, overlap=8).collect()}
    assert any(len(t or "") > 5_000 for _, t, *_ in rows)
    for i, t, *_ in rows:
        n = whole(t or "")
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)


@pytest.mark.parametrize("kind", ["words", "spaces", "one letter", "no space", "letters of all kinds", "special"])
def test_chunks_give_the_whole_encoding(kind, whole):
    rng = random.Random(kind)
    draw = {
        "words": lambda n: "".join(rng.choice(["the ", "wording", " an", "\n", "  ", "é", "tion", "123", "▁"]) for _ in range(n)),
        "spaces": lambda n: " " * n,
        "one letter": lambda n: "a" * n + "b" * rng.randint(0, 3),
        "no space": lambda n: "".join(rng.choice(["in", "ing", "er", "ther", "s"]) for _ in range(n)),
        "letters of all kinds": lambda n: "".join(chr(rng.choice([rng.randint(1, 0x7F), rng.randint(0x80, 0xD7FF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(n)),
        "special": lambda n: "".join(rng.choice(["<s>", "</s>", "<unk>", "<0x0A>", " ", "x"]) for _ in range(n)),
    }[kind]
    for trial in range(60):
        text = draw(rng.randint(1, 400))
        chunk = rng.randint(2, 60)
        counter = token_count.Counter(MODEL, chunk, rng.randint(1, min(chunk, 12)))
        assert counter.count([text, "", text]) == [whole(text), 0, whole(text)], (text, chunk)


def test_widening_is_bounded(whole):
    """A text that has no common token costs a constant number of encodings of its length."""
    counter, text, read = token_count.Counter(MODEL, 64, 4), "a" * 20_000 + " the end", []
    spans = counter.spans
    counter.spans = lambda t, b, e: read.append(e - b) or spans(t, b, e)
    assert counter.long(text) == whole(text)
    assert sum(read) < 12 * len(text)


def test_odd_rows(docs, whole):
    rows = [r + (None, "s") for r in ODD]
    df = docs(rows).withColumnRenamed("taken", "n_tokens").withColumnRenamed("_row", "_text")
    out = token_count.count_tokens(df, MODEL, chunk=1000)
    assert out.columns == [c for c in df.columns if c != "n_tokens"] + ["n_bytes", "n_tokens", "over_limit"]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out.collect())
    assert got == sorted((str(i), len((t or "").encode()), whole(t or "")) for i, t in ODD)
    assert token_count.count_tokens(docs([]), MODEL).count() == 0


def test_bad_overlap():
    with pytest.raises(ValueError):
        token_count.Counter(MODEL, 4, 5)
