import random

import pytest
from lotline.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, _conv string, branch string, level int"


@pytest.fixture
def talk(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def test_quotes_and_replies(talk):
    rows = [
        (1, 0, "user", "What is the plan for the week?\nAnd who comes along?"),
        (1, 1, "assistant", "Hiking on Monday, rest on Tuesday."),
        (1, 2, "user", "On Friday, Ann wrote:\n> What is the PLAN for the   week?\n> And who comes along?\nAll of us."),
        (1, 3, "user", "> Hiking on Monday, rest on Tuesday.\n>> And who comes along?\n\nI would rather swim.\n> never said by anyone\nReally."),
        (1, 4, "user", "> I would rather swim.\nMe too."),
        (2, 0, "user", "> All of us.\nno such message here"),
    ]
    got = {(r.conv_id, r.turn): r for r in chat.format_chats(talk(rows)).collect()}
    assert got[1, 2].text == "All of us." and got[1, 2].reply_to == 0
    assert got[1, 3].text == "I would rather swim.\nReally." and got[1, 3].reply_to == 1 and got[1, 3].quote_depth == 2
    assert [tuple(q) for q in got[1, 3].quotes] == [(1, 1), (2, 0)] and got[1, 3].n_quotes == 3
    assert got[1, 4].reply_to == 3 and got[1, 4].text == "Me too."
    assert got[2, 0].reply_to is None and got[2, 0].text == "no such message here"
    assert [got[1, t].branch for t in range(5)] == [0, 0, 2, 3, 3]
    assert got[1, 1].formatted == "<|im_start|>assistant\nHiking on Monday, rest on Tuesday.<|im_end|>"


def test_branches_against_brute_force(talk, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 4)
    rng, rows, reply = random.Random(4), [], {}
    for c in range(4):
        for t in range(40):
            to = rng.randrange(t) if t and rng.random() < 0.4 else None
            quote = "" if to is None else f"> message {to} of {c} here\n"
            rows.append((c, t, "user", f"{quote}message {t} of {c} here"))
            reply[c, t] = to
    got = {(r.conv_id, r.turn): r for r in chat.format_chats(talk(rows)).collect()}
    for c in range(4):
        branch = 0
        for t in range(40):
            r, to = got[c, t], reply[c, t]
            branch = t if to is not None and to < t - 1 else branch
            assert (r.reply_to, r.branch, r.text) == (to, branch, f"message {t} of {c} here")
        order = sorted(range(40), key=lambda t: (got[c, t].branch, t))
        assert all(reply[c, t] is None or order.index(reply[c, t]) < order.index(t) for t in range(40))


def test_parts_of_messages(talk):
    """A sentence out of a line, text wrapped anew, a common line beside the real one, part of a sentence."""
    long = "We meet at the old station. Bring a warm coat, some food and the blue map! Is that fine?"
    rows = [(1, 0, "user", "Yes."), (1, 1, "user", long), (1, 2, "user", "no"), (1, 3, "user", "Well.\nThe train leaves at nine.\nYes."),
            (1, 4, "user", "> Yes.\n> The train leaves at nine.\nGood."), (1, 5, "user", "> Bring a warm coat,\n> some food and the blue\n> map!\nI will."),
            (1, 6, "user", "> Is that fine?\nIt is."), (1, 7, "user", "> coat, some food and the\n> blue\nWhich one?"), (1, 8, "user", "> nobody said this at all\nHm.")]
    got = {r.turn: r.reply_to for r in chat.format_chats(talk(rows)).collect()}
    assert [got[t] for t in range(9)] == [None] * 4 + [3, 1, 1, 1, None]


def test_the_original_has_the_whole_passage(talk):
    """A message that has all of a quote goes before earlier ones that share parts with it."""
    rows = [(None, 0, "user", "we meet at nine at the old station by the river"), (None, 1, "user", "fine"),
            (None, 2, "user", "remember: we meet at nine at the old station by the river and bring the map"),
            (None, 3, "user", "> at the old station by the river and bring\nyes"), (None, 4, "user", "> the old station by the river\nwhere?"),
            (None, 5, "user", "at the old station by the river and bring")]
    got = {r.turn: r.reply_to for r in chat.format_chats(talk(rows)).collect()}
    assert [got[t] for t in range(6)] == [None, None, None, 2, 0, None]


def test_words_in_a_row(talk):
    """All windows in another order are not the passage; an introducing line may be long."""
    rows = [(1, 0, "user", "one two three four five nine and two three four five six"), (1, 1, "user", "two three four five six seven then one two three four five six"),
            (1, 2, "user", "so one two three four five six seven it is"), (1, 3, "user", "> one two three four\n> five six seven\nyes"),
            (1, 4, "user", "On Monday " + "and so on " * 60 + "Ann wrote:\n> so one two three four five six seven it is\nfine")]
    got = {r.turn: r for r in chat.format_chats(talk(rows)).collect()}
    assert got[3].reply_to == 2 and got[4].reply_to == 2
    assert got[4].text == "fine"


def test_links_against_brute_force(talk):
    def windows(words):
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    rng, rows, want = random.Random(6), [], {}
    phrases = [" ".join(f"w{rng.randrange(5000)}" for _ in range(7)) for _ in range(12)]
    for c in (None, 1, 2):
        bodies = []
        for t in range(40):
            body, quote = " ".join(rng.choice(phrases) for _ in range(rng.randrange(1, 4))), None
            if t and rng.random() < 0.6:
                words = rng.choice(bodies).split()
                i = rng.randrange(len(words) - 5)
                quote = " ".join(words[i:rng.randrange(i + 6, len(words) + 1)])
                want[c, t] = next(k for k, b in enumerate(bodies) if windows(quote.split()) <= windows(b.split()))
            rows.append((c, t, "user", body if quote is None else f"> {quote}\n{body}"))
            bodies.append(body)
    got = {(r.conv_id, r.turn): r.reply_to for r in chat.format_chats(talk(rows)).collect()}
    assert {k: v for k, v in got.items() if v is not None} == want


def test_interleaved_threads(talk):
    rows = [(1, t, "user", ("" if to is None else f"> message {to}\n") + f"message {t}") for t, to in enumerate((None, None, 0, 1, 2))]
    got = chat.format_chats(talk(rows)).collect()
    assert {r.turn: r.thread for r in got} == {0: 0, 1: 0, 2: 2, 3: 0, 4: 2}
    assert [r.turn for r in sorted(got, key=lambda r: (r.thread, r.turn))] == [0, 1, 3, 2, 4]


@pytest.mark.parametrize("step", [1, 3])  # turns without and with gaps
def test_threads_against_brute_force(talk, monkeypatch, step):
    monkeypatch.setattr(chat, "BLOCK", 4)
    rng, rows, want = random.Random(5), [], {}
    for c in (None, 1, 2, 3):
        answered = set()
        for t in range(60):
            # mostly two or three talks side by side
            to = rng.choice([max(0, t - 2), max(0, t - 3), rng.randrange(t)]) if t and rng.random() < 0.8 else None
            up = t - 1 if to is None else to
            want[c, t * step] = want[c, up * step] if t and up not in answered else t * step
            answered.add(up)
            rows.append((c, t * step, "user", ("" if to is None else f"> message {to} of {c}\n") + f"message {t} of {c}"))
    got = {(r.conv_id, r.turn): r.thread for r in chat.format_chats(talk(rows)).collect()}
    assert got == want
    assert any(sorted(range(0, 60 * step, step), key=lambda t: (got[c, t], t)) != list(range(0, 60 * step, step)) for c in (None, 1, 2, 3))


def test_odd_rows(talk):
    rows = [(None, None, None, None), (None, 1, "user", ""), (1, None, "user", "> hello there"), (1, 1, "user", "hello there"), (1, 1, "user", "hello there"), (1, 1, None, ">>>"),
            (1, 2, "user", "> hello there\n" * 3000), (3, 5, "user", "x" * 200_000), (3, -7, "user", "> x"), (4, 0, "a", "a > b\nc >> d"), (5, 0, "u", " keeps  its\tspace \n")]
    got = sorted((tuple(r) for r in chat.format_chats(talk(rows)).select("conv_id", "turn", "text", "reply_to", "branch").collect()), key=str)
    want = [(None, None, "", None, 1), (None, 1, "", None, 1), (1, None, "", 1, None), (1, 1, "hello there", None, 1), (1, 1, "hello there", None, 1), (1, 1, "", None, 1),
            (1, 2, "", 1, 1), (3, 5, "x" * 200_000, None, -7), (3, -7, "", None, -7), (4, 0, "a > b\nc >> d", None, 0), (5, 0, " keeps  its\tspace \n", None, 0)]
    assert got == sorted(want, key=str)
    assert chat.format_chats(talk([])).count() == 0


def test_a_phrase_that_everybody_writes(talk):
    rows = [(1, t, "user", "> yes\nyes") for t in range(1500)]
    got = {r.turn: r for r in chat.format_chats(talk(rows)).collect()}
    assert got[0].reply_to is None and all(got[t].reply_to == 0 for t in range(1, 1500))


def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    out = queries.op10_chat_format(spark, "/root/testdata/sf0.01")
    assert sorted(tuple(r) for r in out.select("conv_id", "turn", "role", "text").collect()) == sorted(tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect())
