import zlib

import numpy as np
from lotline.llm import language, queries
from tests_llm_util import ODD, docs  # noqa: F401


def brute_counts(text, buckets):
    """Every window of 2, 3 and 4 places of the text with edges whose inner places are letters."""
    s = [0, *language.letters(text).tolist(), 0, 0, 0]
    m, total = language._MULTIPLIERS, np.zeros(buckets, np.int64)
    for i in range(len(text) + 1):
        h = s[i] * m[0] & 0xFFFFFFFF
        for n in (2, 3, 4):
            h = ((h ^ h >> 15) * m[1] + s[i + n - 1] * m[n - 1]) & 0xFFFFFFFF
            if s[i + 1] and (n < 4 or s[i + 2]):
                total[((h ^ h >> 13) * m[0] & 0xFFFFFFFF) >> 33 - buckets.bit_length()] += 1
    return total


def test_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Étion dans le 42 ça-va? x Ünd " * 7
    want = brute_counts(text, 4096)
    assert (language.counts(text) == want).all()
    for size in (1, 2, 3, 5, 64):
        monkeypatch.setattr(language, "CHARS", size)
        assert (language.counts(text) == want).all()


def test_held_out_accuracy(spark):
    rows = queries.op9_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and np.mean([r.rejected for r in rows]) < 0.005


def test_rejects_what_it_has_not_met(spark, docs):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(df)
    odd = docs(ODD + [(20, "123 !?"), (21, "Привет мир, как дела у вас сегодня"), (23, "日本語の文章です"), (24, "Zażółć gęślą jaźń wszystkie ćmy"), (22, "the and of with that in the")])
    got = language.identify(odd, model)
    assert got.columns == odd.columns + ["lang_pred", "score", "rejected"]
    by = {(r.doc_id, r.text): r for r in got.collect()}
    for key in ((1, None), (2, ""), (3, " \t\n "), (20, "123 !?")):
        assert by[key].lang_pred == "und" and by[key].score == 0 and by[key].rejected
    assert all(r.rejected for r in by.values() if r.doc_id in (21, 23, 24))
    assert by[22, "the and of with that in the"].lang_pred == "en" and not by[22, "the and of with that in the"].rejected
    assert language.identify(docs([]), model).count() == 0


def test_outliers_leave_the_limits_alone(spark, docs):
    """One-word texts and junk among the labelled ones: texts of other languages are rejected as without them."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(8)
    junk = lambda n: " ".join("".join(rng.choice(list("bcdfghjkqvwxz"), 6)) for _ in range(n))
    odd = [(-1 - i, junk(1 if i % 2 else 40), "en") for i in range(12)]
    model = language.train(df.union(spark.createDataFrame(odd, df.schema)))
    foreign = ["Привет мир, как дела у вас сегодня", "日本語の文章です", "Ez egy magyar nyelvű szöveg, amelyben nincsenek ismert szavak",
               "Tämä on suomenkielinen teksti jota malli ei tunne lainkaan", "Bu cümle Türkçe yazılmış ve model bunu bilmiyor"]
    assert all(r.rejected for r in language.identify(docs(list(enumerate(foreign))), model).collect())
    assert language.identify(df, model).filter("rejected").count() < 5


def test_limits_against_single_outliers():
    cells = [np.arange(100 * (i % 3), 100 * (i % 3) + 100, dtype=np.uint32) for i in range(30)]
    cells += [np.arange(9000, 9100, dtype=np.uint32), np.array([9500], np.uint32)]  # junk, and one word
    shares = [np.eye(3)[i % 3] for i in range(30)] + [np.ones(3) / 3] * 2
    model = language.Model(["a", "b", "c"], np.eye(3) * 9)
    model.calibrate_rejection(shares, cells, np.arange(15), np.arange(15, 32))
    assert model.min_score > 0.6 and model.min_known == 0.5


def test_nothing_to_learn(docs):
    for rows in ([], [(1, "text", None)], [(1, None, "en")], [(1, "", "en")]):
        model = language.train(docs(rows))
        assert model.languages == []
        assert [r.lang_pred for r in language.identify(docs([(1, "text")]), model).collect()] == ["und"]
    one = language.train(docs([(1, "some text", "en"), (2, "more text", "en")]))
    assert language.identify(docs([(1, "text")]), one).collect()[0].lang_pred == "en"


def test_training_repeats(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = language.train(df), language.train(df.repartition(3))
    assert (a.logits == b.logits).all() and (a.seen == b.seen).all()
    assert (a.temperature, a.min_score, a.min_known) == (b.temperature, b.min_score, b.min_known)
