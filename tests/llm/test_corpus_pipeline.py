"""Each stage against brute force on its own input, and the pipeline as a whole."""
from collections import Counter

import corpus_pipeline
import public_tokenizers
from lotline.llm import queries
from pyspark.sql import functions as F
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), None
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or docs.columns
        before = [r.asDict() for r in docs.collect()]
        from lotline.session import cut_lineage
        docs = cut_lineage(stage(spark, docs, SF))
        seen[name] = (before, [r.asDict() for r in docs.collect()])
        if name != "bpe_encode":
            assert docs.columns == columns
    before, after = seen["language_id"]
    assert len(after) >= 0.99 * len(before)
    before, after = seen["exact_dedup"]
    best = {}
    for r in before:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(best.values())
    before, after = seen["simhash_near_dedup"]
    want = set(brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in before], 2))
    assert sorted(r["doc_id"] for r in after) == sorted(want)
    before, after = seen["mix_sources"]
    assert set(Counter(r["doc_id"] for r in after).values()) <= {1, 2}
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
    size = lambda rows: sum(len((r["text"] or "").encode().split()) for r in rows)
    assert abs(size(after) - 1.5 * size(before)) <= 0.1 * size(before)
    before, after = seen["bpe_encode"]
    library = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    want = Counter((r["doc_id"], tuple(library.encode(r["text"], add_special_tokens=False).ids)) for r in before)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want


def test_run_on_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "the and of with", "en", "a", 1), (2, "the and of with", "en", "a", 1), (3, "le la les de", "fr", None, 1)]
    for k, given in enumerate(([], rows)):
        spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        assert {r.doc_id for r in got.collect()} <= {2, 3}


def test_clashing_columns_and_very_long_texts(spark, tmp_path):
    """Columns named like those that the stages add beside a table's own come out as they went in."""
    from lotline.session import cut_lineage
    given = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["_text", "_sha", "_tie", "_row", "_id", "_kept", "_rows", "_gone", "size", "taken", "_lang", "_extra", "ids", "rejected"]
    long = spark.createDataFrame([(10_000, "the and of with " * 60_000, "en", "z", 5)], given.schema)
    docs = cut_lineage(given.union(long).select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names]))
    for name, stage in corpus_pipeline.STAGES:
        if name == "bpe_encode":
            continue
        docs = cut_lineage(stage(spark, docs, SF))
        assert docs.columns == given.columns + names
        assert docs.filter(" or ".join(f"`{n}` is null or `{n}` <> concat('{n}', doc_id)" for n in names)).count() == 0
        assert docs.filter("doc_id = 10000").count() >= (1 if name != "mix_sources" else 0)
    got = corpus_pipeline.encode_tokens(spark, docs, SF)
    assert got.count() == docs.count()
