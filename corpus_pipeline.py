"""Corpus pipeline: language, exact and near copies, source mix, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet into the shared
folder that ``spark.checkpoint.dir`` names and reads again for the next one.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotline.llm import bpe, exact_dedup, language, mixing, simhash
from lotline.llm.queries import vocabulary
from lotline.session import cut_lineage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the stage's own input; rows whose language it rejects go.

    Null and empty texts, and texts without a letter, have none and go; without
    a labelled text all rows go.  Very long texts are read whole; equal and
    tied rows are judged alike, and each stays.  An empty table gives an empty
    one; columns of any name are kept.
    """
    model = language.train(docs.filter(~language.held_out("doc_id")))
    return language.drop_unidentified(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    Null and empty texts are equal; a null doc_id stays only where its group
    has no other; of rows that tie (same doc_id and text) one stays.  Very long
    texts meet by digest.  An empty table gives an empty one; columns of any
    name are kept.
    """
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints the document with the smallest doc_id stays.

    Texts without words (null, empty, blank) are one group; a null doc_id
    counts last; rows that repeat the one that stays (same doc_id and text)
    stay with it.  Very long texts are hashed by parts.  An empty table gives
    an empty one; columns of any name are kept.
    """
    return simhash.drop_near_duplicates(docs, width=3, seed=42, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: weights 5, 2, 1, 150 % of all words, two epochs at most.

    Null is a source of its own; texts without words (null, empty) stay once;
    very long texts are taken whole or not at all; rows that tie in the seeded
    order follow size and text, repeated rows are dealt each.  An empty table
    gives an empty one; columns of any name are kept.
    """
    return mixing.take(docs, weights=(5, 2, 1), share=1.5, max_epochs=2)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of the ids and of the decoded text.

    Null and empty texts have no tokens; very long ones are encoded whole;
    tied and repeated rows are encoded each.  An empty table gives no rows; of
    other columns doc_id, lang and source are kept.
    """
    return bpe.encode(docs, vocabulary(), keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode_tokens),
]

#: The trained language model, XXH64 and BPE have no SQL form; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
