"""Mixing sources to target weights by capped water-filling.

A source's target is ``min(max_epochs * its size, level * its weight)``; the
level is the one at which the targets add up to ``share`` times all sizes.
That is where clamping sources at their maximum and resharing the excess by
weight ends, so it is computed directly from the sources in order of
cap / weight.  Sampling is seeded and exact to a word: ``floor(target /
size)`` whole repetitions of every document, then the documents in order of
a seeded hash until the rest of the target is reached; the document at the
cut gives a fraction of a repetition.

The cut is found without sorting a source: sizes are summed per source and
hash cell (4,096 cells, map-side aggregation), the cell that holds the cut is
split into 4,096 again, and only the documents of that last cell (one in 16
million of a source) are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotline.session import cut_lineage

WHITE_SPACE = " \t\n\x0b\f\r"
#: More sources than this are joined by a shuffle, not a broadcast (a row has some 100 bytes).
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    bare = F.btrim(text.cast("string"), F.lit(WHITE_SPACE))
    # a letter for each word and its white space, so no array of words is made
    return F.coalesce(F.length(F.regexp_replace(bare, "[^ \\t\\n\\x0B\\f\\r]+[ \\t\\n\\x0B\\f\\r]*", "x")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=(5, 2, 1), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size) -> the same with ``target`` (double).

    Weights repeat over the sources by code point, null last.  ``sources``
    has one row per source, so the windows without a key sort sources, not
    documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("_w", pick).withColumn("_cap", F.col("source_size") * F.lit(max_epochs))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    full = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    # where sources up to here are full, the others' level; it rises until the last full one
    s = s.withColumn("_level", (total - F.coalesce(F.sum("_cap").over(full), F.lit(0))) / F.sum("_w").over(rest))
    s = s.withColumn("_level", F.max("_level").over(Window.partitionBy()))
    return s.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w"))).drop("_w", "_cap", "_level")


def _on_source(left: DataFrame, right: DataFrame, keep: list[str], n_sources: int) -> DataFrame:
    right = right.withColumnRenamed("source", "_of")
    right = F.broadcast(right) if n_sources <= BROADCAST_SOURCES else right
    return left.join(right, F.col("source").eqNullSafe(F.col("_of")), "left").select(*left.columns, *keep)


def _cut(cells: DataFrame, rest: str, cell: str, cut: str, left_over: str) -> DataFrame:
    """(source, cut cell, what is left of ``rest`` at its beginning)."""
    w = Window.partitionBy("source").orderBy(cell)
    cells = cells.withColumn("_to", F.sum("_words").over(w)).withColumn("_from", F.col("_to") - F.col("_words"))
    return cells.filter((F.col("_from") < F.col(rest)) & (F.col("_to") >= F.col(rest))).select(
        "source", F.col(cell).alias(cut), (F.col(rest) - F.col("_from")).alias(left_over))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with source, size, seeded hash and its cells; rows that tie follow size and text."""
    text, identifier = F.col(text_col), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), identifier).cast("binary"))
    cell = lambda at: F.conv(F.substring("_key", at, 3), 16, 10).cast("int")
    carried = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")
    rows = docs.select(carried, F.col(source_col).alias("source"), word_count(text).alias("size"), key.alias("_key"), F.xxhash64(text).alias("_tie"))
    return rows.withColumns({"_c1": cell(1), "_c2": cell(4)})


def _plan(sizes: DataFrame, weights, share: float, max_epochs: int) -> tuple[DataFrame, int]:
    """One row per source: size, target, whole repetitions and where the fraction is cut; and their number."""
    sources = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    sources = cut_lineage(sources.withColumn("_whole", whole).withColumn("_rest", goal - F.col("_whole") * F.col("source_size")))
    n = sources.count()
    first = _on_source(sizes.groupBy("source", "_c1").agg(F.sum("size").alias("_words")), sources, ["_rest"], n)
    first = cut_lineage(_cut(first, "_rest", "_c1", "_cut1", "_rest1"))
    in_first = _on_source(sizes, first, ["_cut1", "_rest1"], n).filter("_c1 = _cut1")
    second = in_first.groupBy("source", "_rest1", "_c2").agg(F.sum("size").alias("_words"))
    second = _cut(second, "_rest1", "_c2", "_cut2", "_rest2")
    plan = _on_source(_on_source(sources, first, ["_cut1"], n), second, ["_cut2", "_rest2"], n)
    return cut_lineage(plan.drop("_rest")), n


def _deal(rows: DataFrame, plan: DataFrame, n: int, whole_documents: bool) -> DataFrame:
    """``rows`` with source_size, target and taken."""
    rows = _on_source(rows, plan, ["source_size", "target", "_whole", "_cut1", "_cut2", "_rest2"], n)
    at_cut = F.coalesce((F.col("_c1") == F.col("_cut1")) & (F.col("_c2") == F.col("_cut2")), F.lit(False))
    before = F.coalesce((F.col("_c1") < F.col("_cut1")) | ((F.col("_c1") == F.col("_cut1")) & (F.col("_c2") < F.col("_cut2"))), F.lit(False))
    sure = rows.filter(~at_cut).withColumn("_extra", F.when(before, F.col("size")).otherwise(F.lit(0).cast("long")))
    order = Window.partitionBy("source").orderBy("_key", "size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_rest2") - F.coalesce(F.sum("size").over(order), F.lit(0))
    last = rows.filter(at_cut).withColumn("_left", left)
    some = F.when(F.col("_left") * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0)) if whole_documents else F.col("_left")
    last = last.withColumn("_extra", F.greatest(F.lit(0), F.least(F.col("size"), some)).cast("long")).drop("_left")
    return sure.unionByName(last).withColumn("taken", F.col("_whole") * F.col("size") + F.col("_extra"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(5, 2, 1),
        share: float = 1.5, max_epochs: int = 2, seed: int = 0, whole_documents: bool = False) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, taken.

    ``size`` is the text's words (null text: 0), ``taken`` the words the mix
    takes of it, repeats counted, at most ``max_epochs`` times its size.  A
    source's ``taken`` add up to its target rounded to a word; with
    ``whole_documents`` the document at the cut is taken whole or not at all,
    whichever is nearer.  Null is a source of its own, last in the order.
    Rows that tie in the seeded order (the same identifier twice) follow
    their sizes.  No words at all: targets and taken are 0.  Empty table: no
    rows.  Only the three named columns are read.
    """
    sizes = cut_lineage(_keyed(docs, id_col, text_col, source_col, seed, [id_col]))
    plan, n = _plan(sizes, weights, share, max_epochs)
    return _deal(sizes, plan, n, whole_documents).select(
        F.col(f"_row.`{id_col}`").alias(id_col), "source", "size", "source_size", "target", "taken")


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(5, 2, 1),
         share: float = 1.5, max_epochs: int = 2, seed: int = 0) -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, as often as the mix takes it (whole documents).

    Texts are not shuffled: the plan has a row per source, and only rows of
    the cell at a source's cut are put in order.  A text without words (null,
    empty) takes up no share and stays once; very long texts are taken whole
    or not at all; rows that tie or repeat are dealt as in ``mix``; columns of
    any name are kept.  An empty table gives no rows.
    """
    sizes = cut_lineage(_keyed(docs, id_col, text_col, source_col, seed, []).drop("_row"))
    plan, n = _plan(sizes, weights, share, max_epochs)
    dealt = _deal(_keyed(docs, id_col, text_col, source_col, seed, docs.columns), plan, n, whole_documents=True)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("taken") / F.col("size")).cast("int")
    dealt = dealt.withColumn("_times", times).filter("_times > 0")
    return dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")
