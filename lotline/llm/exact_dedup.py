"""Exact dedup: tree-merge of sorted digest runs (DataFrame functions only).

Every input partition is a *run*: its rows' digests are written in order, and
rows of one text beside each other become one entry before anything leaves the
partition.  With ``lanes = radix ** levels`` run numbers, round k is a round of
a binomial tree of that radix: runs whose numbers differ only in digit k
exchange entries, each taking those whose digest has its own digit there.  What
arrives is merged in order, and neighbours that agree become one entry.  After
``levels`` rounds every digest is in one place, with the identifier to keep.

A round is a sort-based aggregation (the plan shows Sort, SortAggregate,
Exchange, Sort, SortAggregate): the identifier travels in a struct, for which
Spark merges sorted neighbours and builds no hash table, so a run of any length
spills as sorted files.

An entry is (64-bit digest, SHA-256, byte length, identifier kept, rows).  The
64-bit digest orders and places an entry; neighbours are merged only if SHA-256
and length agree as well, checked at every level, so digests that collide stay
apart.  Each level keeps one entry per verified text and run, so a text that
holds a third of all rows shrinks to at most ``lanes`` entries a task before the
first exchange and to fewer after every round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotline.session import cut_lineage

RADIX, LEVELS = 8, 2


def digest_columns(text: Column) -> dict[str, Column]:
    """Digest, verification hash and byte length of a text (null: empty)."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return {"_digest": F.xxhash64(whole), "_sha": F.sha2(whole, 256), "_bytes": F.octet_length(whole)}


def merge_runs(runs: DataFrame, keep: str, radix: int = RADIX, levels: int = LEVELS) -> DataFrame:
    """(_digest, _sha, _bytes, _keep, _n): the runs' entries merged in ``levels`` rounds.

    Null identifiers are kept only where an entry has no other; no runs give no rows.
    """
    best = F.max if keep == "largest" else F.min
    runs = runs.withColumn("_best", F.when(F.col("_keep").isNotNull(), F.struct("_keep"))).drop("_keep")
    for k in range(levels):
        merged = F.lit(radix ** (k + 1))
        # a run is named by the digits not merged yet, and holds the digests that share the merged ones
        run = F.floor(F.col("_run") / merged).cast("int")
        runs = (
            runs.groupBy(run.alias("_rest"), F.pmod(F.col("_digest"), merged).alias("_lane"), "_digest", "_sha", "_bytes")
            .agg(best("_best").alias("_best"), F.sum("_n").alias("_n"))
            .withColumn("_run", F.col("_rest") * merged)
            .drop("_rest", "_lane")
        )
    return runs.select("_digest", "_sha", "_bytes", F.col("_best._keep").alias("_keep"), "_n")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                radix: int = RADIX, levels: int = LEVELS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; a null text counts as empty.  ``keep`` is
    ``smallest`` or ``largest`` identifier.  Null identifiers count as rows
    but are kept only where a group has no other.  Rows that repeat the kept
    identifier with the same text all say ``kept`` (``drop_copies`` leaves one
    of them).  An empty table gives no rows; other columns are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    rows = docs.select(F.col(id_col).alias("_id"), *[c.alias(n) for n, c in digest_columns(F.col(text_col)).items()])
    rows = rows.withColumn("_run", F.pmod(F.spark_partition_id(), F.lit(radix ** levels)))
    rows = cut_lineage(rows.sortWithinPartitions("_digest", "_sha", "_bytes"))
    runs = rows.select("_run", "_digest", "_sha", "_bytes", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_n"))
    copies = merge_runs(runs, keep, radix, levels).filter("_n > 1")
    found = rows.join(copies, ["_digest", "_sha", "_bytes"], "left")
    keep_id = F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return found.select(
        F.col("_id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep_id).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row left of each group of equal texts (all columns).

    The kept identifier's first row stays; if the very same identifier and
    text stand in several rows, one of them stays.  Null and empty texts are
    equal; a very long text is compared by its digests; columns of any name
    are kept.  An empty table gives no rows.
    """
    columns = docs.columns
    marks = exact_dedup(docs, id_col, text_col, keep).filter("group_size > 1")
    marks = marks.groupBy(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")).agg(
        F.first("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
    # the rows' own columns lie in one struct, so that no name of theirs can clash
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")
    rows = docs.select(row, F.col(f"`{id_col}`").alias("_of"), digest_columns(F.col(f"`{text_col}`"))["_sha"].alias("_text_sha"))
    tagged = rows.join(marks, F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_text_sha") == F.col("_sha")), "left")
    single = tagged.filter(F.coalesce("_kept", F.lit(True)) & (F.coalesce("_rows", F.lit(1)) == 1)).select("_row.*")
    again = tagged.filter(F.col("_kept") & (F.col("_rows") > 1))
    return single.unionByName(again.dropDuplicates(["_of", "_text_sha"]).select("_row.*"))
