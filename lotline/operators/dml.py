"""Table DML as DataFrame rewrites (S-15, S-16, X-7, X-8, X-9).

Parquet has no MERGE/UPDATE, so each operator returns the *new table
state*; the sink writes it as a new version (``sources.lakehouse``).  All
of them are joins on the key: no id list is ever inlined into a predicate,
and no key group is collected anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def unique_source(source: DataFrame, key, message: str = "MERGE source has duplicate keys") -> DataFrame:
    """One row per key, failing the job if a key occurs twice (what Delta's
    MERGE does).  A partial aggregate, so a hot key is combined map-side;
    the check sits in the key expression so the optimizer cannot prune it."""
    ks = _keys(key)
    others = [c for c in source.columns if c not in ks]
    agg = source.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"),
                                  *([F.any_value(F.struct(*others)).alias("_u")] if others else []))
    first = ks[0]
    checked = F.coalesce(F.assert_true(F.col("_n") == 1, F.lit(message)).cast(source.schema[first].dataType),
                         F.col(first)).alias(first)
    cols = [checked] + [F.col(k) for k in ks[1:]] + [F.col(f"_u.{c}").alias(c) for c in others]
    return agg.select(*cols)


def merge_matched(target: DataFrame, source: DataFrame, key, set_: Mapping[str, Column]) -> DataFrame:
    """MERGE ... WHEN MATCHED THEN UPDATE SET (no insert, no delete).

    ``set_`` maps target columns to expressions over the source, written as
    ``F.col("u.<col>")`` (or any literal expression).  Unmatched target rows
    are unchanged; unmatched source rows are ignored, however often they
    repeat; several source rows for one target row fail the job.
    """
    ks = _keys(key)
    # only keys that the target has can clash, as in Delta
    reached = source.join(target.select(*ks).distinct(), ks, "left_semi")
    src = unique_source(reached, ks).withColumn("_matched", F.lit(True)).alias("u")
    t = target.alias("t")
    j = t.join(src, [F.col(f"t.{k}") == F.col(f"u.{k}") for k in ks], "left")
    matched = F.col("u._matched").isNotNull()
    out = []
    for c in target.columns:
        if c in set_:
            out.append(F.when(matched, set_[c]).otherwise(F.col(f"t.{c}"))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)


def update_where_in(target: DataFrame, ids: DataFrame, key: str, set_: Mapping[str, Column]) -> DataFrame:
    """UPDATE target SET ... WHERE key IN (ids) as a join with the distinct
    ids (S-15); an empty id set is a no-op."""
    flag = ids.select(F.col(ids.columns[0]).alias(key)).distinct().withColumn("_hit", F.lit(True))
    j = target.join(flag, key, "left")
    hit = F.col("_hit").isNotNull()
    return j.select(*[
        (F.when(hit, set_[c]).otherwise(F.col(c)).cast(target.schema[c].dataType) if c in set_ else F.col(c)).alias(c)
        for c in target.columns])


def dedup_latest(df: DataFrame, key, order: Sequence[str] | str) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order`` (X-7).

    ``max_by`` is a partial aggregate: duplicates are dropped on the map
    side before the shuffle, so a key with a third of all copies is mostly
    removed before it reaches one task.  Ties in ``order`` keep any one of
    the tied rows; pass a unique last order column for a fixed choice.
    """
    ks = _keys(key)
    order_cols = [order] if isinstance(order, str) else list(order)
    others = [c for c in df.columns if c not in ks]
    agg = df.groupBy(*ks).agg(F.max_by(F.struct(*others), F.struct(*order_cols)).alias("_r"))
    return agg.select(*ks, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def upsert_since(target: DataFrame, source: DataFrame, key, since, ts_col: str = "updated_at", tie_break: str | Sequence[str] | None = None) -> DataFrame:
    """Incremental load (X-8): source rows changed after ``since``, latest per
    key, replace matching target rows and insert new keys.  Rows of a key with
    the same time go by ``tie_break`` (by all columns when not given)."""
    ks = _keys(key)
    changes = source.filter(F.col(ts_col) > F.lit(since).cast(source.schema[ts_col].dataType))
    ties = [c for c in source.columns if c not in ks] if tie_break is None else [tie_break] if isinstance(tie_break, str) else list(tie_break)
    changes = dedup_latest(changes, ks, [ts_col, *ties]).select(*target.columns)
    kept = target.join(changes.select(*ks), ks, "left_anti")
    return kept.unionByName(changes)


def soft_delete(df: DataFrame, ids: DataFrame, key: str, as_of) -> DataFrame:
    """Mark rows deleted (X-9): is_deleted = true, deleted_at = as_of."""
    ts = F.lit(as_of).cast(df.schema["deleted_at"].dataType)
    return update_where_in(df, ids, key, {"is_deleted": F.lit(True), "deleted_at": ts})


def live(df: DataFrame) -> DataFrame:
    """Readers' filter for soft-deleted rows (P-6)."""
    return df.filter(~F.col("is_deleted"))
