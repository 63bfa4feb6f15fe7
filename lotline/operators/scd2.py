"""Slowly changing dimension, type 2 (X-1, X-2).

``scd2_apply`` applies one batch of changes to a dimension table state;
``scd2_from_changes`` builds the whole version table from a change log
(the rebuild form); ``scd2_splice`` applies batches whose changes may lie in the
past; ``scd2_refresh`` compares with a snapshot; ``state_as_of`` is the lookup
at one time and ``state_as_of_join`` the one of a table of times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.operators.dml import dedup_latest
from lotline.operators.keys import dense_key, next_keys
from lotline.operators.ordered import carry_last, ranged
from lotline.session import cut_lineage


def scd2_apply(dim: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], ts,
               surrogate: str = "sk") -> DataFrame:
    """New dimension state after applying ``changes`` at time ``ts``.

    * unchanged current rows stay;
    * a current row whose tracked columns differ (null-safe) is closed
      (effective_to = ts, is_current = false) and a new current version is
      added;
    * keys not in the dimension get a first version;
    * closed history rows pass through.

    ``changes`` holds ``key`` and the tracked columns; several changes of one
    key in a batch keep the last by ``changed_at`` when present.
    """
    tracked = list(tracked)
    ts_col = F.lit(ts).cast(dim.schema["effective_from"].dataType)
    if "changed_at" in changes.columns:
        changes = dedup_latest(changes.select(key, *tracked, "changed_at"), key, "changed_at")
    ch = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in tracked]).withColumn("_in", F.lit(True))
    cur = dim.filter(F.col("is_current"))
    hist = dim.filter(~F.col("is_current"))
    j = cur.join(ch, key, "full")
    in_cur = F.col(surrogate).isNotNull()
    in_ch = F.col("_in").isNotNull()
    same = None
    for c in tracked:
        e = F.col(c).eqNullSafe(F.col(f"_new_{c}"))
        same = e if same is None else (same & e)
    changed = in_cur & in_ch & ~same
    base_cols = [c for c in dim.columns]
    kept = j.filter(in_cur).select(*[
        (F.when(changed, ts_col).otherwise(F.col("effective_to")).alias(c) if c == "effective_to"
         else F.when(changed, F.lit(False)).otherwise(F.col("is_current")).alias(c) if c == "is_current"
         else F.col(c)) for c in base_cols])
    fresh = j.filter(in_ch & (~in_cur | changed)).select(
        key, *[F.col(f"_new_{c}").alias(c) for c in tracked])
    fresh = next_keys(fresh, key, surrogate, dim, surrogate)
    fresh = fresh.select(*[
        F.col(c) if c in fresh.columns else
        (ts_col.alias(c) if c == "effective_from" else
         F.lit(True).alias(c) if c == "is_current" else
         F.lit(None).cast(dim.schema[c].dataType).alias(c))
        for c in base_cols])
    return hist.unionByName(kept).unionByName(fresh.select(*base_cols))


def scd2_from_changes(changes: DataFrame, key: str, tracked: Sequence[str], ts: str,
                      tiebreak: str, surrogate: str = "sk") -> DataFrame:
    """Version table rebuilt from a full change log.

    Changes of one key are ordered by (ts, tiebreak); a change that repeats
    the tracked values of the previous change of the same key opens no new
    version.  effective_to is the next version's effective_from; the last
    version is current.  Neighbours come from ranges of the whole order (see
    ``dense_key``; no window partitioned by key, so a key with a third of all
    changes still spreads over many tasks).
    """
    tracked = list(tracked)
    order = [key, ts, tiebreak]
    seq = dense_key(changes.select(key, *tracked, ts, tiebreak), order, "_seq", prev=[key, *tracked])
    same_as_prev = F.col(f"_prev.{key}") == F.col(key)
    for c in tracked:
        same_as_prev = same_as_prev & F.col(c).eqNullSafe(F.col(f"_prev.{c}"))
    starts = seq.filter(~F.coalesce(same_as_prev, F.lit(False))).select(key, *tracked, ts, tiebreak)
    ver = dense_key(starts, order, surrogate, nxt=[key, ts])
    has_next = F.coalesce(F.col(f"_next.{key}") == F.col(key), F.lit(False))
    return ver.select(surrogate, key, *tracked, F.col(ts).alias("effective_from"),
                      F.when(has_next, F.col(f"_next.{ts}")).alias("effective_to"),
                      (~has_next).alias("is_current"))


def state_as_of(dim: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts``: effective_from <= ts < effective_to (open end)."""
    t = F.lit(ts).cast(dim.schema["effective_from"].dataType)
    return dim.filter((F.col("effective_from") <= t)
                      & (F.col("effective_to").isNull() | (t < F.col("effective_to"))))


def state_as_of_join(times: DataFrame, versions: DataFrame, key: str, at: str, payload: Sequence[str], versions_key: str | None = None,
                     valid_from: str = "effective_from", valid_to: str = "effective_to") -> DataFrame:
    """``times`` (all columns) with ``payload`` of the version of ``key`` that is valid at ``at``.

    A version is valid from ``valid_from`` until before ``valid_to`` (null:
    open); times before the first version, in a gap, without a key or null get
    null.  Versions and times are dealt together by ranges of (key, time); the
    version that is open at a range's end is handed over to the next ranges.
    So nothing is windowed by key, and neither many versions nor many times of
    one key meet in one task.  Of versions that begin at the same time the
    greatest payload counts; versions without a duration never do.
    """
    versions_key = versions_key or key
    lasting = versions.filter(F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to)))
    v = lasting.select(F.col(versions_key).alias("_key"), F.col(valid_from).alias("_time"), F.lit(0).alias("_kind"),
                       F.struct(F.col(versions_key).alias("_key"), F.struct(*payload).alias("_is"), F.col(valid_to).alias("_until")).alias("_version"))
    t = times.select(F.col(key).alias("_key"), F.col(at).alias("_time"), F.lit(1).alias("_kind"), F.struct(*[F.col(f"`{c}`") for c in times.columns]).alias("_row"))
    cut = ranged(v.unionByName(t, allowMissingColumns=True), ["_key", "_time", "_kind", "_version"])
    found = carry_last(cut, F.col("_version"), "_open").filter("_kind = 1")
    valid = (F.col("_open._key") == F.col("_key")) & F.col("_time").isNotNull() & (F.col("_open._until").isNull() | (F.col("_time") < F.col("_open._until")))
    return found.select("_row.*", *[F.when(valid, F.col(f"_open._is.`{c}`")).alias(c) for c in payload])


def scd2_splice(dim: DataFrame, log: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], at: str, tiebreak: str,
                surrogate: str = "sk") -> tuple[DataFrame, DataFrame]:
    """(dimension, change log) after a batch of changes that may lie in the past.

    ``log`` holds all changes taken so far (key, tracked, at, tiebreak).  A
    change inside a closed version splits it; one that repeats the state
    around it opens none, but stays in the log, since a later batch may set
    another state before it.  So batches in any order end in the same
    versions.  Changes already in the log add nothing; of one key's changes
    at the same time the last by ``tiebreak`` counts.  Versions of keys
    without changes, and versions whose beginning and values stay, keep their
    surrogate; others are numbered after the maximum, by key and time.
    """
    tracked = list(tracked)
    columns = [key, *tracked, at, tiebreak]
    fresh = changes.select(*columns).dropDuplicates([key, at, tiebreak]).join(log, [key, at, tiebreak], "left_anti")
    log = cut_lineage(log.select(*columns).unionByName(fresh.select(*columns)))
    touched = cut_lineage(fresh.select(key).distinct())
    points = log.join(touched, key, "left_semi").groupBy(key, at).agg(F.max_by(F.struct(*tracked), tiebreak).alias("_is")).select(key, at, "_is.*")
    versions = scd2_from_changes(points.withColumn("_tie", F.lit(0)), key, tracked, at, "_tie", surrogate="_version")
    old = dim.join(touched, key, "left_semi").select(F.col(key).alias("_key"), F.col("effective_from").alias("_from"), F.struct(*tracked).alias("_was"), surrogate)
    same = (F.col(key) == F.col("_key")) & (F.col("effective_from") == F.col("_from")) & F.struct(*tracked).eqNullSafe(F.col("_was"))
    joined = cut_lineage(versions.join(old, same, "left").drop("_version", "_key", "_from", "_was"))
    opened = next_keys(joined.filter(F.col(surrogate).isNull()).drop(surrogate), [key, "effective_from"], surrogate, dim, surrogate)
    rest = dim.join(touched, key, "left_anti")
    out = rest.unionByName(joined.filter(F.col(surrogate).isNotNull()).select(*dim.columns)).unionByName(opened.select(*dim.columns))
    return out, log


def scd2_refresh(dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], ts, surrogate: str, overwritten: Sequence[str] = ()) -> DataFrame:
    """New dimension state after comparing its current versions with a ``snapshot`` of all keys as they are now.

    A current version whose ``tracked`` values differ, or whose key is gone,
    is closed at ``ts``; new keys and changed ones get a new version, numbered
    after the maximum.  ``overwritten`` columns (type 1) take the snapshot's
    value in current versions without a new one.
    """
    now = snapshot.select(key, *tracked, *overwritten)
    gone = dim.filter("is_current").join(now.select(key), key, "left_anti").select(key).withColumn("_gone", F.lit(True))
    ts_col = F.lit(ts).cast(dim.schema["effective_to"].dataType)
    closing = F.col("_gone").isNotNull() & F.col("is_current")
    closed = dim.join(gone, key, "left").select(*[
        F.when(closing, ts_col).otherwise(F.col(c)).alias(c) if c == "effective_to" else
        (F.col(c) & ~closing).alias(c) if c == "is_current" else F.col(c) for c in dim.columns])
    applied = scd2_apply(closed, now, key, tracked, ts, surrogate)
    if not overwritten:
        return applied
    later = now.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_now_{c}") for c in overwritten])
    j = applied.join(later, F.col(key) == F.col("_key"), "left")
    return j.select(*[F.when(F.col("is_current") & F.col("_key").isNotNull(), F.col(f"_now_{c}")).otherwise(F.col(c)).alias(c) if c in overwritten else F.col(c)
                      for c in dim.columns])
