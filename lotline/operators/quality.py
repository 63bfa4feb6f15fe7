"""Contract checks and source-mix KPI (X-10, X-5).

Checks run as aggregates, never as driver loops: not-null and allowed-value
rules are ``count_if`` columns of one pass over the table; uniqueness is a
partial aggregate per key; foreign keys are anti-joins.  The result is one
small DataFrame ``(table, rule, column, failing)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def violations(df: DataFrame, table: str, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (),
               allowed: Mapping[str, Sequence[str]] | None = None,
               foreign_keys: Sequence[tuple[str, DataFrame, str]] = (),
               polymorphic: Sequence[tuple[str, str, Mapping[str, tuple[DataFrame, str]]]] = ()) -> DataFrame:
    """Rows failing each rule.

    * ``not_null``: column is null;
    * ``unique``: rows whose key occurs more than once (rows, not groups);
    * ``allowed``: non-null value outside the domain;
    * ``foreign_keys``: (column, parent, parent column) non-null value with
      no parent row;
    * ``polymorphic``: (type column, id column, {type: (parent, parent id)})
      id with no row in the parent its type names; unknown types fail.
    """
    allowed = allowed or {}
    parts: list[DataFrame] = []
    single = []
    for c in not_null:
        single.append((f"not_null", c, F.count_if(F.col(c).isNull())))
    for c, values in allowed.items():
        single.append(("allowed_values", c, F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values))))
    if single:
        agg = df.agg(*[e.alias(f"_v{i}") for i, (_, _, e) in enumerate(single)])
        stacked = F.explode(F.array(*[
            F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(f"_v{i}").cast("long").alias("failing"))
            for i, (r, c, _) in enumerate(single)]))
        parts.append(agg.select(stacked.alias("_s")).select("_s.*"))
    for key in unique:
        key = list(key)
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
               .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("failing")))
        parts.append(dup.select(F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column"), "failing"))
    for c, parent, pc in foreign_keys:
        orphans = df.filter(F.col(c).isNotNull()).join(
            parent.select(F.col(pc).alias(c)), c, "left_anti").agg(F.count(F.lit(1)).cast("long").alias("failing"))
        parts.append(orphans.select(F.lit("foreign_key").alias("rule"), F.lit(c).alias("column"), "failing"))
    for type_col, id_col, targets in polymorphic:
        tagged = None
        for type_value, (parent, pc) in targets.items():
            t = parent.select(F.lit(type_value).alias(type_col), F.col(pc).alias(id_col))
            tagged = t if tagged is None else tagged.unionByName(t)
        orphans = df.join(tagged, [type_col, id_col], "left_anti").agg(
            F.count(F.lit(1)).cast("long").alias("failing"))
        parts.append(orphans.select(F.lit("polymorphic_fk").alias("rule"),
                                    F.lit(f"{type_col},{id_col}").alias("column"), "failing"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table"), "rule", "column", "failing")


def source_mix(tables: Sequence[tuple[str, DataFrame]], keys: Sequence[str] = ()) -> DataFrame:
    """Share of records by source (X-5): per entity, source and optional
    keys (e.g. branch, date): count and percent of the entity/key total.
    Every table must have ``source_id`` and the keys."""
    keys = list(keys)
    tagged = None
    for name, df in tables:
        t = df.select(F.lit(name).alias("entity"), "source_id", *keys)
        tagged = t if tagged is None else tagged.unionByName(t)
    counts = tagged.groupBy("entity", *keys, "source_id").agg(F.count(F.lit(1)).alias("records"))
    total = F.sum("records").over(Window.partitionBy("entity", *keys))
    return counts.withColumn("pct_of_records", F.round(F.col("records") * 100.0 / total, 2))
