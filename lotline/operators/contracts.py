"""Row-level contracts: clean rows and rejected rows with their reasons (X-10).

A ``Contract`` says what a table's declaration says: columns that are not null,
keys that are unique, domains, and references to other tables.  Rules on one row
are columns of the one scan of its table.  For references and unique keys only
the keys travel: those of a parent and of all that refers to it in one
aggregation, those of a unique key in another, each with partial sums before the
shuffle, so a parent that a third of all rows refer to is one row per task.  Only
the keys that fail come back to the rows, a rule at a time: none where no key
fails, by broadcast where few do, else by a join on the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.session import cut_lineage

# So many failing keys at most go to every task.
FEW = 100_000


@dataclass(frozen=True)
class Reference:
    """``column`` holds keys of ``parent`` (null: no reference).  With ``when`` = (column, value) only in rows of that value (polymorphic)."""

    column: str
    parent: str
    when: tuple[str, str] | None = None


@dataclass(frozen=True)
class Contract:
    key: str
    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    references: Sequence[Reference] = ()


def _rules(contract: Contract) -> list[Column]:
    """Reasons that a row gives by itself (null where kept)."""
    out = [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in contract.not_null]
    return out + [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values), F.lit(f"allowed:{c}")) for c, values in contract.allowed.items()]


def _whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _refers(reference: Reference, kind: str) -> Column:
    """The key that a row refers to, null for none."""
    column = F.col(reference.column) if reference.when is None else F.when(F.col(reference.when[0]) == reference.when[1], F.col(reference.column))
    return column.cast(kind)


def _orphans(parent: str, tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract], kind: str) -> DataFrame:
    """(_k0): keys that some row refers to and ``parent`` has not."""
    keys = [tables[parent].select(F.col(contracts[parent].key).cast(kind).alias("_k0"), F.lit(True).alias("there"))]
    keys += [tables[name].select(_refers(r, kind).alias("_k0"), F.lit(False).alias("there"))
             for name, c in contracts.items() for r in c.references if r.parent == parent]
    judged = reduce(DataFrame.unionByName, keys).filter("_k0 is not null").groupBy("_k0").agg(F.bool_or("there").alias("there"))
    return judged.filter("not there").select("_k0")


def _unique_key(df: DataFrame, key: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("long" if _whole(df, c) else "string") for c in key]


def _repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(_k0, _k1, ...): values of ``key`` that several rows have; as in SQL, a null is equal to none."""
    keys = df.select(*[c.alias(f"_k{i}") for i, c in enumerate(_unique_key(df, key))]).dropna()
    return keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")


def _marked(df: DataFrame, key: Sequence[Column], failing: DataFrame, many: int, reason: str) -> DataFrame:
    """``df`` with ``reason`` added to the ``_reasons`` of the rows whose key is in ``failing``, which has ``many`` rows."""
    if not many:
        return df
    # a name of their own for the failing keys, which other rules of the table have as well
    hits = failing.select(*[F.col(c).alias(f"_hit{c}") for c in failing.columns], F.lit(True).alias("_hit"))
    equal = reduce(lambda a, b: a & b, [k == F.col(f"_hit_k{i}") for i, k in enumerate(key)])
    joined = df.join(F.broadcast(hits) if many <= FEW else hits, equal, "left")
    reasons = F.when(F.col("_hit"), F.array_union("_reasons", F.array(F.lit(reason)))).otherwise(F.col("_reasons"))
    return joined.withColumn("_reasons", reasons).drop(*hits.columns)


def quarantine(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """{table: (clean rows, rejected rows with ``reasons``, sorted)}; together they are the table's rows.

    All rows of a repeated unique key are rejected.  A reference to a row that
    is itself rejected stands.  Tables without a contract are parents only if
    another names them.  Equal rows are judged alike; an empty table gives
    two empty ones.
    """
    refs = [(name, r) for name, c in contracts.items() for r in c.references]
    missing = {r.parent for _, r in refs} - set(contracts)
    if missing:
        raise ValueError(f"no contract for the referred tables {sorted(missing)}")
    # keys are compared as numbers where all are whole numbers, else as text
    kinds = {p: "long" if _whole(tables[p], contracts[p].key) and all(_whole(tables[name], r.column) for name, r in refs if r.parent == p) else "string"
             for p in {r.parent for _, r in refs}}

    def counted(failing: DataFrame) -> tuple[DataFrame, int]:
        failing = cut_lineage(failing)
        return failing, failing.count()

    orphans = {p: counted(_orphans(p, tables, contracts, kind)) for p, kind in kinds.items()}
    out = {}
    for name, contract in contracts.items():
        df, rules = tables[name], _rules(contract)
        marked = df.withColumn("_reasons", F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>"))
        for r in contract.references:
            marked = _marked(marked, [_refers(r, kinds[r.parent])], *orphans[r.parent], f"reference:{r.column}")
        for key in contract.unique:
            marked = _marked(marked, _unique_key(df, key), *counted(_repeated(df, key)), f"unique:{','.join(key)}")
        judged = cut_lineage(marked.select(*[F.col(f"`{c}`") for c in df.columns], F.array_sort("_reasons").alias("reasons")))
        out[name] = (judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0))
    return out
