"""Conversation prefix trie: sums over subtrees by depth bands.

A node is a distinct row of first turns.  It is named by 128 bits made of its
depth and of running sums of its turns' digests, each salted with its depth; the
sums run over ranges of the whole order (conversation, depth) and are handed over
at range edges, so a conversation of any length spreads over many tasks.

Subtree sums: nodes explode only to their ancestors inside a band of ``height``
depths.  The completed sums of the band's roots then make a trie of their own,
``height`` times flatter, that is solved in the same way; its totals go back to
the band above each root.  So no node reaches more than ``height`` ancestors,
and a trie of depth D takes as many rounds as D has digits in base ``height``.
A node is represented by its smallest member, whose own path (at most
``height`` rows a band) is all that a group ever holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lotline.session import cut_lineage

HEIGHT = 16
#: A key with more than one in so many of all rows is hot; there are at most so many of them.
HOT = 1000
#: Identifiers of a piece of the list that is hashed.
PIECE = 1000
_SUMS = ("_s0", "_s1", "_s2", "_s3")


# ------------------------------------------------------------ general helpers
def running_sums(rows: DataFrame, key: str, order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with sums of the rows of the same ``key`` up to each row, in ``order``.

    The rows are dealt by ranges of (key, order) and written; what earlier
    ranges hold of the key at a range's edge is added to it (two rows a range
    at most, broadcast).
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = rows.columns
    cut = rows.withColumns({f"_v{i}": v for i, v in enumerate(sums.values())}).repartitionByRange(ranges, key, *order)
    cut = cut_lineage(cut.withColumn("_range", F.spark_partition_id()))
    edges = cut.groupBy("_range").agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
    held = cut.join(F.broadcast(edges), "_range").filter((F.col(key) == F.col("_low")) | (F.col(key) == F.col("_high")))
    held = held.groupBy("_range", key).agg(*[F.sum(f"_v{i}").alias(f"_v{i}") for i in range(len(sums))])
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.select("_range", key, *[F.sum(f"_v{i}").over(before).alias(f"_c{i}") for i in range(len(sums))])
    inside = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.join(F.broadcast(carried), ["_range", key], "left")
    return out.select(*columns, *[(F.coalesce(f"_c{i}", F.lit(0)) + F.sum(f"_v{i}").over(inside)).alias(n) for i, n in enumerate(sums)])


def attach(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str, total: int) -> DataFrame:
    """Inner join with the unique keys of ``right``; ``weight`` is how many rows of ``left`` a key has, ``total`` all of them.

    Keys with more than one in ``HOT`` of the rows (``HOT`` at most) are broadcast, so none of them fills a task.
    """
    on = list(on)
    hot = F.col(weight) > F.lit(max(1, total // HOT))
    many = F.broadcast(right.filter(hot))
    rest = left.join(many.select(*on), on, "left_anti").join(right.filter(~hot), on)
    return left.join(many, on).unionByName(rest)


# ------------------------------------------------------------------- the turns
def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place from 1, digest of role and text, bytes of the text) of every turn.

    Order: turn, null first; ties by digest.  Null role or text is empty.
    Rows without a conversation belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    rows = rows.filter("conv is not null")
    return cut_lineage(running_sums(rows, "conv", ["turn", "digest"], {"place": F.lit(1).cast("long")}).drop("turn"))


def lengths(numbered: DataFrame) -> DataFrame:
    """(conv, length) of every conversation."""
    return numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("length"))


def paths(numbered: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows of the trie: a root row and one per turn: conv, depth, digest, bytes, last."""
    n = numbered.count()
    own = attach(numbered, convs.withColumnRenamed("length", "_length"), ["conv"], "_length", n)
    rows = own.select("conv", F.col("place").alias("depth"), "digest", "bytes", (F.col("place") == F.col("_length")).alias("last"))
    return rows.unionByName(_roots(convs.select("conv", F.col("length").alias("_total"))))


def _roots(totals: DataFrame) -> DataFrame:
    return totals.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"),
                         (F.col("_total") == 0).alias("last"))


def shared_openings(numbered: DataFrame, convs: DataFrame, group: int = 5, longest: int = 8) -> DataFrame:
    """Like ``paths``, with each conversation's opening replaced by that of its group's first one.

    Conversation c gets the first h turns of c - c % ``group`` (all if fewer,
    none if there is no such conversation) and keeps its own turns after its
    first h; h is the unsigned crc32 of c's decimal digits modulo ``longest`` + 1.
    """
    n, convs = numbered.count(), cut_lineage(convs)
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % F.lit(longest + 1)).cast("long")
    head = F.col("conv") - F.col("conv") % F.lit(group)
    heads = convs.select(F.col("conv").alias("_head"), F.col("length").alias("_head_length"))
    plan = convs.withColumns({"_h": h, "_head": head}).join(heads, "_head", "left")
    plan = plan.withColumn("_taken", F.least("_h", F.coalesce("_head_length", F.lit(0).cast("long"))))
    plan = plan.withColumn("_total", F.col("_taken") + F.greatest(F.col("length") - F.col("_h"), F.lit(0).cast("long")))
    plan = cut_lineage(plan.select("conv", "_head", "_h", "_taken", "_total", F.col("length").alias("_length")))
    opening = numbered.filter((F.col("place") <= longest) & (F.col("conv") % group == 0)).withColumnRenamed("conv", "_head")
    opening = opening.join(plan.filter("_taken > 0"), "_head").filter("place <= _taken")
    opening = opening.select("conv", F.col("place").alias("depth"), "digest", "bytes", (F.col("place") == F.col("_total")).alias("last"))
    rest = attach(numbered.filter(F.col("place") > h), plan.select("conv", "_h", "_taken", "_total", "_length"), ["conv"], "_length", n)
    depth = F.col("place") - F.col("_h") + F.col("_taken")
    rest = rest.select("conv", depth.alias("depth"), "digest", "bytes", (depth == F.col("_total")).alias("last"))
    return opening.unionByName(rest).unionByName(_roots(plan))


# -------------------------------------------------------------------- the nodes
def named(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, depth, digest, bytes, last) with the names of their nodes (ka, kb) and of the parents (pa, pb)."""
    part = lambda seed, shift: F.when(F.col("depth") > 0, F.shiftrightunsigned(F.xxhash64(F.lit(seed), "depth", "digest"), shift).bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(0)
    pieces = {s: part(1 + i // 2, 32 * (i % 2)).cast("long") for i, s in enumerate(_SUMS)}
    summed = running_sums(rows, "conv", ["depth"], pieces)
    name = lambda seed, depth, sums: F.xxhash64(F.lit(seed), depth, *sums)
    of, up = [F.col(s) for s in _SUMS], [F.col(s) - piece for s, piece in pieces.items()]
    root = F.col("depth") == 0
    return summed.select(
        "conv", "depth", "bytes", "last", name(3, F.col("depth"), of).alias("ka"), name(4, F.col("depth"), of).alias("kb"),
        F.when(~root, name(3, F.col("depth") - 1, up)).alias("pa"), F.when(~root, name(4, F.col("depth") - 1, up)).alias("pb"))


def _climb(path: DataFrame, nodes: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Sums of ``nodes`` (conv, band, depth, ``sums``) for every row at or above them on the path of their conversation in the band.

    ``path`` has conv, band, depth, ka, kb.  Result: ka, kb, depth, conv (where the row is itself one of the nodes), sums.
    """
    empty = [F.lit(None).cast("long").alias(s) for s in sums]
    none = [F.lit(None).cast("long").alias(k) for k in ("ka", "kb")]
    both = path.select("conv", "band", "depth", "ka", "kb", *empty).unionByName(nodes.select("conv", "band", "depth", *none, *sums))
    groups = both.groupBy("conv", "band").agg(
        F.collect_list(F.when(F.col("ka").isNotNull(), F.struct("depth", "ka", "kb"))).alias("_path"),
        F.collect_list(F.when(F.col("ka").isNull(), F.struct("depth", *sums))).alias("_nodes")).filter(F.size("_nodes") > 0)

    def up(y: Column) -> Column:
        below = F.filter("_nodes", lambda x: x["depth"] >= y["depth"])
        total = [F.aggregate(F.transform(below, lambda x: x[s]), F.lit(0).cast("long"), lambda a, b: a + b).alias(s) for s in sums]
        mine = F.exists("_nodes", lambda x: x["depth"] == y["depth"])
        return F.struct(y["ka"].alias("ka"), y["kb"].alias("kb"), y["depth"].alias("depth"), F.when(mine, F.col("conv")).alias("conv"), *total)

    # nodes lie at the end of their representative's path, but guests from the band below do so behind it
    return groups.select(F.explode(F.transform("_path", up)).alias("_y")).select("_y.*")


def subtree_sums(path: DataFrame, nodes: DataFrame, sums: Sequence[str], height: int = HEIGHT) -> DataFrame:
    """(ka, kb, sums): each node's ``sums`` added up over its subtree, itself included.

    ``path`` has conv, depth, ka, kb of every row, ``nodes`` conv (its
    smallest member), depth and ``sums``.  Written tables are read back at
    every level.
    """
    deepest = path.agg(F.max("depth")).first()[0]
    return _level(path, nodes, list(sums), height, 1, deepest or 0)


def _level(path: DataFrame, nodes: DataFrame, sums: list[str], height: int, unit: int, deepest: int) -> DataFrame:
    """Totals of the nodes at depths divisible by ``unit``."""
    size = unit * height
    band = F.floor(F.col("depth") / F.lit(size))
    path = path.filter(F.col("depth") % F.lit(unit) == 0)
    inside = _climb(path.withColumn("band", band), nodes.withColumn("band", band), sums)
    inside = inside.groupBy("ka", "kb").agg(F.max("conv").alias("conv"), F.max("depth").alias("depth"), *[F.sum(s).alias(s) for s in sums])
    if deepest < size:
        return inside
    inside = cut_lineage(inside)
    above = path.filter(F.col("depth") % F.lit(size) == 0)
    roots = cut_lineage(_level(above, inside.filter(F.col("depth") % F.lit(size) == 0).drop("ka", "kb"), sums, height, size, deepest))
    guests = roots.filter("depth > 0").withColumn("band", (F.col("depth") / F.lit(size) - 1).cast("long"))
    from_below = _climb(path.withColumn("band", band), guests, sums)
    both = inside.unionByName(from_below.select(*inside.columns))
    return both.groupBy("ka", "kb").agg(F.max("conv").alias("conv"), F.max("depth").alias("depth"), *[F.sum(s).alias(s) for s in sums])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces (ka, kb, ids) -> SHA-256 of each node's pieces joined by commas, piece by piece."""
    now, state = None, None
    for batch in batches:
        done = []
        for ka, kb, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (ka, kb) != now:
                if state is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (ka, kb), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _named_rows(done)
    if state is not None:
        yield _named_rows([(*now, state.hexdigest())])


def _named_rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, s = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.string())], names=["ka", "kb", "ends_sha256"])


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(ka, kb, conv) -> (ka, kb, ends_sha256): SHA-256 of a node's decimal identifiers, ascending, joined by commas.

    The identifiers are dealt by ranges and joined to pieces of at most
    ``piece`` there; a node with several pieces is hashed piece by piece in
    their order, so one with a third of all identifiers needs one task to
    read short pieces, and never holds them.
    """
    ranges = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = cut_lineage(ends.repartitionByRange(ranges, "ka", "kb", "conv").withColumn("_range", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy("_range", "ka", "kb").orderBy("conv"))
    pieces = cut.withColumn("_piece", F.floor((place - 1) / F.lit(piece))).groupBy("_range", "ka", "kb", "_piece").agg(F.array_sort(F.collect_list("conv")).alias("_ids"))
    pieces = cut_lineage(pieces.withColumn("_ids", F.array_join(F.transform("_ids", lambda x: x.cast("string")), ",")))
    count = pieces.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("_pieces"), F.max("_ids").alias("_ids"))
    count = cut_lineage(count)
    one = count.filter("_pieces = 1").select("ka", "kb", F.sha2("_ids", 256).alias("ends_sha256"))
    more = pieces.join(count.filter("_pieces > 1").select("ka", "kb"), ["ka", "kb"], "left_semi")
    more = more.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "_range", "_piece").select("ka", "kb", "_ids")
    return one.unionByName(more.mapInArrow(_hash_pieces, "ka long, kb long, ends_sha256 string"))


def trie(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows`` are those of ``paths`` or ``shared_openings``: a root row per
    conversation and one per turn.  A node is named by its smallest member
    ``conv_id`` and its depth; ``saved_tokens`` adds up (members - 1) times the
    bytes of the last text over the subtree.  No rows: no nodes.
    """
    rows = cut_lineage(named(rows))
    nodes = cut_lineage(rows.groupBy("ka", "kb").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("depth").alias("depth"), F.max("bytes").alias("bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb")))
    children = nodes.filter("depth > 0").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["ka", "kb"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    leaf = (F.col("n_children") == 0).cast("long")
    nodes = cut_lineage(nodes.withColumns({"n_leaves": leaf, "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}))
    totals = subtree_sums(rows.select("conv", "depth", "ka", "kb"), nodes.select("conv", "depth", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], height)
    above = nodes.filter("n_children > 0").select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("_below"))
    below = nodes.select("ka", "kb", "pa", "pb", "conv", "depth", "n_convs", "n_children")
    tops = below.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    linked = attach(below.filter("depth > 0"), above, ["pa", "pb"], "_below", nodes.count()).drop("_below")
    all_nodes = linked.unionByName(tops)
    digests = end_digests(rows.filter("last").select("ka", "kb", "conv"))
    out = all_nodes.join(totals.select("ka", "kb", "n_leaves", "saved_tokens"), ["ka", "kb"]).join(digests, ["ka", "kb"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                openings: int | None = None, height: int = HEIGHT) -> DataFrame:
    """The trie of all conversations (see ``trie``); ``openings``: with the openings of groups of so many shared (see ``shared_openings``).

    Turns are in order of ``turn``, null first, ties by content; null role or
    text is empty, a very long text is read once for its digest.  Repeated
    rows are turns of their own.  Rows without a conversation are left out,
    other columns are not read; an empty table gives no rows.
    """
    numbered = turns(conversations, conv_col, turn_col, role_col, text_col)
    convs = lengths(numbered)
    return trie(shared_openings(numbered, convs, openings) if openings else paths(numbered, convs), height)
