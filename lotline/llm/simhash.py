"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are made whole text by whole text in Arrow batches.  Links (at
most ``radius`` differing bits) are then found between *distinct*
fingerprints only:

* **Upper nodes.**  The 64 bits are cut into ``radius + 1`` blocks; two linked
  fingerprints agree in one block at least.  Each fingerprint enters the index
  once per block, under the node (block, its bits there).
* **Hot nodes.**  A node of more than ``NODE_ROWS`` entries is factored: its
  children are the values of the next eight bits.  An entry is stored under
  its own child and sent as a query, with the differences accumulated so far,
  to those children only that stay within the radius.  This repeats until no
  node is too large, at the latest when all bits are used up and a node holds
  a single fingerprint, so no group, however dense, lands in one task.
* **Inside a node** the entries are sorted by Gray rank, in which neighbours
  share long runs of bits; runs of eight are factored into a parent that holds
  the bits all of them share (mask and pattern), parents again into theirs.
  Pairs of nodes are walked from the roots, and a pair is pruned with all that
  is below it as soon as the shared bits alone differ in more than ``radius``.

Every task reduces the links it finds to a forest (a link to the smallest
fingerprint of each local component), and components are joined by alternating
large-star and small-star rounds, so no table of all pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lotline.llm.memory import give_back
from lotline.session import cut_lineage

NODE_ROWS = 16_384
BATCH_ROWS = 32_768
FANOUT = 8
CHILD_BITS = 8
#: Shingles hashed at a time, so that a very long text needs no more memory.
SHINGLES = 65_536


# ---------------------------------------------------------------- fingerprints
def fingerprint(text: bytes, width: int, seed: int) -> int:
    """Bits set in over half the hashes of the text's ``width``-word shingles (fewer words: all of them)."""
    words = text.lower().split()  # bytes: A-Z only, and white space is \x20 \x09-\x0D
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    tops, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES):
        to = min(n, at + SHINGLES)
        a, b = starts[at:to].tolist(), ends[min(at + width, len(words)) - 1 : to + width - 1].tolist()
        h = np.fromiter((digest(joined[x:y], seed) for x, y in zip(a, b, strict=True)), np.uint64, to - at)
        tops += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * tops > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, _tie, _fp) per row; ``_tie`` tells apart different texts of one identifier.  A null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (x or b"" for x in batch.column(2).cast(pa.large_binary()).to_pylist())
            fp = np.array([fingerprint(x, width, seed) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=["_id", "_tie", "_fp"])
        give_back()

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text"))
    return rows.mapInArrow(make, f"_id {kind}, _tie long, _fp long")


# ----------------------------------------------------------------------- index
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a fingerprint in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class Levels:
    """Gray-ordered fingerprints of several nodes, factored into parents of up to ``FANOUT`` neighbours.

    Level 0 has the fingerprints; each upper entry holds the bits that all of
    its children share (``mask``, ``bits``) and its children's range.
    """

    def __init__(self, node: np.ndarray, fp: np.ndarray):
        order = np.lexsort((gray_rank(fp), node))
        self.order, self.fp = order, fp[order]
        node = node[order]
        self.mask, self.bits, self.first, self.last = [np.full(len(fp), ~np.uint64(0))], [self.fp], [None], [None]
        while len(node) and np.any(node[1:] == node[:-1]):
            new = np.concatenate(([True], node[1:] != node[:-1]))
            begins = np.flatnonzero(new)
            place = np.arange(len(node)) - np.repeat(begins, np.diff(np.append(begins, len(node))))
            first = np.flatnonzero(place % FANOUT == 0)
            ones, zeros = np.bitwise_and.reduceat(self.mask[-1] & self.bits[-1], first), np.bitwise_and.reduceat(self.mask[-1] & ~self.bits[-1], first)
            self.mask.append(ones | zeros)
            self.bits.append(ones)
            self.first.append(first)
            self.last.append(np.append(first[1:], len(node)))
            node = node[first]
        self.root = node

    def pairs(self, other: "Levels", a: np.ndarray, b: np.ndarray, level: int, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of linked fingerprints below the pairs (a, b) of entries at ``level``."""
        stack = [(level, a, b)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > BATCH_ROWS:  # bounds the front; the rest waits
                stack.append((level, a[BATCH_ROWS:], b[BATCH_ROWS:]))
                a, b = a[:BATCH_ROWS], b[:BATCH_ROWS]
            shared = self.mask[level][a] & other.mask[level][b]
            near = np.bitwise_count((self.bits[level][a] ^ other.bits[level][b]) & shared) <= radius
            a, b = a[near], b[near]
            if not len(a):
                continue
            if level == 0:
                if same:
                    a, b = a[a < b], b[a < b]
                yield a, b
                continue
            fa, na = self.first[level][a], self.last[level][a] - self.first[level][a]
            fb, nb = other.first[level][b], other.last[level][b] - other.first[level][b]
            n = na * nb
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            nb = np.repeat(nb, n)
            a, b = np.repeat(fa, n) + k // nb, np.repeat(fb, n) + k % nb
            if same:  # a node with itself: each pair once
                keep = a <= b
                a, b = a[keep], b[keep]
            stack.append((level - 1, a, b))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest member) of the components of the links (a, b)."""
    names, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    up = np.arange(len(names))
    while True:  # hook the larger root under the smaller, then shorten
        rx, ry = up[x], up[y]
        if np.array_equal(rx, ry):
            break
        np.minimum.at(up, np.maximum(rx, ry), np.minimum(rx, ry))
        while not np.array_equal(up, up[up]):
            up = up[up]
    member = np.flatnonzero(up != np.arange(len(names)))
    return names[member], names[up[member]]


def solve(node: np.ndarray, fp: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links inside each node: stored with stored, and queries with stored."""
    stored, asked = Levels(node[~query], fp[~query]), Levels(node[query], fp[query])
    top = len(stored.mask) - 1
    own = np.arange(len(stored.root))
    fx, fy = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def found(one: Levels, a: np.ndarray, b: np.ndarray) -> None:
        nonlocal fx, fy
        links.append((one.fp[a].view(np.int64), stored.fp[b].view(np.int64)))
        if sum(len(x) for x, _ in links) > 1 << 20:
            fx, fy = forest(*[np.concatenate(z) for z in zip((fx, fy), *links, strict=True)])
            links.clear()

    links: list = []
    if len(own):
        for a, b in stored.pairs(stored, own, own, top, radius, True):
            found(stored, a, b)
    if len(asked.root) and len(own):
        at = np.searchsorted(stored.root, asked.root)
        hit = (at < len(own)) & (stored.root[np.minimum(at, len(own) - 1)] == asked.root)
        # bring both to the same height: a lone entry is its own parent
        low, high = (asked, stored) if len(asked.mask) < len(stored.mask) else (stored, asked)
        while len(low.mask) < len(high.mask):
            k = np.arange(len(low.root))
            low.mask.append(low.mask[-1]); low.bits.append(low.bits[-1]); low.first.append(k); low.last.append(k + 1)  # noqa: E702
        for a, b in asked.pairs(stored, np.flatnonzero(hit), at[hit], len(stored.mask) - 1, radius, False):
            found(asked, a, b)
    return forest(*[np.concatenate(z) for z in zip((fx, fy), *links, strict=True)])


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush(t: pa.Table) -> Iterator[pa.RecordBatch]:
            if t.num_rows > 1:
                _, node = np.unique(np.stack([t.column(c).to_numpy() for c in ("_block", "_value", "_path")]), axis=1, return_inverse=True)
                a, b = solve(node.reshape(-1), t.column("_fp").to_numpy().view(np.uint64), t.column("_query").to_numpy(zero_copy_only=False), radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["_a", "_b"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= BATCH_ROWS:
                t = pa.concat_tables(held).combine_chunks()
                keys = np.stack([t.column(c).to_numpy() for c in ("_block", "_value", "_path")])
                change = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0))
                cut = int(change[-1]) + 1 if len(change) else 0  # the last node may go on in the next batch
                yield from flush(t.slice(0, cut))
                held = [t.slice(cut)]
        if held:
            yield from flush(pa.concat_tables(held).combine_chunks())

    return run


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``radius + 1`` blocks."""
    at = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    return [(x, y - x) for x, y in zip(at, at[1:], strict=False)]


def _index(fps: DataFrame, radius: int, node_rows: int) -> DataFrame:
    """Entries (_fp, _query, _diff, _block, _value, _path), every node of a bounded size."""
    value = lambda x, at, bits: F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << bits) - 1)) if bits < 64 else x
    roots = F.array(*[F.struct(F.lit(i).cast("long").alias("_block"), value(F.col("_fp"), *b).cast("long").alias("_value")) for i, b in enumerate(_blocks(radius))])
    entries = fps.select("_fp", F.explode(roots).alias("_n")).select(
        "_fp", F.lit(False).alias("_query"), F.lit(0).alias("_diff"), "_n.*", F.lit(0).cast("long").alias("_path"))
    entries, done, key = cut_lineage(entries), [], ["_block", "_value", "_path"]
    for depth in range(64 // CHILD_BITS):
        hot = entries.groupBy(*key).count().filter(F.col("count") > node_rows).select(*key)
        hot = cut_lineage(hot)
        if hot.isEmpty():
            break
        done.append(entries.join(hot, key, "left_anti"))
        bits = value(F.col("_fp"), depth * CHILD_BITS, CHILD_BITS).cast("int")
        own = F.lit(1 << (CHILD_BITS * (depth % 7))).cast("long")
        near = F.filter(F.sequence(F.lit(0), F.lit((1 << CHILD_BITS) - 1)), lambda c: F.bit_count(c.bitwiseXOR(F.col("_bits"))) + F.col("_diff") <= radius)
        near = F.when(F.col("_query"), near).otherwise(F.filter(near, lambda c: c >= F.col("_bits")))
        child = entries.join(hot, key, "left_semi").withColumn("_bits", bits).withColumn("_c", F.explode(near))
        child = child.withColumn("_query", F.col("_query") | (F.col("_c") != F.col("_bits")))
        child = child.withColumn("_diff", F.col("_diff") + F.bit_count(F.col("_c").bitwiseXOR(F.col("_bits"))).cast("int"))
        # the path to a node is hashed with its value: equal paths always meet, and a chance meeting is only verified in vain
        child = child.withColumn("_path", F.xxhash64("_path", "_c", own)).drop("_bits", "_c")
        stored = child.filter("not _query").select(*key).distinct()
        entries = cut_lineage(child.join(stored, key, "left_semi"))
    for x in done:
        entries = entries.unionByName(x)
    return entries


def links(fps: DataFrame, radius: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """(_a, _b): a forest whose components are those of all links between the distinct ``_fp``."""
    entries = _index(fps, radius, node_rows)
    dealt = entries.repartition("_block", "_value", "_path").sortWithinPartitions("_block", "_value", "_path")
    return dealt.select("_block", "_value", "_path", "_fp", "_query").mapInArrow(_links(radius), "_a long, _b long")


# ------------------------------------------------------------------ components
def components(edges: DataFrame, a: str = "_a", b: str = "_b", rounds: int = 64) -> DataFrame:
    """(_node, _root) for every node of an edge: the smallest node of its component.

    Alternating star rounds: each node hands its larger neighbours, then its
    smaller ones, to the smallest of them, until every edge points to a root.
    Minima are aggregated before the shuffle and joined back, so a node with
    very many neighbours is split like any skewed join.
    """
    edges = cut_lineage(edges.filter(f"{a} <> {b}").select(F.greatest(a, b).alias("_u"), F.least(a, b).alias("_v")).distinct())
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("_v"), F.col("_u"))).toDF("_u", "_v")
        least = both.groupBy("_u").agg(F.min("_v").alias("_m")).withColumn("_m", F.least("_u", "_m"))
        large = both.filter("_v > _u").join(least, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).distinct()
        large = cut_lineage(large.filter("_u <> _v"))
        least = large.groupBy("_u").agg(F.min("_v").alias("_m"))
        small = large.join(least, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).union(least.toDF("_u", "_v"))
        small = cut_lineage(small.filter("_u <> _v").distinct())
        # done when every node has one smaller neighbour, and that is a root
        many = small.groupBy("_u").count().filter("count > 1").select(F.lit(1).alias("_x"))
        inner = small.join(small.select(F.col("_u").alias("_v")).distinct(), "_v", "left_semi").select(F.lit(1).alias("_x"))
        edges = small
        if many.limit(1).union(inner.limit(1)).isEmpty():
            return edges.toDF("_node", "_root")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42,
                    radius: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id, _tie, kept.

    ``component_id`` is the smallest identifier reachable over links of at
    most ``radius`` bits.  Texts without words (null, empty, blank) have
    fingerprint zero and link like any other.  ``kept`` marks one text per
    component: the smallest identifier's (of several texts under that
    identifier, one); rows repeating it whole all say ``kept``.  Null
    identifiers count last.  An empty table gives no rows.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, width, seed))
    order = F.struct(F.col("_id").isNull().alias("_none"), F.col("_id"), F.col("_tie"))
    nodes = cut_lineage(rows.groupBy("_fp").agg(F.min(order).alias("_least")))
    found = components(links(nodes.select("_fp"), radius, node_rows))
    rooted = nodes.join(found, F.col("_fp") == F.col("_node"), "left").select("_fp", "_least", F.coalesce("_root", "_fp").alias("_root"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("_first"))
    named = rooted.join(least, "_root").select("_fp", "_first")
    out = rows.join(named, "_fp")
    return out.select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_first._id").alias("component_id"), "_tie",
        (F.col("_id").eqNullSafe(F.col("_first._id")) & F.col("_tie").eqNullSafe(F.col("_first._tie"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` (all columns, of any name) with one text left of each component; rows that repeat it whole are left to exact dedup.

    Null, empty and blank texts are one component; a very long text is hashed
    by parts.  An empty table gives no rows.
    """
    gone = near_duplicates(docs, id_col, text_col, **how).filter("not kept").select(F.col(id_col).alias("_gone"), F.col("_tie").alias("_gone_tie")).distinct()
    # the rows' own columns lie in one struct, so that no name of theirs can clash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col(f"`{id_col}`").alias("_of"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("_of_tie"))
    return rows.join(gone, F.col("_of").eqNullSafe(F.col("_gone")) & (F.col("_of_tie") == F.col("_gone_tie")), "left_anti").select("_row.*")
