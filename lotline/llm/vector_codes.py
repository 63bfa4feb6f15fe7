"""Vector code compression: product codes of integer vectors, by value dictionaries.

Components become integers (``floor(scale * x)``) and are written once as blocks:
for each dimension the block's distinct integers (its *dictionary*) and a two-byte
dictionary code per vector.  A round never looks at a vector again.  It tabulates
the squared difference of every distinct integer to that component of all
codebook entries, and a part's distances to all entries are then gathers from
these tables by dictionary code, added up over the part's dimensions.

Blocks are spread over the tasks, codebooks (``parts * entries`` rows, a fixed
number) go to them as a constant, and what comes back of a round is one row of
sums and counts per part, entry and task, aggregated by Spark: no vector is
shuffled, and a vector that holds a third of all rows is only a frequent code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lotline.session import cut_lineage

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors of a block (their dictionary codes fit two bytes), and of a step of gathering (which stays in the processor's cache).
BLOCK, STEP = 4096, 256
#: Integers are held within this, so that no squared distance overflows.
LARGEST = 1 << 26
#: More distinct labels than this meet the vectors in a shuffle, not a broadcast.
BROADCAST_LABELS = 50_000


def usable(vector: Column) -> Column:
    """Vectors that are not null and hold no null, NaN or infinity."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``, held within ``LARGEST``."""
    return np.clip(np.floor(x.astype(np.float64) * scale), -LARGEST, LARGEST).astype(np.int64)


def cuts(dim: int, parts: int) -> list[tuple[int, int]]:
    """Bounds of ``parts`` consecutive parts, equal ones if ``dim`` allows (else the first are longer by one)."""
    size, more = divmod(dim, parts)
    ends = np.cumsum([size + (p < more) for p in range(parts)]).tolist()
    return list(zip([0, *ends], ends, strict=False))


@dataclass
class Codebooks:
    """``entries[p]`` (entries x width of part p): the integer components of a part's entries."""

    entries: list[np.ndarray]

    @property
    def dim(self) -> int:
        return sum(e.shape[1] for e in self.entries)

    @property
    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for part in self.entries for x in part.ravel()).encode()).hexdigest()


@dataclass
class Block:
    """Vectors by value dictionaries: of dimension j, ``values[j]`` (distinct integers) and ``codes[j]`` (one per vector)."""

    values: list[np.ndarray]
    codes: np.ndarray
    rows: int

    @classmethod
    def of(cls, x: np.ndarray) -> Block:
        pairs = [np.unique(x[:, j], return_inverse=True) for j in range(x.shape[1])]
        codes = np.array([c.reshape(-1) for _, c in pairs], np.uint16).reshape(x.shape[1], len(x))
        return cls([v for v, _ in pairs], codes, len(x))

    def nearest(self, entries: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
        """Index (the lower of equal ones) and squared distance of the nearest entry to the part that begins at ``begin``."""
        k, width = entries.shape
        index, error = np.zeros(self.rows, np.int64), np.zeros(self.rows, np.int64)
        if not width:
            return index, error
        far = max(int(max(abs(int(v[0])), abs(int(v[-1])))) for v in self.values[begin : begin + width]) + int(np.abs(entries).max())
        kind = np.int32 if far * far * width < 1 << 31 else np.int64
        tables = [((self.values[begin + j][:, None] - entries[None, :, j]) ** 2).astype(kind) for j in range(width)]
        total, part = np.empty((STEP, k), kind), np.empty((STEP, k), kind)
        for at in range(0, self.rows, STEP):
            n = min(STEP, self.rows - at)
            for j, table in enumerate(tables):
                # codes are inside the table, so clipping them changes nothing; it only spares a copy
                np.take(table, self.codes[begin + j, at : at + n], axis=0, out=(part if j else total)[:n], mode="clip")
                if j:
                    total[:n] += part[:n]
            index[at : at + n] = total[:n].argmin(axis=1)
            error[at : at + n] = total[np.arange(n), index[at : at + n]]
        return index, error

    def column(self, j: int) -> np.ndarray:
        return self.values[j][self.codes[j]]


def _pack(dim: int, scale: int):
    """(id, label, vector) -> blocks."""
    size = max(64, min(BLOCK, (1 << 20) // max(1, dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                held.append(batch.slice(at, size))
                rows += held[-1].num_rows
                if rows >= size:
                    yield _packed(held, dim, scale)
                    held, rows = [], 0
        if rows:
            yield _packed(held, dim, scale)

    return run


def _packed(batches: list[pa.RecordBatch], dim: int, scale: int) -> pa.RecordBatch:
    some = pa.Table.from_batches(batches).combine_chunks()
    n, lists = some.num_rows, lambda c: pa.ListArray.from_arrays([0, some.num_rows], pa.concat_arrays(some.column(c).chunks))
    flat = pa.concat_arrays(some.column(2).chunks).flatten().to_numpy(zero_copy_only=False)
    block = Block.of(integers(flat, scale).reshape(n, dim))
    return pa.RecordBatch.from_arrays([
        lists(0), lists(1), pa.array([block.codes.tobytes()], pa.binary()), pa.array([[len(v) for v in block.values]], pa.list_(pa.int32())),
        pa.array([np.concatenate([*block.values, np.zeros(0, np.int64)]).tobytes()], pa.binary())], names=["ids", "labels", "codes", "sizes", "dictionary"])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """The blocks of a task, each with its own one-row batch."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            rows = len(row.column("ids")[0])
            sizes = np.array(row.column("sizes")[0].as_py(), np.int64)
            values = np.split(np.frombuffer(row.column("dictionary")[0].as_py(), np.int64), np.cumsum(sizes)[:-1]) if dim else []
            yield row, Block(values, np.frombuffer(row.column("codes")[0].as_py(), np.uint16).reshape(dim, rows), rows)


def _moves(books: Codebooks):
    """Blocks -> per task, sums of the components of the parts next to each entry (keys from 0) and their numbers (keys from -1 down)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros(e.shape, np.int64) for e in books.entries], [np.zeros(len(e), np.int64) for e in books.entries]
        for _, block in _blocks(batches, books.dim):
            begin = 0
            for p, e in enumerate(books.entries):
                index, _ = block.nearest(e, begin)
                counts[p] += np.bincount(index, minlength=len(e))
                for j in range(e.shape[1]):  # a block's sums are far below 2^53, so they are exact as doubles
                    sums[p][:, j] += np.bincount(index, weights=block.column(begin + j), minlength=len(e)).astype(np.int64)
                begin += e.shape[1]
        total = np.concatenate([s.ravel() for s in sums])
        number = np.concatenate(counts)
        key = np.concatenate((np.arange(len(total)), -1 - np.arange(len(number))))
        value = np.concatenate((total, number))
        some = value != 0
        yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(value[some])], names=["key", "value"])

    return run


class Vectors:
    """The usable vectors of a table as blocks, and how they are cut."""

    def __init__(self, table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = SCALE, parts: int = PARTS):
        self.id_type, self.label_type = (table.schema[c].dataType.simpleString() for c in (id_col, label_col))
        self.scale, self.parts = scale, parts
        vector = F.col(f"`{vector_col}`").cast("array<double>")
        rows = table.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_label"), vector.alias("_vector")).filter(usable(F.col("_vector")))
        size = F.size("_vector")
        commonest = rows.groupBy(size.alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).limit(1).collect()
        self.dim = commonest[0]["n"] if commonest else 0
        self.rows, self.others = rows.filter(size == self.dim), rows.filter(size != self.dim)
        schema = f"ids array<{self.id_type}>, labels array<{self.label_type}>, codes binary, sizes array<int>, dictionary binary"
        self.blocks = cut_lineage(self.rows.mapInArrow(_pack(self.dim, scale), schema))

    def first(self, entries: int) -> Codebooks:
        """Codebooks of the vectors with the smallest identifiers (at most ``entries`` rows, a parameter)."""
        head = self.rows.orderBy(F.col("_id").asc_nulls_last(), "_vector").limit(entries).collect()
        x = integers(np.array([r["_vector"] for r in head], np.float64).reshape(len(head), self.dim), self.scale)
        return Codebooks([x[:, a:b].copy() for a, b in cuts(self.dim, self.parts)])

    def step(self, books: Codebooks) -> Codebooks:
        """Every entry becomes the floor of its parts' mean; unused ones stay."""
        found = self.blocks.mapInArrow(_moves(books), "key long, value long").groupBy("key").agg(F.sum("value").alias("value"))
        # one number per component and entry, however many vectors there are
        value = {r["key"]: r["value"] for r in found.collect()}
        entries, at, entry = [], 0, 0
        for e in books.entries:
            n = np.array([value.get(-1 - entry - i, 0) for i in range(len(e))], np.int64)
            sums = np.array([value.get(at + i, 0) for i in range(e.size)], np.int64).reshape(e.shape)
            entries.append(np.where(n[:, None] > 0, np.floor_divide(sums, np.maximum(n, 1)[:, None]), e))
            at, entry = at + e.size, entry + len(e)
        return Codebooks(entries)

    def train(self, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
        books = self.first(entries)
        for _ in range(rounds if len(books.entries[0]) else 0):
            books = self.step(books)
        return books

    def encode(self, books: Codebooks) -> DataFrame:
        """(id, label, code, error) of every usable vector."""
        digits = max(2, len(f"{max(0, len(books.entries[0]) - 1):x}"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row, block in _blocks(batches, books.dim):
                error, texts, begin = np.zeros(block.rows, np.int64), [], 0
                for e in books.entries:
                    index, far = block.nearest(e, begin)
                    names = np.array([f"{i:0{digits}x}" for i in range(len(e))])
                    texts.append(names[index].tolist())
                    error, begin = error + far, begin + e.shape[1]
                yield pa.RecordBatch.from_arrays([
                    row.column("ids").flatten(), row.column("labels").flatten(),
                    pa.array(["".join(x) for x in zip(*texts, strict=True)], pa.string()), pa.array(error)], names=["_id", "_label", "code", "error"])

        coded = self.blocks.mapInArrow(run, f"_id {self.id_type}, _label {self.label_type}, code string, error long")
        none = self.others.select("_id", "_label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return coded.unionByName(none)


def compress(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable vector: id, label, code, error, label_error, codebooks_sha256.

    Null vectors and those that hold a null, NaN or infinity are left out.
    The vectors' length is the commonest one (the longer of two); a vector of
    another length stays with a null code and error.  A length that ``parts``
    does not divide makes the first parts one longer; integers are held
    within 2^26.  The codebooks begin as the vectors with the smallest
    identifiers (null last, equal ones by vector); with fewer vectors than
    ``entries`` there are as many entries as vectors.  ``label_error`` adds up
    the errors of a label, null being one; repeated rows count each.  An empty
    table gives no rows; other columns are not read.
    """
    vectors = Vectors(table, id_col, vector_col, label_col, scale, parts)
    books = vectors.train(entries, rounds)
    coded = cut_lineage(vectors.encode(books))
    sums = cut_lineage(coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error")))
    few = sums.count() <= BROADCAST_LABELS
    out = coded.join(F.broadcast(sums) if few else sums, F.col("_label").eqNullSafe(F.col("_of")))
    return out.select(F.col("_id").alias(id_col), F.col("_label").alias(label_col), "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256"))
