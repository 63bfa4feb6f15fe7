"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's subwords are its letter pairs, triples and quadruples (lower case,
with the word's edges).  Their hashes count into buckets; each bucket has an
embedding, a text is the average of its subwords' embeddings, and a linear
softmax turns the average into languages.

Training is stochastic gradient descent in numpy on the driver, over a sample
of about ``max_rows`` different labelled texts (evenly many per language, one
expected at least, drawn by a hash of identifier and text), which is written
once; only bucket counts of the sample reach the driver, ``buckets`` numbers a
text at most, however long it is.  A fifth of the sample is kept from training
to calibrate: one temperature, by which the score becomes the probability that
the prediction is right, and the limits of rejection, on the score and on the
share of subwords that the training met.  Which subwords those are is gathered on
the executors as one set of bits, the known shares are counted there.
Scoring a text adds up one precomputed row of logits per subword and reads the
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lotline.llm.memory import give_back
from lotline.llm.names import spare
from lotline.session import cut_lineage

BUCKETS, DIM, EPOCHS = 4096, 16, 8
#: Cells in which the model notes the subwords of four that it has met (128 KB).
CELLS = 1 << 20
#: Labelled texts used in training and calibration.
MAX_ROWS = 4_000
#: Share of the calibration texts that the limits of rejection disregard as outliers, and the different
#: subwords of four that a text needs to count among them.
OUTLIERS, ENOUGH = 0.02, 16
#: Characters looked at at a time, so that a very long text needs no more memory.
CHARS = 1 << 20
UNKNOWN = "und"
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)
_TABLE: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Lower-case code points of letters, 0 for everything else."""
    if not _TABLE:  # planes 0 to 3 hold all letters; built once per worker
        low = (c if len(c := chr(i).lower()) == 1 else chr(i) for i in range(0x40000) if not 0xD800 <= i < 0xE000)
        ids = [i for i in range(0x40000) if not 0xD800 <= i < 0xE000]
        table = np.zeros(0x110000, np.uint32)
        table[ids] = [ord(c) if c.isalpha() else 0 for c in low]
        _TABLE.append(table)
    return _TABLE[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def subwords(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(length, hashes) of the subwords of a whole text, by parts: two to four places of the text with edges, letters inside."""
    for at in range(0, len(text) + 1, CHARS):  # subwords that begin at one of these places
        m = min(CHARS, len(text) + 1 - at)
        c = letters(text[max(0, at - 1) : at + m + 2])
        c = np.concatenate((np.zeros(int(at == 0), np.uint32), c, np.zeros(3, np.uint32)))[: m + 3]
        h, inner = c[:m] * np.uint32(_MULTIPLIERS[0]), c[1 : m + 1] != 0
        for n in (2, 3, 4):
            h = (h ^ (h >> np.uint32(15))) * np.uint32(_MULTIPLIERS[1]) + c[n - 1 : n - 1 + m] * np.uint32(_MULTIPLIERS[n - 1])
            if n == 4:
                inner = inner & (c[2 : m + 2] != 0)
            yield n, ((h ^ (h >> np.uint32(13))) * np.uint32(_MULTIPLIERS[0]))[inner]


def counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Subword counts of a whole text by bucket."""
    total, shift = np.zeros(buckets, np.int64), np.uint32(33 - int(buckets).bit_length())
    for _, h in subwords(text):
        total += np.bincount(h >> shift, minlength=buckets)
    return total


def quads(text: str) -> np.ndarray:
    """Cells (of ``CELLS``) of a text's subwords of four."""
    return np.concatenate([h >> np.uint32(33 - CELLS.bit_length()) for n, h in subwords(text) if n == 4])


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # bucket x language: embedding times softmax weights
    temperature: float = 1.0
    seen: np.ndarray | None = None  # packed bits: cells of the subwords of four met in training
    min_score: float = 0.0
    min_known: float = 0.0

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, its calibrated probability, and the share of the text's subwords of four that the training met."""
        if not text or not self.languages:
            return UNKNOWN, 0.0, 0.0
        buckets, known, of = len(self.logits), 0, 0
        total, shift = np.zeros(buckets, np.int64), np.uint32(33 - buckets.bit_length())
        for n, h in subwords(text):
            total += np.bincount(h >> shift, minlength=buckets)
            if n == 4 and self.seen is not None:
                cell = h >> np.uint32(33 - CELLS.bit_length())
                known += int((self.seen[cell >> np.uint32(3)] >> (7 - (cell & np.uint32(7))).astype(np.uint8) & 1).sum())
                of += len(cell)
        if not total.any() and not letters(text).any():
            return UNKNOWN, 0.0, 0.0
        p = softmax((total @ self.logits / max(1, total.sum()) / self.temperature)[None])[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), known / of if of else 1.0

    def calibrate_rejection(self, shares: list[np.ndarray], cells: list[np.ndarray], train: np.ndarray, held: np.ndarray) -> None:
        """Limits with half the room that the calibration texts leave at their ``OUTLIERS`` point, so that natural text stays.

        The score's limit is midway from chance (one in the number of languages)
        to that point, the known share's is half of it.  Texts of fewer than
        ``ENOUGH`` subwords count only if there are no others.
        """
        seen = np.zeros(CELLS, bool)
        for i in train:
            seen[cells[i]] = True
        self.seen = np.packbits(seen)
        held = [i for i in held if len(cells[i])]
        p = softmax(np.array([shares[i] @ self.logits for i in held]) / self.temperature).max(axis=1) if held else np.zeros(0)
        self.set_limits(p, np.array([seen[cells[i]].mean() for i in held]), np.array([len(cells[i]) for i in held]))

    def set_limits(self, p: np.ndarray, known: np.ndarray, size: np.ndarray) -> None:
        """Limits of rejection from calibration texts: top probability, known share, and different subwords of four."""
        some = size > 0
        some &= size >= ENOUGH if (size >= ENOUGH).any() else True
        if some.any():
            # of two texts or more, the lowest one alone never decides
            low = lambda x: float(np.quantile(x, OUTLIERS, method="higher"))
            self.min_score = (low(p[some]) + 1 / len(self.languages)) / 2
            self.min_known = low(known[some]) / 2


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], calibrate: np.ndarray, dim: int = DIM, epochs: int = EPOCHS,
        rate: float = 8.0, batch: int = 32, seed: int = 7) -> Model:
    """SGD over rows of bucket shares ``x`` with labels ``y``; rows marked ``calibrate`` set the temperature."""
    rng, k = np.random.default_rng(seed), len(languages)
    embed = rng.normal(0, 1 / dim, (x.shape[1], dim)).astype(np.float32)
    weight = rng.normal(0, 1 / dim, (dim, k)).astype(np.float32)
    train = np.flatnonzero(~calibrate) if (~calibrate).any() else np.arange(len(x))
    steps, done = max(1, epochs * -(-len(train) // batch)), 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(train), max(1, -(-len(train) // batch))):
            lr, done = rate * (1 - done / steps), done + 1
            hidden = x[rows] @ embed
            error = softmax(hidden @ weight)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            # a bucket has some thousandth of a text's subwords, so its embedding takes larger steps
            embed -= np.float32(lr * 100) * (x[rows].T @ (error @ weight.T))
            weight -= np.float32(lr) * (hidden.T @ error)
    model = Model(languages, (embed @ weight).astype(np.float64))
    held = np.flatnonzero(calibrate)
    if len(held) and k > 1:
        raw = x[held] @ model.logits
        loss = [(-np.log(softmax(raw / t)[np.arange(len(held)), y[held]] + 1e-12).mean(), t) for t in np.geomspace(0.25, 16, 49)]
        model.temperature = float(min(loss)[1])
    return model


def _sample(labelled: DataFrame, max_rows: int, seed: int) -> DataFrame | None:
    """(_lang, _text, _draw): about ``max_rows`` different labelled texts, about as many of each language; None without any."""
    found = cut_lineage(labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")))
    languages = found.count()
    if not languages:
        return None
    each = max(1, max_rows // languages)
    # the upper 31 bits of the draw are below the language's share for about `each` of its rows; copies draw the same
    draw, share = F.xxhash64("_id", "_text", F.lit(seed)), F.lit(each) / F.col("_n") * F.lit(1 << 31)
    drawn = labelled.withColumn("_draw", draw).join(F.broadcast(found) if languages <= max_rows else found, "_lang").filter(F.shiftrightunsigned("_draw", 33) <= share)
    return cut_lineage(drawn.select("_lang", "_text", "_draw").dropDuplicates(["_lang", "_draw"]))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS,
          buckets: int = BUCKETS, seed: int = 7) -> Model:
    """Model from rows with a non-null language and a text; no such rows, or none with a letter: a model that knows none.

    Equal rows are one text of the sample.  Other columns are not read.
    """
    labelled = labelled.select(F.col(f"`{id_col}`").cast("string").alias("_id"), F.col(f"`{lang_col}`").cast("string").alias("_lang"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    sample = _sample(labelled.filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull()), max_rows, seed)
    nothing = Model([], np.zeros((buckets, 0)))
    if sample is None:
        return nothing

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [counts(t.as_py(), buckets) for t in b.column(1)]
            at = [np.flatnonzero(r) for r in rows]
            packed = [i.astype(np.uint32).tobytes() for i in at], [r[i].tobytes() for r, i in zip(rows, at, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array(p, pa.binary()) for p in packed)], names=["_lang", "_draw", "_at", "_n"])

    got = sample.mapInArrow(featurise, "_lang string, _draw long, _at binary, _n binary").filter(F.octet_length("_at") > 0)
    got = sorted((r["_lang"], r["_draw"], bytes(r["_at"]), bytes(r["_n"])) for r in got.collect())
    if not got:
        return nothing
    languages = sorted({r[0] for r in got})
    of = {lang: i for i, lang in enumerate(languages)}
    x, y = np.zeros((len(got), buckets), np.float32), np.array([of[r[0]] for r in got])
    for i, (_, _, at, n) in enumerate(got):
        n = np.frombuffer(n, np.int64)
        x[i, np.frombuffer(at, np.uint32)] = n / n.sum()
    calibrate = np.arange(len(got)) % 5 == 4
    model = fit(x, y, languages, calibrate, seed=seed)
    held = {got[i][:2]: i for i in np.flatnonzero(calibrate).tolist()}

    def rows_of(batch: pa.RecordBatch, want: bool) -> Iterator[tuple[str, int, str]]:
        for lang, text, draw in zip(*batch.columns, strict=True):
            if ((lang.as_py(), draw.as_py()) in held) == want:
                yield lang.as_py(), draw.as_py(), text.as_py()

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(CELLS, bool)  # subwords of four of a task's texts, handed on as 64-bit words
        for b in batches:
            for _, _, t in rows_of(b, False):
                bits[quads(t)] = True
        words = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(words[at])], names=["at", "bits"])

    seen = np.zeros(CELLS // 64, np.int64)
    bits = sample.mapInArrow(met, "at int, bits long")
    for r in bits.groupBy("at").agg(F.bit_or("bits").alias("bits")).collect():  # at most CELLS / 64 numbers
        seen[r["at"]] = r["bits"]
    model.seen = seen.view(np.uint8)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(model.seen).astype(bool)
        for b in batches:
            for lang, draw, t in rows_of(b, True):
                cells = np.unique(quads(t))
                share = float(seen[cells].mean()) if len(cells) else 0.0
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (lang, draw, len(cells), share)], names=["_lang", "_draw", "size", "known"])

    shares = sample.mapInArrow(known, "_lang string, _draw long, size long, known double").collect()
    if shares:
        p = softmax(x[[held[r["_lang"], r["_draw"]] for r in shares]] @ model.logits / model.temperature).max(axis=1)
        model.set_limits(p, np.array([r["known"] for r in shares]), np.array([r["size"] for r in shares]))
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", min_score: float | None = None, min_known: float | None = None) -> DataFrame:
    """``docs`` (all columns) with lang_pred, score and rejected.

    ``lang_pred`` is a language of the model; ``und`` with score 0 if the
    text is null, empty or has no letter, or the model knows no language.
    ``score`` is the calibrated probability of the prediction.  ``rejected``:
    ``und``, a score under ``min_score``, or fewer than ``min_known`` of the
    text's subwords met in training (text of another language); both limits
    are the model's calibrated ones unless given.  Columns of these names
    are replaced, others kept; very long texts are read whole, by parts.  An
    empty table gives no rows.
    """
    min_score = model.min_score if min_score is None else min_score
    min_known = model.min_known if min_known is None else min_known
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(spare("_text", kept)))
    schema = T.StructType(rows.schema.fields[:-1]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = [model.predict(t.as_py()) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([x for x, _, _ in said], pa.string()), pa.array([s for _, s, _ in said], pa.float64()),
                 pa.array([x == UNKNOWN or s < min_score or known < min_known for x, s, known in said], pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"])
        give_back()

    return rows.mapInArrow(predict, schema)


def drop_unidentified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns, of any name) without the rows whose language is rejected (see ``identify``)."""
    places = [f"c{i}" for i in range(len(docs.columns))]
    said = identify(docs.toDF(*places), model, places[docs.columns.index(text_col)])
    return said.filter("not rejected").select(*places).toDF(*docs.columns)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the identifier's text is divisible by 5 (a null identifier is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
