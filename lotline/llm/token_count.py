"""Token counts of whole texts, huge ones by overlapping chunks that resynchronise.

A text of more than ``chunk`` characters is encoded in chunks that overlap, with
the offsets of their tokens.  Two chunks are spliced at a token that both have
at the same place.  That place is proven, not guessed: merging by score with
ties from the left gives a row of tokens exactly if every two neighbours, taken
alone, stay as they are (a merge across a border comes first in the whole text
only if it comes first in the two tokens beside it).  All neighbours in a
chunk's own encoding are such pairs, and after a shared token the pairs of the
one chunk go on as those of the other, so the spliced row is the encoding of
the joined text.  A token that begins before the chunk's own text (the word mark
that the library puts in front of a text) is never taken for a splice.

Where the overlap has no common token, it is doubled, and with it the chunk that
follows, so that a text that never aligns costs a constant times its encoding as
a whole and still gives the right count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lotline.llm.names import spare

#: Characters of a chunk and of the overlap first tried.
CHUNK, OVERLAP = 1 << 16, 256
#: Characters of short texts that are encoded in one call.
GROUP_CHARS = 1 << 21
LIMIT = 4096


class Counter:
    """Counts tokens with the model of a ``sentencepiece`` file (identity normaliser, merges by score)."""

    def __init__(self, model: bytes, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        if not 0 < overlap <= chunk:
            raise ValueError("the overlap is at least 1 and at most the chunk")
        self.model, self.chunk, self.overlap = sentencepiece.SentencePieceProcessor(model_proto=model), chunk, overlap
        self.widened = 0

    def spans(self, text: str, begin: int, end: int) -> np.ndarray:
        """(begin, end) of the tokens of a part of the text, as places in the whole text."""
        found = self.model.encode(text[begin:end], return_type="offset_mapping")["offsets"]
        return np.array(found, np.int64).reshape(-1, 2) + begin

    def splice(self, left: np.ndarray, right: np.ndarray, begin: int, end: int) -> tuple[int, int] | None:
        """Places in ``left`` and ``right`` behind a token of characters that both have in [begin, end), the middle one of all."""
        wide = np.int64(end) + 1
        # a token of bytes has no characters of its own but for its letter's last byte
        a = left[:, 0] * wide + left[:, 1]
        first = np.searchsorted(left[:, 0], begin, side="right")  # one that begins with the chunk may hold the word mark
        own = (right[:, 0] > begin) & (right[:, 1] <= end) & (right[:, 1] > right[:, 0])
        at = np.flatnonzero(own)
        common = at[np.isin(right[at, 0] * wide + right[at, 1], a[first:])]
        if not len(common):
            return None
        pick = common[len(common) // 2]
        mine = first + int(np.flatnonzero(a[first:] == right[pick, 0] * wide + right[pick, 1])[0])
        return mine + 1, int(pick) + 1

    def long(self, text: str) -> int:
        """Tokens of a text by spliced chunks."""
        end = min(len(text), self.chunk)
        tokens, overlap = self.spans(text, 0, end), self.overlap
        while end < len(text):
            begin = max(0, end - overlap)
            further = min(len(text), end + max(self.chunk, overlap))
            right = self.spans(text, begin, further)
            if begin == 0:  # the whole text so far, encoded at once
                tokens, end = right, further
                continue
            at = self.splice(tokens, right, begin, end)
            if at is None:
                overlap, self.widened = overlap * 2, self.widened + 1
                continue
            tokens = np.concatenate((tokens[: at[0]], right[at[1] :]))
            end, overlap = further, self.overlap
        return len(tokens)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        out, group, size = [0] * len(texts), [], 0
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = self.long(t)
                continue
            group.append(i)
            size += len(t)
            if size >= GROUP_CHARS:
                self._short(texts, group, out)
                group, size = [], 0
        self._short(texts, group, out)
        return out

    def _short(self, texts: list[str], group: list[int], out: list[int]) -> None:
        for i, ids in zip(group, self.model.encode([texts[i] for i in group], return_type="numpy", num_threads=1) if group else (), strict=True):
            out[i] = len(ids)


_COUNTERS: dict[tuple, Counter] = {}


def _counter(model: bytes, digest: str, chunk: int, overlap: int) -> Counter:
    """The model, read once per worker."""
    key = (digest, chunk, overlap)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(model, chunk, overlap)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, model: bytes, text_col: str = "text", keep: list[str] | None = None, limit: int = LIMIT,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Columns ``keep`` (all) of ``docs`` with n_bytes, n_tokens and over_limit.

    ``model`` is the content of a ``sentencepiece`` file (read on the driver,
    so executors need no such file).  Null and empty texts have no bytes and
    no tokens; texts of any length are counted whole, repeated rows each.
    ``over_limit``: more than ``limit`` tokens.  Columns of these names are
    replaced, others kept; an empty table gives no rows.  Texts are not
    shuffled.
    """
    made = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.octet_length(text).cast("long").alias("n_bytes"), text.alias(spare("_text", keep)))
    schema = T.StructType(rows.schema.fields[:-1]).add("n_tokens", "long")
    digest = hashlib.sha256(model).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model, digest, chunk, overlap)
        for b in batches:
            n = counter.count(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*keep, "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
