"""BPE encoding and decoding: speculate, verify, merge only what fails.

For every new word the greedy longest match over the vocabulary proposes
tokens.  A sequence of tokens is what merging by rank gives if each token is
what its own text merges to and every two neighbours are *compatible*: no
merge across their border would come before the merges inside them.  That is
tested for all adjacent pairs of a batch's new words at once, walking the
right edge of the left token against the left edge of the right one; only
words with a failing pair undergo exact merging.  All three steps are numpy
over the batch, a step of all words at a time.

A distinct word is encoded once; a worker's table of known words is emptied when
it takes ``KNOWN_BYTES``, and at the end of a task but for ``REST_BYTES`` at most,
which costs time but changes no result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from lotline.llm.memory import give_back
from lotline.llm.names import spare

#: Size of the table of known words within a task, and of one that is left to the worker's next task; a word takes
#: some ``WORD_BYTES`` beside its letters (three strings, a tuple and its place in the table).
KNOWN_BYTES, REST_BYTES, WORD_BYTES = 64 << 20, 24 << 20, 300
#: Words of more bytes (rare) are merged one by one, so that they don't pad the arrays.
LONG_WORD = 255
#: Characters of text whose new words are encoded together.
GROUP_CHARS = 1 << 20
NEVER = np.int64(1) << 40
# The word pattern of the vocabulary's own file, with its white space written out ...
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# ... and without the letters that are newer (Unicode 17) than the tables of the library to agree with.
_NEW = (
    "\\u0558\\u058b\\u058c\\u088f\\u0c5c\\u0cdc\\u208f\\u209d-\\u209f\\ua7ce\\ua7cf\\ua7d2\\ua7d4\\ua7dd-\\ua7e2\\ua7f1\\uab6c\\uab6d"
    "\\U000107bb-\\U000107bf\\U00010940-\\U00010959\\U00010ec5-\\U00010ec7\\U00010ed9-\\U00010eee\\U00011b0a\\U00011db0-\\U00011df1"
    "\\U00011de0-\\U00011de9\\U00016ea0-\\U00016eb8\\U00016ebb-\\U00016ed3\\U00016ff2-\\U00016ff6\\U000187f8-\\U000187ff"
    "\\U00018cd6-\\U00018cda\\U00018d09-\\U00018d20\\U00018d80-\\U00018df2\\U00018e00-\\U00019191\\U000191a0-\\U000191d2"
    "\\U0001e6c0-\\U0001e6ff\\U0002b73a-\\U0002b73f\\U0002b81e\\U0002cea2-\\U0002cead\\U000323b0-\\U00033479"
)
_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_NEW}]]+|[\p{{N}}--[{_NEW}]]|[[^{_SPACE}\p{{L}}\p{{N}}][{_NEW}]]+"


def _narrow_words() -> re.Pattern:
    """The same pattern for texts up to U+FFFF, its classes written out as ranges (which ``re`` reads faster)."""
    kinds = {"L": "", "N": "", "S": ""}
    tests = {"L": rf"[\p{{L}}--[{_NEW}]]", "N": rf"[\p{{N}}--[{_NEW}]]", "S": f"[{_SPACE}]"}
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    for kind, test in tests.items():
        for m in regex.compile(test + "+", regex.V1).finditer(every):
            # a run of the string is a run of code points but for the surrogates, which no text has
            kinds[kind] += f"{re.escape(m[0][0])}-{re.escape(m[0][-1])}"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^{kinds['S']}{kinds['L']}{kinds['N']}]+")




def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Bpe:
    """Vocabulary with word ends, from the JSON text of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab: dict[str, int] = model["vocab"]
        self.size = size = max([*vocab.values(), *special.values()]) + 1
        self.token = [""] * size
        for t, i in itertools.chain(vocab.items(), special.items()):
            self.token[i] = t
        self.number = [str(i) for i in range(size)]
        self.left, self.right, self.rank = np.full(size, -1), np.full(size, -1), np.full(size, NEVER)
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.pair[i, j] = (r, k)
            if self.rank[k] == NEVER:
                self.left[k], self.right[k], self.rank[k] = i, j, r
        self.rank[self.left < 0] = -1  # letters are there from the start
        keys = np.array([i * size + j for i, j in self.pair] or [-1], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks, self.made = np.array([*self.pair.values()] or [(NEVER, -1)], np.int64)[order].T
        letters = byte_letters()
        self.letter = np.array([vocab[c] for c in letters])
        self.last_letter = np.array([vocab[c + suffix] for c in letters])
        # trie of the tokens that their own text merges to; others cannot be proposed
        ordered = all(r > self.rank[i] and r > self.rank[j] for (i, j), (r, _) in self.pair.items())
        of_letter, nodes, ends = {c: b for b, c in enumerate(letters)}, {}, {}
        for t, i in vocab.items() if ordered else ():
            end = bool(suffix) and t.endswith(suffix) and len(t) > len(suffix)
            text = bytes(of_letter[c] for c in (t[: -len(suffix)] if end else t))
            if self.merge(text, end or not suffix) == [i]:
                node = 0
                for b in text:
                    node = nodes.setdefault(node * 256 + b, len(nodes) + 1)
                ends[node, 1 if end else 0] = i
        edges = np.array([*nodes.items()] or [(-1, 0)], np.int64)
        self.edges, self.nodes = edges[np.argsort(edges[:, 0])].T
        self.ends = np.full((len(nodes) + 1, 2), -1)
        for (node, last), i in ends.items():
            self.ends[node, last] = i
        if not suffix:
            self.ends[:, 1] = self.ends[:, 0]
        self.word, self.narrow_word = regex.compile(_WORD, regex.V1), _narrow_words()
        # special tokens are cut from the raw text
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.special = {t: (1, self.number[i], t) for t, i in special.items()}
        self.known: dict[str, tuple[int, str, str]] = {}
        self.held = 0  # bytes of ``known``, about

    # ------------------------------------------------------------ exact merging
    def lookup(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging x with y (NEVER where there is no such merge or an id is negative)."""
        key = np.where((x >= 0) & (y >= 0), x * self.size + y, -2)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER), self.made[at]

    def merge(self, word: bytes, end: bool = True) -> list[int]:
        """One word merged exactly: lowest rank first, the leftmost of equal ones."""
        ids = [int(self.letter[b]) for b in word]
        if end and ids:
            ids[-1] = int(self.last_letter[word[-1]])
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p[0], i, ids[i], ids[i + 1], p[1]) for i in range(n - 1) if (p := self.pair.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one side has been merged meanwhile
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (p := self.pair.get((ids[x], ids[after[x]]))):
                    heapq.heappush(heap, (p[0], x, ids[x], ids[after[x]], p[1]))
        return [i for i in ids if i >= 0]

    def merge_all(self, text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words (bytes ``begin`` to ``begin + size`` of ``text``) merged exactly: ids by word, and their number."""
        order = np.argsort(size, kind="stable")
        ids_of, count = np.full((len(size), int(size.max(initial=0))), -1), np.zeros(len(size), np.int64)
        for part in np.array_split(order, max(1, len(order) // 8192)):
            if not len(part):
                continue
            n, width = size[part], int(size[part].max())
            at = np.arange(width)
            source = np.minimum(begin[part][:, None] + at, len(text) - 1)
            ids = np.where(at < n[:, None], self.letter[text[source]], -1)
            rows = np.arange(len(part))
            ids[rows, n - 1] = self.last_letter[text[begin[part] + n - 1]]
            ids = np.concatenate((ids, np.full((len(part), 1), -1)), axis=1)
            rank, made = self.lookup(ids[:, :-1], ids[:, 1:])
            live = rows
            while len(live):
                i = rank[live].argmin(axis=1)  # the first of equal ones
                go = rank[live, i] < NEVER
                live, i = live[go], i[go]
                # i and its neighbour become one, what follows moves up
                move = np.minimum(at + (at > i[:, None]), width)
                new = made[live, i]
                ids[live, :width] = np.take_along_axis(ids[live], move, 1)
                ids[live, i] = new
                near = np.minimum(at + (at >= i[:, None]), width - 1)
                rank[live], made[live] = np.take_along_axis(rank[live], near, 1), np.take_along_axis(made[live], near, 1)
                rank[live, i], made[live, i] = self.lookup(new, ids[live, i + 1])
                rank[live, -1] = np.where(ids[live, -2] < 0, NEVER, rank[live, -1])
                back = i > 0
                b, k = live[back], i[back] - 1
                rank[b, k], made[b, k] = self.lookup(ids[b, k], new[back])
            ids_of[part, :width], count[part] = ids[:, :width], (ids[:, :width] >= 0).sum(axis=1)
        return ids_of, count

    # ------------------------------------------------------ proposing, verifying
    def propose(self, text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match of all words: tokens, the word of each, and which words have none somewhere."""
        stop, failed = begin + size, np.zeros(len(size), bool)
        word, at = np.arange(len(size)), begin.copy()  # of those not at their end
        k, node, best, best_to = at.copy(), np.zeros(len(at), np.int64), np.full(len(at), -1), at.copy()
        tokens, owners = [], []
        while len(word):
            more = k < stop[word]
            key = node * 256 + text[np.minimum(k, len(text) - 1)]
            e = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            more &= self.edges[e] == key
            node, k = np.where(more, self.nodes[e], 0), k + more
            found = np.where(more, self.ends[node, (k == stop[word]).astype(int)], -1)
            best, best_to = np.where(found >= 0, found, best), np.where(found >= 0, k, best_to)
            cut = ~more
            if cut.any():
                failed[word[cut & (best < 0)]] = True
                take = cut & (best >= 0)
                tokens.append(best[take])
                owners.append(word[take])
                k, node = np.where(cut, best_to, k), np.where(cut, 0, node)
                done = cut & ((best < 0) | (best_to == stop[word]))
                best = np.where(cut, -1, best)
                word, k, node, best, best_to = (x[~done] for x in (word, k, node, best, best_to))
        owner = np.concatenate([*owners, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([*tokens, np.zeros(0, np.int64)])[order], owner[order], failed

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For token pairs (a, b): True if both stay as they are when their texts are merged as one."""
        bad, x, taken_x = np.zeros(len(a), bool), a, np.full(len(a), NEVER)
        while (x >= 0).any():
            y, taken_y = b, np.full(len(b), NEVER)
            while (y >= 0).any():
                r, _ = self.lookup(x, y)
                # x is merged into its own token at taken_x, from the left; y at taken_y, to the right, so a tie there comes later
                bad |= (r < taken_x) & (r <= taken_y) & (r < NEVER)
                taken_y, y = np.where(y >= 0, self.rank[y], NEVER), np.where(y >= 0, self.left[y], -1)
            taken_x, x = np.where(x >= 0, self.rank[x], NEVER), np.where(x >= 0, self.right[x], -1)
        return ~bad

    def learn(self, words: list[str]) -> None:
        """Adds new words to the known ones."""
        raw = [w.encode() for w in words]
        text, size = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64), np.fromiter(map(len, raw), np.int64, len(raw))
        begin = np.cumsum(size) - size
        short = np.flatnonzero(size <= LONG_WORD)
        flat, owner, failed = self.propose(text, begin[short], size[short])
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, at = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        failed[owner[inside[~self.compatible(pairs // self.size, pairs % self.size)[at]]]] = True
        exact = np.flatnonzero(failed)
        ids, count = self.merge_all(text, begin[short][exact], size[short][exact])
        where = np.concatenate((np.searchsorted(owner, np.arange(len(short))), [len(owner)])).tolist()
        known, number, token = self.known, self.number, self.token
        flat, row = flat.tolist(), dict(zip(exact.tolist(), range(len(exact)), strict=True))
        for i, w in enumerate(short.tolist()):
            got = flat[where[i] : where[i + 1]] if (r := row.get(i)) is None else ids[r, : count[r]].tolist()
            known[words[w]] = (len(got), " ".join([number[t] for t in got]), " ".join([token[t] for t in got]))
        # a token of n bytes is written in at most n letters and six digits, each with a blank
        self.held += len(words) * WORD_BYTES + 4 * len(text)
        for w in np.flatnonzero(size > LONG_WORD).tolist():
            got = self.merge(raw[w])
            known[words[w]] = (len(got), " ".join([number[t] for t in got]), self.decode(got))

    # ------------------------------------------------------------------- texts
    def words(self, text: str) -> list[str]:
        """Words of a text, and its special tokens."""
        if self.cut and "<" in text and len(parts := self.cut.split(text)) > 1:
            return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self.words(p))]
        if not text.isascii():  # lower case letter by letter: a final sigma is a sigma like any other
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        wide = not text.isascii() and len(text.encode("utf-16-le")) > 2 * len(text)
        return (self.word if wide else self.narrow_word).findall(text)

    def forget(self, above: int) -> None:
        """Empties the table of known words if it is larger than that."""
        if self.held > above:
            self.known, self.held = {}, 0

    def encode(self, texts: list[str]) -> list[list[tuple[int, str, str]]]:
        """Of each text's words: number of ids, the ids as text, and decoded."""
        self.forget(KNOWN_BYTES)
        self.known.update(self.special)
        cut = [self.words(t) for t in texts]
        if new := set().union(*cut).difference(self.known):
            self.learn(list(new))
        return [[*map(self.known.__getitem__, words)] for words in cut]

    def decode(self, ids) -> str:
        """The file names no decoder: tokens joined by a space, special ones included."""
        return " ".join([self.token[i] for i in ids])


def id_array(words: list[tuple[int, str, str]]) -> np.ndarray:
    """The ids of a text's words."""
    return np.array(" ".join([w[1] for w in words if w[0]]).split(), np.int32)


_MODELS: dict[str, Bpe] = {}


def _model(text: str, digest: str) -> Bpe:
    """The vocabulary, built once per worker."""
    if digest not in _MODELS:
        _MODELS.clear()
        _MODELS[digest] = Bpe(text)
    return _MODELS[digest]


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", keep: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """Columns ``keep`` (all) of ``docs`` with ids, n_tokens, ids_sha256 and decoded_sha256.

    ``vocabulary`` is the JSON text of a tokenizer file (read on the driver,
    so executors need no such file).  A null text counts as empty: no tokens.
    ``ids_sha256`` is of the decimal ids joined by a space, ``decoded_sha256``
    of the text that decoding them gives.  Columns of these names are
    replaced; an empty table gives no rows.
    """
    made = (["ids"] if with_ids else []) + ["n_tokens", "ids_sha256", "decoded_sha256"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(spare("_text", keep)))
    schema = T.StructType(rows.schema.fields[:-1])
    for c in made:
        schema = schema.add(c, T.ArrayType(T.IntegerType()) if c == "ids" else "long" if c == "n_tokens" else "string")
    digest = hashlib.sha256(vocabulary.encode()).hexdigest()
    sha = lambda words, k: hashlib.sha256(" ".join([w[k] for w in words]).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(vocabulary, digest)
        for whole in batches:
            text = whole.column(whole.num_columns - 1)
            group = np.cumsum(pc.fill_null(pc.utf8_length(text), 0).to_numpy(zero_copy_only=False)) // GROUP_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(text)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if x == y:
                    continue
                coded = bpe.encode([t or "" for t in text.slice(x, y - x).to_pylist()])
                arrays = [
                    pa.array([sum([w[0] for w in words]) for words in coded], pa.int64()),
                    pa.array([sha(words, 1) for words in coded], pa.string()),
                    pa.array([sha(words, 2) for words in coded], pa.string())]
                if with_ids:
                    arrays.insert(0, pa.array([id_array(words) for words in coded], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([*(c.slice(x, y - x) for c in whole.columns[:-1]), *arrays], names=[*keep, *made])
        bpe.forget(REST_BYTES)
        give_back()

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded`` (string): the text of the ids (null or no ids: empty)."""
    kept = [c for c in tokens.columns if c != "decoded"]
    rows = tokens.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids_col}`").alias(spare("_ids", kept)))
    schema = T.StructType(rows.schema.fields[:-1]).add("decoded", "string")
    digest = hashlib.sha256(vocabulary.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(vocabulary, digest)
        for b in batches:
            said = [bpe.decode(x or ()) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(said, pa.string())], names=[*kept, "decoded"])

    return rows.mapInArrow(run, schema)
