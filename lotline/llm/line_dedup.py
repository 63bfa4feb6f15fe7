"""Line dedup: deletion-neighbourhood join on words (DataFrame functions only).

Two lines match when they are equal up to white space, or when one word
changed, added or removed turns one into the other and the longer one has
``min_words`` words at least (one in five: a similarity of 0.8).  A line is
dropped when any earlier line matches it; position is (identifier, line).

1. Every line gets a 128-bit hash; equal lines are aggregated before they are
   shuffled, so a line that stands in a third of all documents is one row.
2. Lines one word apart share their first or their last half, cut at a place
   that depends on the longer one's length only.  Lines that share no half with
   another line leave here; no match is lost, and few lines remain.
3. The others emit their deletion neighbourhood as hashed keys: for each
   position in the half that may differ, the line without that word (for
   changed words: together with the position; for removed words: to meet the
   shorter line itself).  A line's hash is an exclusive-or of (word, position)
   hashes, so all variants come from two running hashes, in time linear in
   the line.
4. Lines with equal keys meet.  Each key's earliest line is aggregated first
   and joined back, never all pairs, and each meeting is verified on the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lotline.llm.mixing import WHITE_SPACE
from lotline.session import cut_lineage

MIN_WORDS = 5
#: Running hashes are made in blocks of so many words.
BLOCK = 256


def _words(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(WHITE_SPACE)), "[ \\t\\n\\x0B\\f\\r]+")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_pos, _text) of every line with a word; ``_pos`` orders lines (null identifiers last)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_tie"), F.posexplode(F.split(text, "\n", -1)).alias("_line", "_text"))
    rows = rows.filter(F.btrim("_text", F.lit(WHITE_SPACE)) != "")
    pos = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_tie").alias("tie"), F.col("_line").alias("line"))
    return rows.select(pos.alias("_pos"), "_text")


def _halves(words: Column, n: Column) -> dict[str, Column]:
    """Hashes of the first and last half, as the longer line of a pair (0) and as the one shorter by a word (1)."""
    out = {}
    for k in (0, 1):
        longer = n + k
        half = F.floor(longer / 2).cast("int")
        rest = (longer - half).cast("int")
        out[f"_first{k}"] = F.xxhash64(longer, F.lit("first"), F.slice(words, F.lit(1), half))
        out[f"_last{k}"] = F.xxhash64(longer, F.lit("last"), F.slice(words, n - rest + 1, rest))
    return out


def _xor(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def _running_xor(values: Column) -> Column:
    """Exclusive-or of all elements before each element, and of all at the end."""
    begin = F.array(F.lit(0).cast("long"))
    return F.aggregate(values, begin, lambda got, x: F.concat(got, F.array(F.element_at(got, -1).bitwiseXOR(x))))


def _with_running_xor(rows: DataFrame, values: str, name: str) -> DataFrame:
    """Adds ``name``: the exclusive-or of all elements before each one, block by block (a copy of a block per element)."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")), lambda b: _running_xor(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
    rows = rows.withColumn("_blocks", blocks)
    before = F.slice(_running_xor(F.transform("_blocks", lambda b: F.element_at(b, -1))), F.lit(1), F.size("_blocks"))
    # zipped, so that what comes before a block is worked out once, not for each element
    moved = F.zip_with("_blocks", before, lambda b, x: F.transform(F.slice(b, F.lit(1), F.lit(BLOCK)), lambda y: y.bitwiseXOR(x)))
    return rows.withColumn(name, F.slice(F.flatten(moved), F.lit(1), F.size(values))).drop("_blocks")


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (_h1, _h2, _first, _key, _own, _at) of the deletion neighbourhoods of ``lines``."""
    n = F.col("_n")
    here = F.transform("_words", lambda w, i: F.xxhash64(w, i))
    left = F.transform("_words", lambda w, i: F.xxhash64(w, i - 1))  # as if a word before it were gone
    hits = [f"_hit{k}" for k in ("_first0", "_last0", "_first1", "_last1")]
    rows = lines.select("_h1", "_h2", "_first", "_n", *hits, here.alias("_here"), left.alias("_left"))
    rows = rows.withColumns({"_all": _xor(F.col("_here")), "_all_left": _xor(F.col("_left")), "_both": F.zip_with("_here", "_left", lambda a, b: a.bitwiseXOR(b))})
    rows = cut_lineage(_with_running_xor(rows, "_both", "_change").drop("_both"))
    # with the first half shared, the change lies in the last, and the other way round
    at = rows.select("_h1", "_h2", "_first", "_n", "_hit_first0", "_hit_last0", "_all", "_all_left", F.posexplode(F.arrays_zip("_here", "_left", "_change")).alias("_at", "_w"))
    half = F.floor(n / 2)
    at = at.filter(((F.col("_at") >= half) & F.col("_hit_first0")) | ((F.col("_at") < half) & F.col("_hit_last0")))
    changed = F.xxhash64(F.lit("changed"), n, F.col("_at"), F.col("_all").bitwiseXOR(F.col("_w._here")))
    removed = F.xxhash64(F.lit("removed"), n - 1, F.col("_all_left").bitwiseXOR(F.col("_w._change")).bitwiseXOR(F.col("_w._left")))
    at = at.select("_h1", "_h2", "_first", F.explode(F.array(changed, removed)).alias("_key"), F.lit(False).alias("_own"), "_at")
    itself = rows.filter(F.col("_hit_first1") | F.col("_hit_last1")).select(
        "_h1", "_h2", "_first", F.xxhash64(F.lit("removed"), n, F.col("_all")).alias("_key"), F.lit(True).alias("_own"), F.lit(-1).alias("_at"))
    return at.unionByName(itself)


def _near(lines: DataFrame) -> DataFrame:
    """(_h1, _h2, _earlier): the earliest line one word apart from each of ``lines``, if earlier than itself."""
    variants = cut_lineage(_variants(lines))
    of = F.struct("_first", "_h1", "_h2", "_at")
    # for changed words every member meets the earliest; for removed words longer and shorter lines meet each other
    met = variants.groupBy("_key").agg(
        F.min(F.when(~F.col("_own"), of)).alias("_cut"), F.min(F.when(F.col("_own"), of)).alias("_whole"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    pairs = variants.join(met, "_key")
    other = F.when(F.col("_own"), F.col("_cut")).when(F.col("_whole").isNotNull(), F.col("_whole")).otherwise(F.col("_cut"))
    pairs = pairs.withColumn("_other", other).filter(F.col("_other._first") < F.col("_first"))
    pairs = pairs.select("_h1", "_h2", "_at", F.col("_other._at").alias("_other_at"), F.col("_other._h1").alias("_o1"), F.col("_other._h2").alias("_o2"), F.col("_other._first").alias("_earlier")).distinct()
    text = lines.select("_h1", "_h2", "_words")
    pairs = pairs.join(text, ["_h1", "_h2"]).join(text.toDF("_o1", "_o2", "_other_words"), ["_o1", "_o2"])

    def without(words: str, at: str) -> Column:  # -1: the whole line
        w, i = F.col(words), F.col(at)
        return F.when(i < 0, w).otherwise(F.concat(F.slice(w, F.lit(1), i), F.slice(w, i + 2, F.size(w))))

    same = without("_words", "_at") == without("_other_words", "_other_at")
    one_place = (F.col("_at") == F.col("_other_at")) | (F.col("_at") < 0) | (F.col("_other_at") < 0)
    return pairs.filter(same & one_place).groupBy("_h1", "_h2").agg(F.min("_earlier").alias("_earlier"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per dropped line: id, _tie, line, keep_id, keep_line, near.

    ``line`` counts from 0; ``keep_id`` and ``keep_line`` are the earliest
    line that matches; ``near``: one word apart.  Lines without words are
    never dropped.  Identifiers order documents, null last; texts under one
    identifier are told apart by ``_tie``, a hash of the text, and rows that
    repeat both count as one document.  An empty table gives no rows.
    """
    words, n = F.col("_words"), F.size("_words")
    halves = {k: F.when(n >= (min_words if k.endswith("0") else min_words - 1), c) for k, c in _halves(words, n).items()}
    found = _lines(docs, id_col, text_col).select("_pos", _words(F.col("_text")).alias("_words")).withColumns({"_h1": F.xxhash64(words), "_h2": F.xxhash64(F.lit("second"), words), "_n": n, **halves})
    found = cut_lineage(found.drop("_words"))
    lines = found.groupBy("_h1", "_h2", "_n", *halves).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_times"))
    lines = cut_lineage(lines)
    keys = lines.select("_h1", "_h2", F.explode(F.array(*[F.struct(F.lit(k).alias("_half"), F.col(k).alias("_key")) for k in halves])).alias("_k"))
    keys = keys.select("_h1", "_h2", "_k.*").filter("_key is not null")
    shared = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("_key")
    hits = keys.join(shared, "_key", "left_semi").groupBy("_h1", "_h2").agg(*[F.max(F.col("_half") == k).alias(f"_hit{k}") for k in halves])
    hits = hits.join(lines.select("_h1", "_h2", "_n", "_first"), ["_h1", "_h2"])
    # only the first of equal lines needs its words; lines travel as text, which packs better than words
    same = [F.col(f"_first.{c}").eqNullSafe(F.col(f"_pos.{c}")) for c in ("none", "id", "tie", "line")]
    texts = _lines(docs, id_col, text_col)
    suspects = hits.join(texts, same[0] & same[1] & same[2] & same[3]).dropDuplicates(["_h1", "_h2"])
    near = _near(cut_lineage(suspects.select("_h1", "_h2", "_n", "_first", _words(F.col("_text")).alias("_words"), *[f"_hit{k}" for k in halves])))
    fate = lines.select("_h1", "_h2", "_first", "_times").join(near, ["_h1", "_h2"], "left").filter("_times > 1 or _earlier is not null")
    dropped = found.select("_pos", "_h1", "_h2").join(fate, ["_h1", "_h2"]).filter(F.col("_earlier").isNotNull() | (F.col("_pos") != F.col("_first")))
    keep = F.coalesce("_earlier", "_first")
    return dropped.select(
        F.col("_pos.id").alias(id_col), F.col("_pos.tie").alias("_tie"), F.col("_pos.line").alias("line"),
        keep["id"].alias("keep_id"), keep["line"].alias("keep_line"), F.col("_earlier").isNotNull().alias("near"))


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, columns: tuple = ()) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, n_near, dropped (line numbers in order), and ``columns``."""
    gone = repeated_lines(docs, id_col, text_col, min_words).distinct().groupBy(F.col(id_col).alias("_gone"), F.col("_tie").alias("_gone_tie")).agg(
        F.count(F.lit(1)).alias("n_dropped"), F.sum(F.col("near").cast("long")).alias("n_near"), F.sort_array(F.collect_list("line")).alias("dropped"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns or (id_col,)]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_tie"),
                       F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"))
    rows = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_tie") == F.col("_gone_tie")), "left")
    counted = [F.col("n_lines"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_dropped", "n_near")],
               F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")]
    return rows.select("_row" if columns else F.col("_id").alias(id_col), *counted)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (all columns) with the dropped lines taken out of the text; a null text stays null."""
    rows = line_counts(docs, id_col, text_col, min_words, columns=tuple(docs.columns))
    kept = F.filter(F.split(F.col(f"_row.`{text_col}`"), "\n", -1), lambda x, i: ~F.array_contains(F.col("dropped"), i))
    text = F.when(F.size("dropped") > 0, F.array_join(kept, "\n")).otherwise(F.col(f"_row.`{text_col}`"))
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
