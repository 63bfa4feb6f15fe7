"""Chat formatting: quotation linking (DataFrame functions only).

A message's lines have a quote level, the number of ``>`` before them.  Runs
of lines of one level are passages.  Passages and messages are cut in pieces:
the whole, its lines, its sentences, and all windows of ``WINDOW`` words.  The
pieces are hashed in a normal form (letters and digits only, lower case) and
joined to the messages of the conversation that have the same piece unquoted.
The original of a passage is the earliest message that has all of it: as a whole
text, line or sentence, or as words in a row; for that the messages of its rarest
window are looked at, and the texts of those with all its windows compared.  A passage that no message has whole goes to the one with
the most of its words, a piece counting for the earliest message that has it.
The innermost quote level that a message adds to, the first, says what it
replies to; quotes and the lines that introduce them are then taken out.

A message that answers an earlier one than its predecessor begins a branch, any
other goes on in the branch before it: a branch is a run of neighbouring turns.
Branches are found by running maxima inside blocks of turns and then over the
blocks' maxima, so a conversation of very many turns is not put into one task;
originals are aggregated to the earliest before they are joined, so a phrase
that everybody writes makes no pairs.

Threads follow the replies: a message answers what it quotes, else the message
before it, and is in the thread of what it answers unless that has an earlier
answer; then it opens a thread.  Inside a branch every message goes on from the
one before, so threads are chains of whole branches, each joined to the branch
whose last message it is the first to answer; the chains are followed by
pointer doubling.  In the order (conversation, thread, turn) a message stands
right after the one it continues.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotline.session import cut_lineage

#: Turns of one conversation that are put in order together.
BLOCK = 512
#: Words of the windows by which parts of sentences and text wrapped anew are found.
WINDOW = 5
#: Conversations with quotes up to which the list of them is broadcast.
BROADCAST_QUOTING = 100_000
_MARKS = r"^((?:[ \t]*>)+)[ \t]?"
# a line that introduces a quote: "On ..., X wrote:" in some languages
_INTRODUCES = r"(?i)^.*\b(?:wrote|writes|said|schrieb|écrit|escribió)\b.{0,80}:\s*$"
LAST = 9223372036854775807


def normal(text: Column) -> Column:
    """Letters and digits in lower case, single spaces between."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def parse(messages: DataFrame, text_col: str = "_text") -> DataFrame:
    """``messages`` with _lines (level, text), _body (without quotes) and _passages (level, lines)."""
    lines = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\r?\n", -1), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 1), "[^>]", "")).alias("level"), F.regexp_replace(x, _MARKS, "").alias("text")))
    rows = messages.withColumn("_lines", lines)
    line, level = F.col("_lines"), lambda i: F.get("_lines", i)["level"]
    introduces = lambda x, i: x["text"].rlike(_INTRODUCES) & (F.coalesce(level(i + 1), F.lit(0)) > 0)
    own = F.filter(line, lambda x, i: (x["level"] == 0) & ~introduces(x, i))
    body = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["text"]), "\n"), r"^\s+|\s+$", "")
    # a message without quotes keeps its text as it is
    body = F.when(F.exists(line, lambda x: x["level"] > 0), body).otherwise(F.coalesce(F.col(text_col), F.lit("")))
    places = F.sequence(F.lit(0), F.size(line) - 1)
    begins = F.filter(places, lambda i: (i == 0) | (level(i) != level(i - 1)))
    rows = rows.withColumns({"_body": body, "_begins": begins})
    run = lambda b, k: F.slice("_lines", b + 1, F.coalesce(F.get("_begins", k + 1), F.size("_lines")) - b)
    runs = F.transform("_begins", lambda b, k: F.struct(level(b).alias("level"), F.transform(run(b, k), lambda x: x["text"]).alias("lines")))
    return rows.withColumn("_passages", F.filter(runs, lambda p: p["level"] > 0)).drop("_begins")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pieces(text: Column, lines: Column) -> Column:
    """Pieces of a text, those without a word left out: (kind, hash, at, n), ``n`` words; ``at`` is the first word of a window."""
    def cut(kind: int, parts: Column) -> Column:
        parts = F.filter(F.array_distinct(F.transform(parts, normal)), lambda x: x != "")
        return F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("kind"), _hash(x).alias("hash"), i.alias("at"), F.size(F.split(x, " ")).alias("n")))

    def windows(words: Column) -> Column:
        starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(3).alias("kind"), _hash(F.array_join(F.slice(words, i, WINDOW), " ")).alias("hash"), i.alias("at"), F.lit(WINDOW).alias("n")))

    sentences = F.split(F.regexp_replace(text, r"\s+", " "), r"(?<=[.!?])[\"')\]]* |(?<=[。！？])")
    return F.concat(cut(0, F.array(text)), cut(1, lines), cut(2, sentences), _let(F.split(normal(text), " "), windows))


def _words(pieces: Column) -> Column:
    """Words in pieces (at, n) of one kind, sorted; windows may overlap."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
    return F.aggregate(pieces, begin, lambda s, p: F.struct((p["at"] + p["n"]).alias("end"), (s["sum"] + p["at"] + p["n"] - F.greatest(p["at"], s["end"])).alias("sum")))["sum"]


def _whole_originals(pieces: DataFrame, originals: DataFrame, known: DataFrame, passages: DataFrame, messages: DataFrame) -> DataFrame:
    """(_in, _pid, _from, _whole, _words): the messages that have the words of a passage in a row, with their number.

    Only passages whose windows are all met are looked at.  A message that has
    them all has the rarest, so its messages are the candidates; a candidate's
    windows are then counted, and the texts of those that have all are compared.
    """
    key = ["_in", "_pid"]
    met = pieces.join(known, ["_in", "_hash"], "left")
    state = met.groupBy(*key).agg(
        F.bool_and((F.col("_kind") != 3) | F.col("_held").isNotNull()).alias("_all"),
        F.min_by(F.when(F.col("_kind") == 3, F.col("_hash")), F.when(F.col("_kind") == 3, F.struct("_held", "_hash"))).alias("_hash"),
        F.count_distinct(F.when(F.col("_kind") == 3, F.col("_hash"))).alias("_windows"),
        F.max(F.when(F.col("_kind") == 0, F.col("_n"))).alias("_words"))
    state = state.filter("_all and _hash is not null")
    candidates = cut_lineage(state.join(originals, ["_in", "_hash"]).select(*key, "_from", "_windows", "_words"))
    windows = pieces.filter("_kind = 3").select(*key, "_hash").distinct()
    has = candidates.join(windows, key).join(originals, ["_in", "_from", "_hash"], "left_semi")
    has = has.groupBy(*key, "_from", "_windows", "_words").agg(F.count(F.lit(1)).alias("_has"))
    has = cut_lineage(has.filter("_has = _windows").select(*key, "_from", "_words"))
    spaced = lambda c: F.concat(F.lit(" "), normal(c), F.lit(" "))
    said = passages.select(*key, spaced(F.array_join("_said", " ")).alias("_said"))
    # only texts of candidates travel, once each; a text is compared where it meets its passages
    texts = messages.join(has.select("_in", "_from").distinct(), (messages["_in"] == has["_in"]) & (F.col("_turn") == F.col("_from")), "left_semi")
    texts = texts.select("_in", F.col("_turn").alias("_from"), spaced(F.col("_body")).alias("_text"))
    in_a_row = has.join(said, key).join(texts, ["_in", "_from"]).filter(F.col("_text").contains(F.col("_said")))
    return in_a_row.select(*key, "_from", F.lit(True).alias("_whole"), "_words").distinct()


def link_quotes(messages: DataFrame) -> DataFrame:
    """(_conv, _turn, _tie, _reply, _quotes): what parsed ``messages`` reply to and quote.

    ``_quotes`` is the sorted array of (level, turn) of the linked passages.
    A passage that a message has as a whole text, line or sentence, or with
    its words in a row, links to the earliest such message before it.  Of any other,
    each piece counts for the earliest message that has it, and the passage
    links to the message with most words in pieces of one kind, of equal ones
    to the earliest.  Of several passages at the first level the latest original
    is the one replied to.
    """
    # only conversations with quotes are cut in pieces; a conversation stands in a struct, so that nulls meet
    messages = messages.withColumn("_in", F.struct("_conv"))
    quoting = cut_lineage(messages.filter(F.col("_text").rlike(r"(?m)^[ \t]*>")).select("_in").distinct())
    quoting = F.broadcast(quoting) if quoting.count() <= BROADCAST_QUOTING else quoting
    quotes = messages.filter(F.size("_passages") > 0).select("_in", "_conv", "_turn", "_tie", F.posexplode("_passages").alias("_nth", "_p"))
    quotes = cut_lineage(quotes.withColumn("_pid", _hash(F.array_join("_p.lines", "\n"))))
    # a passage that many quote is looked up once
    passages = quotes.groupBy("_in", "_pid").agg(F.first("_p.lines").alias("_said"))
    pieces = passages.select("_in", "_pid", F.explode(_pieces(F.array_join("_said", " "), F.col("_said"))).alias("_k"))
    pieces = cut_lineage(pieces.select("_in", "_pid", F.col("_k.kind").alias("_kind"), F.col("_k.hash").alias("_hash"), F.col("_k.at").alias("_at"), F.col("_k.n").alias("_n")))
    own = F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["text"])
    originals = messages.join(quoting, "_in", "left_semi")
    originals = originals.select("_in", F.col("_turn").alias("_from"), F.explode(F.array_distinct(F.transform(_pieces(F.col("_body"), own), lambda p: p["hash"]))).alias("_hash"))
    # of the messages' pieces only those of passages are kept; turns that share a number count once
    originals = cut_lineage(originals.join(pieces.select("_in", "_hash").distinct(), ["_in", "_hash"], "left_semi").distinct())
    known = originals.groupBy("_in", "_hash").agg(F.min("_from").alias("_from"), F.count(F.lit(1)).alias("_held"))
    key = ["_in", "_pid"]
    met = pieces.join(known, ["_in", "_hash"])
    linked = met.groupBy(*key, "_from", "_kind").agg(F.sort_array(F.collect_set(F.struct(F.col("_at").alias("at"), F.col("_n").alias("n")))).alias("_met"))
    words = F.when(F.col("_kind") == 3, _words(F.col("_met"))).otherwise(F.aggregate("_met", F.lit(0), lambda t, p: t + p["n"]))
    # pieces may cover all words and yet not be the passage: in another order, for instance
    linked = linked.select(*key, "_from", (F.col("_kind") == 0).alias("_whole"), words.alias("_words"))
    linked = linked.unionByName(_whole_originals(pieces, originals, known.drop("_from"), passages, messages.join(quoting, "_in", "left_semi")))
    # of equal numbers of words the earliest message is the original, so a passage keeps one message a number
    best = linked.groupBy(*key, "_whole", "_words").agg(F.min("_from").alias("_from"))
    best = best.groupBy(*key).agg(F.collect_list(F.struct(F.col("_whole").alias("whole"), F.col("_words").alias("words"), (-F.col("_from")).alias("before"))).alias("_best"))
    earlier = F.filter("_best", lambda b: -b["before"] < F.col("_turn"))
    linked = quotes.join(best, key).withColumn("_from", -F.array_max(earlier)["before"]).filter("_from is not null")
    linked = linked.withColumn("_level", F.col("_p.level"))
    return linked.groupBy("_conv", "_turn", "_tie").agg(
        F.max(F.when(F.col("_level") == 1, F.col("_from"))).alias("_reply"), F.sort_array(F.collect_set(F.struct(F.col("_level").alias("level"), F.col("_from").alias("turn")))).alias("_quotes"))


def reply_order(messages: DataFrame) -> DataFrame:
    """``messages`` (_conv, _turn, _reply) with ``_branch``, the turn that its branch begins with."""
    begins = F.when(F.col("_reply").isNotNull() & (F.col("_reply") < F.col("_turn") - 1), F.col("_turn"))
    rows = messages.withColumns({"_begin": begins, "_block": F.floor(F.col("_turn") / BLOCK)})
    blocks = rows.groupBy("_conv", "_block").agg(F.max("_begin").alias("_last"), F.min("_turn").alias("_least"))
    before = Window.partitionBy("_conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.select(F.col("_conv").alias("_c"), F.col("_block").alias("_b"), F.max("_last").over(before).alias("_earlier"), F.min("_least").over(whole).alias("_root"))
    inside = Window.partitionBy("_conv", "_block").orderBy("_turn").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_here", F.max("_begin").over(inside))
    rows = rows.join(blocks, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_block") == F.col("_b")))
    return rows.withColumn("_branch", F.coalesce("_here", "_earlier", "_root")).drop("_begin", "_block", "_here", "_earlier", "_root", "_c", "_b")


def reply_threads(marks: DataFrame) -> DataFrame:
    """``marks`` (_conv, _turn, _reply, _branch; a written table) with ``_thread``, the turn that its thread begins with.

    Rows that share a turn are one message here; the latest of their replies counts.
    """
    first = F.col("_turn") == F.col("_branch")
    runs = marks.groupBy("_conv", "_branch").agg(F.max("_turn").alias("_end"), F.max(F.when(first, F.col("_reply"))).alias("_to"))
    answers = runs.filter("_to is not null").groupBy(F.col("_conv").alias("_c"), "_to").agg(F.min("_branch").alias("_run"))
    # only a branch's last message has no answer inside of it
    ends = runs.select("_conv", "_end", F.col("_branch").alias("_up"))
    edges = answers.join(ends, F.col("_c").eqNullSafe(F.col("_conv")) & (F.col("_to") == F.col("_end"))).select("_c", "_run", "_up")
    edges, more = cut_lineage(edges), True
    if edges.isEmpty():
        return marks.withColumn("_thread", F.col("_branch"))
    while more:
        above = edges.toDF("_a", "_r", "_top")
        edges = edges.join(above, F.col("_c").eqNullSafe(F.col("_a")) & (F.col("_up") == F.col("_r")), "left")
        edges = cut_lineage(edges.select("_c", "_run", F.coalesce("_top", "_up").alias("_up"), F.col("_top").isNotNull().alias("_more")))
        more, edges = not edges.filter("_more").isEmpty(), edges.drop("_more")
    # a branch may have very many turns, so its thread reaches them by blocks
    rows = marks.withColumn("_block", F.floor(F.col("_turn") / BLOCK))
    parts = rows.select("_conv", "_branch", "_block").distinct()
    parts = parts.join(edges, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_branch") == F.col("_run")))
    parts = parts.select(F.col("_conv").alias("_a"), F.col("_branch").alias("_r"), F.col("_block").alias("_b"), "_up")
    rows = rows.join(parts, F.col("_conv").eqNullSafe(F.col("_a")) & (F.col("_branch") == F.col("_r")) & (F.col("_block") == F.col("_b")), "left")
    return rows.withColumn("_thread", F.coalesce("_up", "_branch")).drop("_block", "_a", "_r", "_b", "_up")


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per input row: conv, turn, role, text without quotes, formatted, quote_depth, n_quotes, quotes, reply_to, branch, thread.

    ``quotes`` are (level, turn) of the linked passages, ``reply_to`` the turn
    that the message answers by quoting (null: none found), ``branch`` the turn
    its branch begins with, ``thread`` the turn its thread begins with (both
    null where that is a null turn); sorted by (conv, thread, turn), nulls
    last, the conversation is in reply order.  ``formatted`` is the message in role marks.  A null
    text counts as empty, a null role as ``user``; null conversations are one
    conversation, a null turn comes after all others and is quoted by none.
    Rows that share conversation and turn are kept apart by their text; rows
    that repeat whole get the same result.  An empty table gives no rows.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = conversations.select(F.col(f"`{conv_col}`").alias("_conv"), F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(LAST)).alias("_turn"),
                                F.col(f"`{turn_col}`").alias("_given"), F.col(f"`{role_col}`").cast("string").alias("_role"), text.alias("_text"), F.xxhash64(text).alias("_tie"))
    parsed = parse(rows)
    # links and branches are found on the keys; texts are shuffled once, to meet them
    found = link_quotes(parsed).toDF("_c", "_t", "_u", "_reply", "_quotes")
    keys = rows.select("_conv", "_turn", "_tie").distinct()
    keys = keys.join(found, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_turn") == F.col("_t")) & (F.col("_tie") == F.col("_u")), "left").drop("_c", "_t", "_u")
    marks = reply_threads(cut_lineage(reply_order(cut_lineage(keys)))).toDF("_c", "_t", "_u", "_reply", "_quotes", "_branch", "_thread")
    depth = F.coalesce(F.array_max(F.transform("_passages", lambda p: p["level"])), F.lit(0))
    rows = parsed.select("_conv", "_turn", "_given", "_role", "_tie", "_body", depth.alias("_depth"), F.size("_passages").alias("_n"))
    rows = rows.join(marks, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_turn") == F.col("_t")) & (F.col("_tie") == F.col("_u")))
    role = F.coalesce("_role", F.lit("user"))
    return rows.select(
        F.col("_conv").alias(conv_col), F.col("_given").alias(turn_col), F.col("_role").alias(role_col), F.col("_body").alias(text_col),
        F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), F.col("_body"), F.lit("<|im_end|>")).alias("formatted"),
        F.col("_depth").cast("long").alias("quote_depth"), F.col("_n").cast("long").alias("n_quotes"),
        F.coalesce("_quotes", F.array().cast("array<struct<level:int,turn:bigint>>")).alias("quotes"), F.col("_reply").alias("reply_to"),
        F.when(F.col("_branch") < LAST, F.col("_branch")).alias("branch"),
        F.when(F.col("_thread") < LAST, F.col("_thread")).alias("thread"))
