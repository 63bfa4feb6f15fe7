"""Message and receipt triage (D-12 ... D-18, R-9).

The reference pulled every message and vehicle to the driver and looped
over messages x vehicles.  Here the classifier and the gate are column
expressions and the vehicle matcher is a set of equi-joins:

* lot numbers of the shape ``LOT-<digits>``: every ``LOT-<digits>`` token of
  the text is cut to each lot length present in the dictionary and
  equi-joined to the lots.  A lot occurs in the text exactly when it is a
  prefix of such a token, so this is the reference's substring test, not a
  word match (``LOT-12345`` is found inside ``LOT-123456``);
* any other dictionary (lots of another shape, makes, models) goes through
  ``contains_join``: exact substring containment by an anchor join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotline.functions import text as T
from lotline.functions.dates import date_key, hours_between
from lotline.operators.facts import current
from lotline.operators.keys import dense_key
from lotline.session import cut_lineage

# A gram has some 30 bytes; a longer list of anchors meets the grams in a shuffle.
ANCHORS = 100_000
LOT_TOKEN = r"LOT-[0-9]+"
LOT_SHAPE = r"^LOT-[0-9]+$"


# ------------------------------------------------------------ containment

def contains_join(texts: DataFrame, patterns: DataFrame, text_id: str = "text_id", text: str = "text",
                  pattern_id: str = "pattern_id", pattern: str = "pattern", k: int = 16) -> DataFrame:
    """All (text_id, pattern_id) with ``pattern`` a substring of ``text``
    (case-sensitive; empty or null patterns never match).

    Each pattern picks as anchor its rarest substring of length ``a``, the
    largest of k, k/2, k/4 ... 1 that it has (rarity counted over the whole
    dictionary by a group-by), so anchors stay rare in a large dictionary.
    Texts emit their substrings of every anchor length in use, these are
    equi-joined to the anchors, and each candidate is verified with ``instr``.
    Exact, and no text is paired with patterns that do not share its anchor,
    so there is no broadcast nested loop over the dictionary.

    * A pattern of 2k - 1 characters or more has k anchors in a row instead,
      of which any text that holds it has one at a multiple of k; texts emit
      only those, a k-th of their substrings.
    * A long list of anchors meets the substrings in a shuffle.  Before it go
      those that begin as no anchor does, by the longest beginning of which
      there are few.
    """
    p = cut_lineage(patterns.select(F.col(pattern_id).alias("_pid"), F.col(pattern).alias("_pat"))
                    .filter(F.col("_pat").isNotNull() & (F.length("_pat") > 0)).distinct()
                    .withColumn("_n", F.monotonically_increasing_id()))
    size = F.lit(1)
    for a in sorted({k >> i for i in range(k.bit_length())}):
        size = F.when(F.length("_pat") >= a, a).otherwise(size)
    p = p.withColumns({"_a": size, "_step": F.when(F.length("_pat") >= 2 * k - 1, k).otherwise(1)})
    gram = F.substring("_pat", F.col("_pos"), F.col("_a"))
    grams = p.withColumn("_pos", F.explode(F.sequence(F.lit(1), F.length("_pat") - F.col("_a") + 1))).select(
        "_n", "_step", "_pos", F.xxhash64("_a", gram).alias("_h"))  # only counted: two grams of one hash cost some rarity
    freq = grams.groupBy("_h").agg(F.count(F.lit(1)).alias("_f"))
    counts = grams.join(freq, "_h").groupBy("_n", "_step").agg(F.array_sort(F.collect_list(F.struct("_pos", "_f")))["_f"].alias("_fs"))
    # the run of so many grams, one or k, whose most frequent gram is the rarest
    run = F.array_min(F.transform(F.sequence(F.lit(1), F.size("_fs") - F.col("_step") + 1), lambda at: F.struct(
        F.array_max(F.slice("_fs", at, F.col("_step"))).alias("most"), at.alias("at"))))
    anchors = p.join(counts.select("_n", run["at"].alias("_at")), "_n").withColumn(
        "_pos", F.explode(F.sequence(F.col("_at"), F.col("_at") + F.col("_step") - 1)))
    anchors = cut_lineage(anchors.select("_pid", "_pat", "_a", "_step", gram.alias("_g")))
    used = sorted(tuple(r) for r in anchors.select("_a", "_step").distinct().collect()) or [(1, 1)]  # at most one per length and step
    wanted = anchors.select("_a", "_step", "_g").distinct()
    few = wanted.count() <= ANCHORS  # so many at most are held against the grams before anything is shuffled
    t = texts.select(F.col(text_id).alias("_tid"), F.col(text).alias("_txt")).filter(F.col("_txt").isNotNull())
    # a look-ahead finds the grams of one length at all places in one walk over
    # the text, a plain group those at multiples of the length; gram rows carry
    # only (text id, length, step, gram), and the texts with a hit are joined back
    grams_of = [F.struct(F.lit(a).alias("_a"), F.lit(step).alias("_step"), F.array_distinct(F.regexp_extract_all(
        "_txt", F.lit(f"(?s)(.{{{a}}})" if step > 1 else f"(?s)(?=(.{{{a}}}))"), F.lit(1))).alias("_gs")) for a, step in used]
    tg = (t.select("_tid", F.explode(F.array(*grams_of)).alias("_s"))
          .select("_tid", "_s._a", "_s._step", F.explode("_s._gs").alias("_g")))
    if few:
        tg = tg.join(F.broadcast(wanted), ["_a", "_step", "_g"], "left_semi")
    else:
        begins = {n: anchors.select("_a", "_step", F.substring("_g", 1, n).alias("_begin")).distinct() for n in (1, 2, 4, 8)}
        counted = anchors.agg(*[F.count_distinct("_a", "_step", F.substring("_g", 1, n)).alias(str(n)) for n in begins]).first()
        short = [n for n in begins if counted[str(n)] <= ANCHORS]
        if short:
            tg = tg.withColumn("_begin", F.substring("_g", 1, short[-1])).join(F.broadcast(begins[short[-1]]), ["_a", "_step", "_begin"], "left_semi")
    # grams travel as hashes: candidates are verified
    hashed = lambda df, *cols: df.select(*cols, F.xxhash64("_a", "_step", "_g").alias("_h"))
    cand = cut_lineage(hashed(tg, "_tid").join(hashed(anchors, "_pid", "_pat"), "_h").select("_tid", "_pid", "_pat").distinct())
    hits = t.join(F.broadcast(cand) if cand.count() <= ANCHORS else cand, "_tid").filter(F.instr("_txt", F.col("_pat")) > 0)
    return hits.select(F.col("_tid").alias(text_id), F.col("_pid").alias(pattern_id))


def lot_hits(messages: DataFrame, vehicles: DataFrame, text: str = "message_text") -> DataFrame:
    """message_id -> lowest vehicle_id whose non-empty lot occurs in the text
    (case-sensitive substring)."""
    v = vehicles.select("vehicle_id", F.col("auction_lot_no").alias("lot")).filter(
        F.col("lot").isNotNull() & (F.length("lot") > 0))
    shaped = v.filter(F.col("lot").rlike(LOT_SHAPE))
    other = v.filter(~F.col("lot").rlike(LOT_SHAPE))
    tokens = messages.select("message_id", F.explode(F.regexp_extract_all(F.col(text), F.lit(LOT_TOKEN), 0))
                             .alias("tok"))
    # distinct lot lengths: bounded by the longest lot, a handful of values
    lens = shaped.agg(F.collect_set(F.length("lot"))).scalar()
    prefixes = (tokens.select("message_id", "tok", F.explode(lens).alias("n")).filter(F.length("tok") >= F.col("n"))
                .select("message_id", F.substring("tok", 1, F.col("n")).alias("lot")))
    hit_shaped = prefixes.join(shaped, "lot").select("message_id", "vehicle_id")
    hit_other = (contains_join(messages.select("message_id", F.col(text).alias("text")),
                               other.select(F.col("vehicle_id").alias("pattern_id"), F.col("lot").alias("pattern")),
                               text_id="message_id")
                 .select("message_id", F.col("pattern_id").alias("vehicle_id")))
    return hit_shaped.unionByName(hit_other).groupBy("message_id").agg(F.min("vehicle_id").alias("lot_vehicle_id"))


def make_model_candidates(messages: DataFrame, vehicles: DataFrame, text: str = "message_text") -> DataFrame:
    """message_id -> number of vehicles whose make AND model both occur in
    the lower-cased text, and the lowest such vehicle id (J-10, A-15).
    Null make or model never matches."""
    v = (vehicles.select("vehicle_id", F.lower("make").alias("mk"), F.lower("model").alias("md"))
         .filter(F.col("mk").isNotNull() & F.col("md").isNotNull()))
    pairs = v.groupBy("mk", "md").agg(F.count(F.lit(1)).alias("n"), F.min("vehicle_id").alias("min_id"))
    both = named_pairs(messages, pairs, text).join(pairs, ["mk", "md"])
    return both.groupBy("message_id").agg(F.sum("n").alias("n_candidates"), F.min("min_id").alias("cand_min_id"))


def named_pairs(messages: DataFrame, pairs: DataFrame, text: str = "message_text") -> DataFrame:
    """(message_id, mk, md): the makes and the models that a message names, each with each.

    Joined by message, so that a make or a model that many vehicles share
    multiplies nothing: a message has at most its makes times its models.
    """
    t = messages.select("message_id", F.lower(F.col(text)).alias("text"))
    makes = pairs.select(F.col("mk").alias("pattern")).distinct().withColumn("pattern_id", F.col("pattern"))
    models = pairs.select(F.col("md").alias("pattern")).distinct().withColumn("pattern_id", F.col("pattern"))
    mk_hit = contains_join(t, makes, text_id="message_id").select("message_id", F.col("pattern_id").alias("mk"))
    md_hit = contains_join(t, models, text_id="message_id").select("message_id", F.col("pattern_id").alias("md"))
    return mk_hit.join(md_hit, "message_id")


def match_entity(messages: DataFrame, vehicles: DataFrame, rules=T.EVENT_RULES,
                 text: str = "message_text") -> DataFrame:
    """message_id -> event_type, vehicle_id, confidence (D-12, D-13).

    IGNORE -> (null, 0.10) without matching; a lot hit -> (lowest id, 0.95);
    else make+model: one candidate -> (id, 0.60), several -> (null, 0.35),
    none -> (null, 0.30).  All vehicles are searched, deleted ones too.
    """
    typed = messages.select("message_id", text, T.classify(F.col(text), rules).alias("event_type"))
    # several joins read each of these
    relevant = cut_lineage(typed.filter(F.col("event_type") != T.IGNORE).select("message_id", text))
    lots = cut_lineage(lot_hits(relevant, vehicles, text))
    need_names = cut_lineage(relevant.join(lots, "message_id", "left_anti"))
    cands = make_model_candidates(need_names, vehicles, text)
    j = typed.join(lots, "message_id", "left").join(cands, "message_id", "left")
    n = F.coalesce(F.col("n_candidates"), F.lit(0))
    ignore = F.col("event_type") == T.IGNORE
    vid = (F.when(ignore, F.lit(None)).when(F.col("lot_vehicle_id").isNotNull(), F.col("lot_vehicle_id"))
           .when(n == 1, F.col("cand_min_id")))
    conf = (F.when(ignore, T.CONF_IGNORE).when(F.col("lot_vehicle_id").isNotNull(), T.CONF_LOT)
            .when(n == 1, T.CONF_ONE_CANDIDATE).when(n > 1, T.CONF_MANY_CANDIDATES)
            .otherwise(T.CONF_NO_CANDIDATE))
    return j.select("message_id", text, "event_type", vid.cast("long").alias("vehicle_id"),
                    conf.cast("double").alias("confidence_score"))


def extracted_event(messages: DataFrame, vehicles: DataFrame, rules=T.EVENT_RULES,
                    text: str = "message_text") -> DataFrame:
    """One extracted event per message (D-15)."""
    m = match_entity(messages, vehicles, rules, text)
    return m.select(
        F.col("message_id").alias("event_id"), "message_id", "vehicle_id", "event_type",
        T.raw_text_json(F.col(text)).alias("extracted_fields"), "confidence_score",
        T.gate("confidence_score", "event_type").alias("review_status"),
        F.lit(None).cast("long").alias("reviewed_by_staff_id"),
        F.lit(None).cast("timestamp").alias("reviewed_at"))


def score_receipts(lines: DataFrame, purchase: DataFrame) -> DataFrame:
    """Receipt-line confidence (R-9): the amount equals a purchase price of
    the same vehicle -> 0.92, else 0.55; then the receipt gate."""
    prices = (purchase.select("vehicle_id", F.col("price_amount").cast("decimal(14,2)").alias("amount"))
              .distinct().withColumn("_ok", F.lit(True)))
    j = lines.join(prices, ["vehicle_id", "amount"], "left")
    score = F.when(F.col("_ok").isNotNull(), T.CONF_RECEIPT_OK).otherwise(T.CONF_RECEIPT_MISMATCH)
    return (j.drop("confidence_score", "review_status")
            .withColumn("confidence_score", score.cast("double"))
            .withColumn("review_status", T.gate("confidence_score"))
            .drop("_ok"))


def review_tasks(items: DataFrame, id_col: str, source_type: str, existing: DataFrame | None = None,
                 assignee: int = 1, as_of=None) -> DataFrame:
    """OPEN review tasks for PENDING items (D-16, D-17), numbered by item id
    after the existing tasks' maximum (1..n when there are none)."""
    pend = items.filter(F.col("review_status") == "PENDING").select(F.col(id_col).cast("long").alias("source_id"))
    if existing is None:
        keyed = dense_key(pend, "source_id", "task_id")
    else:
        mx = existing.agg(F.max("task_id").alias("_mx"))
        keyed = dense_key(pend, "source_id", "task_id", offset=mx)
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    ts_type = "timestamp" if as_of is None else "timestamp_ntz"
    return keyed.select("task_id", F.lit(source_type).alias("source_type"), "source_id",
                        F.lit(assignee).cast("long").alias("assigned_to_staff_id"), F.lit("OPEN").alias("status"),
                        ts.alias("created_at"), F.lit(None).cast(ts_type).alias("resolved_at"))


def fact_review_queue(tasks: DataFrame, events: DataFrame, receipt_lines: DataFrame,
                      dim_staff: DataFrame, dim_source: DataFrame) -> DataFrame:
    """One row per review task (D-18).

    Confidence comes from the event when source_type is EXTRACTED_EVENT and
    from the receipt line for any other type (as in the reference): a tagged
    union and one equi-join on (kind, id).
    """
    conf = (events.select(F.lit("E").alias("_kind"), F.col("event_id").alias("_sid"), "confidence_score")
            .unionByName(receipt_lines.select(F.lit("R").alias("_kind"), F.col("line_id").alias("_sid"),
                                              "confidence_score")))
    is_event = F.col("source_type") == "EXTRACTED_EVENT"
    t = tasks.withColumn("_kind", F.when(is_event, "E").otherwise("R")).withColumn(
        "_code", F.when(is_event, "WHATSAPP_GROUP_AGENT").otherwise("RECEIPT_AGENT"))
    j = t.join(conf, (t["_kind"] == conf["_kind"]) & (t["source_id"] == conf["_sid"]), "left").drop(conf["_kind"])
    staff = current(dim_staff).select(F.col("staff_id").alias("_st"), F.col("staff_key").alias("assigned_staff_key"))
    src = dim_source.select(F.col("source_code").alias("_code"), "source_key")
    j = (j.join(staff, j["assigned_to_staff_id"] == staff["_st"], "left")
         .join(src, "_code", "left"))
    return j.select(
        F.col("task_id").alias("task_key"), "source_key", "assigned_staff_key",
        date_key("created_at").alias("created_date_key"), date_key("resolved_at").alias("resolved_date_key"),
        "confidence_score", hours_between("created_at", "resolved_at").alias("resolution_hours"), "status")
