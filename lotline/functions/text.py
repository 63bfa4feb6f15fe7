"""Text column functions: event classifier, confidence gate, JSON field,
form-id formatting (D-12, D-14, F-14 ... F-19)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results: the
# classifier's rules, checked in this order, first hit wins; a hit is a
# plain substring of the lower-cased text.
EVENT_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("PICKUP", ("picked up", "picking up")),
    ("OFFICE_ARRIVAL", ("arrived", "at the office")),
    ("REPAIR_PROGRESS", ("fixed", "bumper", "headlight", "repair", "working on")),
    ("CUSTOMS_UPDATE", ("held", "duty", "customs")),
)
IGNORE = "IGNORE"

# Confidence levels of the matcher and the gate threshold.
CONF_IGNORE = 0.10
CONF_LOT = 0.95
CONF_ONE_CANDIDATE = 0.60
CONF_MANY_CANDIDATES = 0.35
CONF_NO_CANDIDATE = 0.30
CONF_RECEIPT_OK = 0.92
CONF_RECEIPT_MISMATCH = 0.55
AUTO_ACCEPT_THRESHOLD = 0.85


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def classify(text, rules: Sequence[tuple[str, Sequence[str]]] = EVENT_RULES,
             default: str = IGNORE) -> Column:
    """Ordered keyword classifier as one CASE expression.

    Null text is classified as ``default`` (the reference raised on it).
    """
    t = F.lower(_c(text))
    expr = None
    for label, words in rules:
        cond = None
        for w in words:
            hit = t.contains(w)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if expr is None:
        return F.lit(default)
    return F.coalesce(expr.otherwise(default), F.lit(default))


def gate(score, event_type=None, threshold: float = AUTO_ACCEPT_THRESHOLD) -> Column:
    """Confidence gate.

    Messages (``event_type`` given): >= threshold -> AUTO_ACCEPTED; else
    IGNORE -> AUTO_REJECTED; else PENDING.  Receipts (no type): >= threshold
    -> AUTO_ACCEPTED else PENDING.
    """
    s = _c(score)
    g = F.when(s >= threshold, "AUTO_ACCEPTED")
    if event_type is not None:
        g = g.when(_c(event_type) == IGNORE, "AUTO_REJECTED")
    return g.otherwise("PENDING")


def raw_text_json(text) -> Column:
    """``{"raw_text": ...}`` as a correctly escaped JSON string (F-19)."""
    return F.to_json(F.struct(_c(text).alias("raw_text")))


def form_id(prefix: str, id_col, width: int = 4) -> Column:
    """Zero-padded form id such as ``FORM-PUR-0001`` (F-17)."""
    return F.format_string(f"{prefix}-%0{width}d", _c(id_col))


def lookup(col: Column, mapping: Mapping[str, str]) -> Column:
    """Static lookup (F-23): the value of a literal mapping, null for other keys."""
    return F.get(F.array(*[F.lit(v) for v in mapping.values()]), F.array_position(F.array(*[F.lit(k) for k in mapping]), col).cast("int") - 1)
