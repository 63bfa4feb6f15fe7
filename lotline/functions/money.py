"""Money column functions (F-10 ... F-13).

Money stays decimal so that sums do not depend on partition order; the
rounding modes are the ones the reference uses: half-up for ``round``,
half-even (Python's ``round``/``quantize``) for list and agreed prices.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
UNIT_COST = "decimal(12,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_to_multiple_half_even(x, step: int) -> Column:
    """Round to a multiple of ``step``, ties to even (F-12)."""
    return F.bround(_c(x) / F.lit(step), 0) * F.lit(step)


def quantize_whole(x) -> Column:
    """Whole units, ties to even (F-13)."""
    return F.bround(_c(x), 0)


def pct(numer, denom, scale: int = 2) -> Column:
    """round(numer / denom * 100, scale); null when denom is null or 0."""
    n, d = _c(numer).cast("double"), _c(denom).cast("double")
    return F.when(d.isNotNull() & (d != 0), F.round(n / d * 100, scale))
