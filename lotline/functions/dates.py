"""Date and time column functions (F-1 ... F-9).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Functions accept a column name or a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(d) -> Column:
    """Date -> ``yyyyMMdd`` int key; null stays null."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def day_diff(a, b) -> Column:
    """Days from ``a`` to ``b`` (b - a); null when either is null; may be negative."""
    return F.datediff(_c(b), _c(a))


def elapsed_days(d, as_of) -> Column:
    """Whole days from ``d`` to the as-of date."""
    return F.datediff(_lit_date(as_of), _c(d))


def add_days(d, n) -> Column:
    return F.date_add(_c(d), n if isinstance(n, Column) else F.lit(n))


def midnight(d) -> Column:
    """Date -> midnight timestamp without zone (what the reference's
    ``datetime.combine(d, time.min)`` gives)."""
    return _c(d).cast("timestamp_ntz")


def hours_between(a, b) -> Column:
    """Fractional hours from ``a`` to ``b``; null when either is null.
    Computed on the values as given (no session-zone conversion of
    zone-less timestamps, so no DST shifts)."""
    return F.timestamp_diff("MICROSECOND", _c(a), _c(b)) / F.lit(3.6e9)


def calendar_parts(d) -> dict[str, Column]:
    """Calendar attributes of a date column (F-4)."""
    d = _c(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "day_of_week": F.date_format(d, "EEEE"),
        "week_of_year": F.weekofyear(d),
        "month_no": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        # dayofweek: 1 = Sunday ... 7 = Saturday
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }


def _lit_date(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("date")


def add_hours(ts, hours) -> Column:
    """Timestamp plus hours, fractions included (F-7)."""
    h = F.lit(hours) if isinstance(hours, (int, float)) else _c(hours)
    return _c(ts) + F.make_dt_interval(secs=(h * 3600).cast("decimal(18,6)"))
