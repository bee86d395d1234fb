"""Date arithmetic, aging buckets and the d-Mon-yyyy / m/d/yyyy text forms."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

# ---- fixed values: aging buckets, right-closed upper bounds in days ------------
AGING_BUCKETS: list[tuple[int | None, str]] = [
    (0, "Current"),
    (30, "1 to 30"),
    (60, "31 to 60"),
    (90, "61 to 90"),
    (180, "91 to 180"),
    (None, "181+"),
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def last_day_of_next_month(as_of) -> Column:
    return F.last_day(F.add_months(_date_lit(as_of), 1))


def aging_bucket(days) -> Column:
    d = _c(days)
    expr = None
    for upper, label in AGING_BUCKETS:
        cond = d.isNotNull() if upper is None else d <= upper
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def parse_dmy(c) -> Column:
    """pandas to_datetime(s.str.strip(), format='%d-%b-%Y', errors='coerce').

    Only texts shaped like a date reach the parser (a failed parse is costly)."""
    from ledgerlake.functions.text import strip_ws
    t = strip_ws(c)
    return F.when(t.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.try_to_date(t, "d-MMM-yyyy"))


def format_mdy(d) -> Column:
    """strftime('%#m/%#d/%Y'): no zero padding."""
    return F.date_format(_c(d), "M/d/yyyy")


def normalise_date_text(c) -> Column:
    """Parse d-Mon-yyyy, print m/d/yyyy, '' when missing or unparseable."""
    return F.coalesce(format_mdy(parse_dmy(c)), F.lit(""))


def date_stamp(as_of, fmt: str = "yyyyMMdd") -> Column:
    return F.date_format(_date_lit(as_of), fmt)
