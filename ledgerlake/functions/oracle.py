"""Oracle text, number and date rules expressed as Spark columns.

* '' is NULL in Oracle -> `blank_to_null`.
* `NULL || 'x'` is 'x' -> `messages` joins with concat_ws, which skips NULLs.
* TO_NUMBER failure -> `try_cast` to DECIMAL (Spark's double cast would accept '1d', 'NaN').
* TO_DATE with three regex-guarded patterns -> `parse_date3`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

NUMBER = "decimal(38,10)"

# ---- fixed values: the three accepted date texts, first match wins --------------
DATE_PATTERNS: list[tuple[str, str]] = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}-[A-Za-z]{3}-\d{4}$", "dd-MMM-yyyy"),
    (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"),
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Oracle stores '' as NULL."""
    return F.nullif(_c(c), F.lit(""))


def messages(*parts: tuple[Column, str] | Column) -> Column:
    """Append texts in order; each part is (condition, text) or a text column.

    A NULL condition does not fire (an Oracle IF on UNKNOWN). Returns NULL when
    nothing fired, like an Oracle variable that was only ever appended to.
    """
    cols = []
    for p in parts:
        if isinstance(p, tuple):
            cond, text = p
            cols.append(F.when(cond, F.lit(text)))
        else:
            cols.append(p)
    return F.nullif(F.concat_ws("", *cols), F.lit(""))


def to_number(c) -> Column:
    return _c(c).try_cast(NUMBER)


def is_bad_number(c) -> Column:
    """TO_NUMBER would raise: a non-NULL text that is not a number."""
    return _c(c).isNotNull() & to_number(c).isNull()


def parse_date3(c) -> Column:
    """First matching pattern decides; an impossible date (31-Feb) gives NULL."""
    col = _c(c)
    expr = None
    for regex, fmt in DATE_PATTERNS:
        parsed = F.try_to_date(col, fmt)
        expr = F.when(col.rlike(regex), parsed) if expr is None else expr.when(col.rlike(regex), parsed)
    return expr


def is_bad_date(c) -> Column:
    return _c(c).isNotNull() & parse_date3(c).isNull()


def not_in_guarded(c, values: Iterable[str]) -> Column:
    """`c IS NOT NULL AND c NOT IN (...)` - membership checks skip NULLs."""
    col = _c(c)
    return col.isNotNull() & ~col.isin(list(values))


def holds_word(c, word: str) -> Column:
    """INSTR(UPPER(c), word) > 0; NULL text never holds the word."""
    return F.coalesce(F.instr(F.upper(_c(c)), word) > 0, F.lit(False))
