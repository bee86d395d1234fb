"""Text cleaning for invoice lists and file paths.

Python's `\\w`/`\\s` are Unicode-aware; Java's are ASCII unless `(?U)` is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values: prefixes glued to the number that follows, in this order ----
GLUED_PREFIXES = ["CM ", "DM ", "NS "]

# a plain decimal number, optionally signed, optionally with an exponent
_NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python str.strip(): remove leading/trailing Unicode white space."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def collapse_ws(c) -> Column:
    """`re.sub(r'\\s+', ' ', s.strip())`."""
    return strip_ws(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def clean_invoice_text(c) -> Column:
    """Drop '#', other punctuation -> space, collapse, glue CM/DM/NS, collapse again."""
    x = F.replace(_c(c), F.lit("#"), F.lit(""))
    x = F.regexp_replace(x, r"(?U)[^\w\s]", " ")
    x = collapse_ws(x)
    for prefix in GLUED_PREFIXES:
        x = F.replace(x, F.lit(prefix), F.lit(prefix.strip()))
    return collapse_ws(x)


def split_pieces(c) -> Column:
    """Split on one space keeping empty pieces; a missing value gives ['']."""
    return F.coalesce(F.split(_c(c), " "), F.array(F.lit("")))


def lenient_double(c, strip_commas: bool = False) -> Column:
    """pandas to_numeric(errors='coerce') for plain decimal texts; other text -> NULL."""
    x = _c(c)
    if strip_commas:
        x = F.replace(x, F.lit(","), F.lit(""))
    return F.when(x.rlike(_NUMERIC), F.trim(x).try_cast("double"))


def double_column(df: DataFrame, name: str) -> Column:
    """A sheet column as numbers: text is coerced, a numeric column keeps its values; NaN is missing."""
    col = F.col(f"`{name}`")
    x = lenient_double(col) if dict(df.dtypes)[name] == "string" else col.cast("double")
    return F.when(~F.isnan(x), x)


def file_name_of(path) -> Column:
    return F.regexp_extract(_c(path), r"([^/\\]*)$", 1)


def file_dir_of(path) -> Column:
    return F.regexp_extract(_c(path), r"^(.*)[/\\][^/\\]*$", 1)


def file_ext_of(path) -> Column:
    """Lower-cased extension with the dot ('.xls'), '' when there is none."""
    return F.lower(F.regexp_extract(file_name_of(path), r"(\.[^.]*)$", 1))
