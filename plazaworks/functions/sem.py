"""Warehouse-SQL semantics that differ from Spark's own functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    """Accept a column or its name."""
    return F.col(c) if isinstance(c, str) else c


_WORD = "[0-9A-Za-z_]"
_BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def ascii_pattern(pattern: str) -> str:
    r"""The pattern with ``\b`` between ASCII word signs only.

    The warehouse sees a boundary between an accented letter and a plain one;
    Java does not, so the boundary is spelled out.
    """
    return pattern.replace(r"\b", _BOUNDARY)


def regexp_extract_n(c, pattern: str, group: int = 1) -> Column:
    """Group of the first match; NULL (not '') where nothing matches."""
    c, pattern = col(c), ascii_pattern(pattern)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def regexp_extract_all_n(c, pattern: str, group: int = 0) -> Column:
    """All matches as an array; group 0 is the whole match."""
    return F.regexp_extract_all(col(c), F.lit(ascii_pattern(pattern)), F.lit(group))


# after any of these a new word starts
INITCAP_DELIMITERS = r"""\s\[\](){}/|<>!?@"^#$&~_,.:;*%+\-"""


def initcap_delims(c, delimiters: str = INITCAP_DELIMITERS) -> Column:
    """Upper-case the first letter of each word; punctuation also ends a word."""
    pieces = F.split(F.lower(col(c)), f"(?<=[{delimiters}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), p.substr(F.lit(2), F.length(p)))),
        "",
    )


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def least_strict(*cs) -> Column:
    """LEAST that is NULL as soon as one argument is NULL."""
    cs = [col(c) for c in cs]
    return F.when(~_any_null(cs), F.least(*cs))


def greatest_strict(*cs) -> Column:
    """GREATEST that is NULL as soon as one argument is NULL."""
    cs = [col(c) for c in cs]
    return F.when(~_any_null(cs), F.greatest(*cs))


def safe_cast(c, dtype: str) -> Column:
    """Cast that yields NULL instead of raising."""
    return col(c).try_cast(dtype)


def safe_divide(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def not_in(c, values) -> Column:
    """``NOT IN`` over a literal list, three-valued as in SQL."""
    return ~col(c).isin(list(values))
