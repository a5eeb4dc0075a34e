"""JSON kept in strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sem import col


def scalar(doc, path: str) -> Column:
    """Scalar at ``path``; objects and arrays give NULL."""
    v = F.get_json_object(col(doc), path)
    return F.when(~v.rlike(r"^\s*[\[{]"), v)


def as_map(doc) -> Column:
    """Parse a flat object once: ``map<string,string>`` of its fields."""
    return F.from_json(col(doc), "map<string,string>")


def first_of_keys(doc_map, keys: Sequence[str]) -> Column:
    """First non-NULL of several keys of an already parsed object.

    Use with :func:`as_map` when many keys are read, so that the text is parsed
    once instead of once per key.
    """
    m = col(doc_map)
    return F.coalesce(*[F.try_element_at(m, F.lit(k)) for k in keys])


def first_of_paths(doc, paths: Sequence[str]) -> Column:
    """First non-NULL scalar of several paths (few paths, nested documents)."""
    return F.coalesce(*[scalar(doc, p) for p in paths])


def unquoted(doc, path: str) -> Column:
    """Value at ``path`` without the surrounding quotes."""
    return F.regexp_replace(F.get_json_object(col(doc), path), '^"|"$', "")


def lax_string(doc, field: str) -> Column:
    """Field as text; bad documents give NULL instead of an error."""
    return F.try_variant_get(F.try_parse_json(col(doc)), f"$.{field}", "string")


def strip_list_wrapper(c) -> Column:
    """``["x"]`` -> ``x``."""
    return F.regexp_replace(col(c), r'^\["|"\]$', "")
