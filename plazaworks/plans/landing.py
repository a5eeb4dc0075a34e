"""Cleaning of landed sheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.text import strip_float_tail


def clean_landed(df: DataFrame, drop: Sequence[str] = (), dates: Mapping[str, str] | None = None, ids: Sequence[str] = (), month_of: str | None = None) -> DataFrame:
    """Drop columns, read dates (bad ones are NULL), clean ids, add the month."""
    out = df.drop(*drop)
    out = out.withColumns({c: parse_date(c, fmt) for c, fmt in (dates or {}).items()})
    out = out.withColumns({c: strip_float_tail(c) for c in ids})
    return out.withColumn("ym", F.date_format(month_of, "yyyy-MM")) if month_of else out
