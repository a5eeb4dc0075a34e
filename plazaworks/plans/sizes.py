"""Size class of a product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..operators.quality import winsorize, zscore_filter
from ..operators.rules import case_first

ORDINAL = {s: i for i, s in enumerate(vocab.SIZES)}


def ordinal(size: str | Column) -> Column:
    """Position of a size class; unknown classes are NULL."""
    c = F.col(size) if isinstance(size, str) else size
    at = F.array_position(F.array(*[F.lit(s) for s in vocab.SIZES]), c)
    return F.when(at > 0, (at - 1).cast("int"))


def size_name(position: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in vocab.SIZES]), position)


def size_by(measure: str, value: str | Column, ranges=vocab.SIZE_RANGES) -> Column:
    """Position of the first class whose range holds the value; the smallest class otherwise.

    The ranges are laid out as steps, so each value is compared once per edge.
    """
    v = F.col(value) if isinstance(value, str) else value
    table = ranges[measure]
    edges = sorted({e for r in table.values() for e in r})
    steps = [(v < edges[0], 0)]
    for lo, hi in zip(edges, edges[1:]):
        steps.append((v < hi, next((ORDINAL[s] for s, (a, b) in table.items() if a <= lo and hi <= b), 0)))
    return case_first(steps, 0)


def tv_class(size: Column, category: str, inches: str) -> Column:
    """Class of a television by its screen; small classes stay."""
    x = F.col(inches)
    rules = []
    for i, (label, lo, hi) in enumerate(vocab.TV_INCHES):
        rules.append((((x >= lo) if i == 0 else (x > lo)) & (x <= hi), label))
    screen = F.when(F.col(category) == vocab.TV_CATEGORY, case_first(rules))
    return F.when(screen.isNotNull() & ~size.isin(*vocab.TV_KEEP), screen).otherwise(size)


def assign_size(df: DataFrame, corrected: str | None = "new_item_size") -> DataFrame:
    """Class from weight, volume and length, held down by the declared class.

    df: width, length, height (metres for the volume, as stored), weight, size,
    category_code, dimension_quantity.  The longer side becomes the length.  The
    largest of the three classes is kept unless the declared one is smaller;
    televisions follow their screen; an already corrected class wins.
    """
    out = df.withColumns({"length": F.greatest("length", "width"), "width": F.least("length", "width")})
    out = out.withColumn("volume_m3", F.col("width") * F.col("length") * F.col("height"))
    largest = F.greatest(size_by("weight", "weight"), size_by("volume_m3", "volume_m3"), size_by("length", "length"))
    out = out.withColumn("_p", largest)
    out = out.withColumns({"max_size": size_name(F.col("_p")), "size": size_name(F.least("_p", ordinal("size")))}).drop("_p")
    out = out.withColumn("size", tv_class(F.col("size"), "category_code", "dimension_quantity"))
    if corrected:
        out = out.withColumn("size", F.coalesce(F.col(corrected), "size"))
    return out


def handle_outliers(df: DataFrame, group: str, cols: Sequence[str], mode: str = "remove", tail: float = 0.03) -> DataFrame:
    """Remove rows beyond three deviations of their category, or pull the tails in."""
    if mode == "remove":
        return zscore_filter(df, [group], cols)
    if mode == "winsorize":
        return winsorize(df, [group], cols, tail)
    raise ValueError(f"unknown mode {mode!r}")
