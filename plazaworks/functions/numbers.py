"""Number helpers: repairs, clamps, fees, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sem import col, safe_cast, safe_divide


def decimal_comma(c, dtype: str = "double") -> Column:
    """Read ``'1,5'`` as 1.5; NULL where it is no number."""
    return safe_cast(F.regexp_replace(col(c).cast("string"), ",", "."), dtype)


def repair_coordinate(c) -> Column:
    """Put back the decimal point a spreadsheet dropped.

    A degree written with ``n`` signs (4..20, the minus counts) is divided by
    ``10^(n-3)``; other lengths are read as they stand.
    """
    s = col(c).cast("string")
    value, n = safe_cast(s, "double"), F.length(s)
    return F.when(n.between(4, 20), value / F.pow(F.lit(10.0), n - F.lit(3))).otherwise(value)


def cap(value, limit) -> Column:
    """``value`` but no more than ``limit``; a missing limit does not bind."""
    value, limit = col(value), col(limit)
    return F.when(value > limit, limit).otherwise(value)


def cap_outflow(outflow, limit) -> Column:
    """Negative amount held within ``-limit``."""
    outflow, limit = col(outflow), col(limit)
    return F.when(F.abs(outflow) > limit, -limit).otherwise(outflow)


def whole_units(refund, unit_price) -> Column:
    """Refund rounded up to whole units when it is not a multiple of the price."""
    refund, unit_price = col(refund), col(unit_price)
    units = safe_divide(refund, unit_price)
    return F.round(F.when(units != F.ceil(units), F.ceil(units) * unit_price).otherwise(refund), 2)


def nearest_units(units) -> Column:
    """Nearest whole unit, halves away from the floor."""
    units = col(units)
    return F.when(units - F.floor(units) < 0.5, F.floor(units)).otherwise(F.ceil(units))


TAX = 1.18  # fixed value: gross price over net price


def commission_split(amount, rate) -> dict[str, Column]:
    """Commission with tax, without tax, and what is left for the seller."""
    fee = col(amount) * col(rate)
    return {"commission": fee, "commission_net_of_tax": fee / F.lit(TAX), "net": col(amount) - fee}


def percent_text(c) -> Column:
    """0.1234 -> '12.34%'."""
    return F.format_string("%.2f%%", col(c) * 100)


def money_from_cents(cents, fraction) -> Column:
    """Amount kept as integer cents and the fraction of a unit they count."""
    return safe_divide(safe_cast(cents, "bigint"), safe_cast(fraction, "bigint"))


def round_half_even(c, scale: int = 0) -> Column:
    """Banker's rounding, as data frames on one machine round."""
    return F.bround(col(c), scale)


def sign_type(c, positive: str = "Ingreso", negative: str = "Egreso") -> Column:
    return F.when(col(c) >= 0, positive).otherwise(negative)
