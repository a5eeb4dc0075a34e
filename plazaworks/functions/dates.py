"""Date helpers.  The run time is always a parameter, never the clock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sem import col, regexp_extract_n

LOCAL_ZONE = "America/Lima"  # fixed value: civil time of the reports


def to_local(ts, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant -> civil time of ``zone`` without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(ts).cast("timestamp_ntz"))


def minus_five_hours(ts) -> Column:
    """Fixed five-hour shift used for stored UTC columns."""
    return col(ts) - F.expr("INTERVAL 5 HOURS")


def as_date(value) -> Column:
    """Literal date from ``'yyyy-MM-dd'`` text, or any column as a date."""
    return F.lit(value).cast("date") if isinstance(value, str) else value.cast("date")


def days_between(later, earlier) -> Column:
    return F.datediff(col(later), col(earlier))


def months_crossed(later, earlier) -> Column:
    """Month boundaries between two dates (31 Jan -> 1 Feb is 1)."""
    a, b = col(later), col(earlier)
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)


def hours_crossed(later, earlier) -> Column:
    """Hour boundaries between two civil times (10:50 -> 11:10 is 1)."""
    a, b = F.date_trunc("hour", col(later)), F.date_trunc("hour", col(earlier))
    return F.timestamp_diff("HOUR", b, a)


def whole_hours(later, earlier) -> Column:
    """Complete hours between two instants (10:50 -> 11:10 is 0)."""
    return F.timestamp_diff("HOUR", col(earlier), col(later))


def week_from_sunday(d) -> Column:
    """Week of the year, weeks start on Sunday, days before the first are week 0."""
    d = col(d)
    return F.floor((F.dayofyear(d) - F.dayofweek(d) + 7) / 7).cast("int")


def period_label(d) -> Column:
    """``yyyy-MM``; NULL for a missing date."""
    return F.date_format(col(d), "yyyy-MM")


def settlement_week(d) -> Column:
    """``yyyymmdd-yyyymmdd`` label of the Monday-to-Sunday week of a date."""
    start = F.date_trunc("week", col(d)).cast("date")
    return F.concat_ws("-", F.date_format(start, "yyyyMMdd"), F.date_format(F.date_add(start, 6), "yyyyMMdd"))


def parse_date(c, fmt: str = "d/M/yyyy", strict: bool = False) -> Column:
    """Parse a date; strict raises on bad text, otherwise bad text is NULL."""
    return F.to_date(col(c), fmt) if strict else F.try_to_date(col(c), fmt)


def parse_timestamp(c, fmt: str, strict: bool = False) -> Column:
    """Parse a civil time; strict raises on bad text, otherwise bad text is NULL."""
    parsed = F.to_timestamp(col(c), fmt) if strict else F.try_to_timestamp(col(c), F.lit(fmt))
    return parsed.cast("timestamp_ntz")


# Texts that mean "no date" in hand-kept sheets.
DATE_SENTINELS = ("0/01/1900", "#N/A")


def repair_mdy(c, sentinels: Sequence[str] = DATE_SENTINELS, min_len: int = 8) -> Column:
    """Date from hand-typed ``m/d/y`` text.

    Sentinels and texts under ``min_len`` are NULL, a swallowed slash
    (``72024``) is put back, two-digit years are of this century, day and month
    get their zero, and impossible dates are NULL.
    """
    s = col(c)
    s = F.when(~s.isin(list(sentinels)) & (F.length(s) >= min_len), F.regexp_replace(s, "72024", "/2024"))
    parts = F.split(s, "/")
    month, day = F.lpad(F.get(parts, F.lit(0)), 2, "0"), F.lpad(F.get(parts, F.lit(1)), 2, "0")
    year = regexp_extract_n(s, "([^/]+)$")
    year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    return F.try_to_date(F.concat_ws("/", day, month, year), "dd/MM/yyyy")


def cutoff(as_of: str, hour: int = 22) -> datetime:
    """Cut-off of a report run on ``as_of``: the evening before."""
    return datetime.fromisoformat(as_of) - timedelta(days=1) + timedelta(hours=hour)


def reporting_window(as_of: str, slot: str = "am") -> tuple[datetime, datetime]:
    """Half-open window ``[start, end)`` that a slot reports.

    ``am`` covers 18:00 of the day before (Friday when run on Monday) to 08:00;
    ``pm`` covers 08:00 to 18:00 of the same day.
    """
    day = datetime.fromisoformat(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    if slot == "pm":
        return day + timedelta(hours=8), day + timedelta(hours=18)
    back = 3 if day.weekday() == 0 else 1
    return day - timedelta(days=back) + timedelta(hours=18), day + timedelta(hours=8)


def within(c, window: tuple[datetime, datetime]) -> Column:
    """True inside a half-open window; a plain range, so it reaches the scan."""
    start, end = window
    c = col(c)
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))


def days_ago(d, as_of: str, k: int) -> Column:
    """True for rows dated exactly ``k`` days before ``as_of``."""
    return F.datediff(as_date(as_of), col(d)) == k


def work_time(later, earlier, start_hour: int = 9, end_hour: int = 18, days: Sequence[int] = (1, 2, 3, 4, 5)) -> Column:
    """Struct (working_seconds, working_days, hours) between two instants.

    ``days`` are weekday numbers, 1 is Sunday.  Each instant is moved into the
    day's working span; full working days between count whole spans.  ``hours``
    are plain clock hours, which is what the reports show.
    """
    span = end_hour - start_hour

    def into_span(ts: Column) -> Column:
        midnight = F.date_trunc("day", ts)
        shifted = ts - F.expr(f"INTERVAL {start_hour} HOURS")
        return F.least(F.greatest(shifted, midnight), midnight + F.expr(f"INTERVAL {span} HOURS"))

    x, y = into_span(col(later)), into_span(col(earlier))
    sunday = lambda d: F.date_sub(d.cast("date"), F.dayofweek(d) - F.lit(1))
    weeks = F.datediff(sunday(x), sunday(y)) / 7
    upto = lambda d: sum((F.when(F.lit(k) <= F.dayofweek(d), 1).otherwise(0) for k in days), F.lit(0))
    work_days = (weeks * len(days)).cast("bigint") + upto(x) - upto(y)
    second_of_day = lambda t: F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    seconds = work_days * span * 3600 + (second_of_day(x) - second_of_day(y))
    return F.struct(
        seconds.cast("bigint").alias("working_seconds"),
        work_days.cast("bigint").alias("working_days"),
        whole_hours(later, earlier).alias("hours"),
    )
