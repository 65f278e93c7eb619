"""Integer date keys (yyyymmdd) and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key_from_month(c) -> Column:
    """yyyymm01 key of the month holding ``c`` (cost facts)."""
    col = _c(c)
    return (F.year(col) * 10000 + F.month(col) * 100 + 1).cast("int")


def date_key_from_day(c) -> Column:
    """yyyymmdd key of the day holding ``c``."""
    col = _c(c)
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def date_key_parts(c) -> dict[str, Column]:
    """y, m, d by integer division of a yyyymmdd key."""
    k = _c(c).cast("int")
    return {"y": F.floor(k / 10000).cast("int"),
            "m": (F.floor(k / 100) % 100).cast("int"),
            "d": (k % 100).cast("int")}


def date_key_to_date(c) -> Column:
    """Lenient yyyymmdd key -> DATE (null when the key is not a real day)."""
    text = F.lpad(_c(c).cast("string"), 8, "0")
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def month_start_of_key(c) -> Column:
    p = date_key_parts(c)
    return F.make_date(p["y"], p["m"], F.lit(1))


def day_floor(c) -> Column:
    return F.date_trunc("day", _c(c))


def month_floor(c) -> Column:
    return F.date_trunc("month", _c(c))


def month_lag(start, end) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (may be negative)."""
    a, b = _c(start), _c(end)
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def day_lag(start, end) -> Column:
    return F.datediff(_c(end), _c(start))
