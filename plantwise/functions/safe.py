"""Null-safe arithmetic and lenient parsing.

Spark 4 runs with ANSI semantics: a plain ``cast`` of bad text or a division
by zero raises.  The source systems treat both as missing, so every lenient
spot goes through these helpers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slash layouts that the lenient parser takes besides ISO text: year first or
# month first, each with or without a time to the second.
_TIME = r"( \d{2}:\d{2}:\d{2})?$"
SLASH_LAYOUTS = (
    (r"^(\d{4})/(\d{2})/(\d{2})" + _TIME, "$1-$2-$3$4"),
    (r"^(\d{2})/(\d{2})/(\d{4})" + _TIME, "$3-$1-$2$4"),
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)``: null when the divisor is null or zero."""
    return F.try_divide(_c(num), _c(den))


def lenient_double(c, fill: float | None = None) -> Column:
    """Numeric parse where bad text becomes null (optionally a fill value)."""
    v = _c(c).cast("string").try_cast("double")
    return F.coalesce(v, F.lit(float(fill))) if fill is not None else v


def lenient_long(c, fill: int | None = None) -> Column:
    """Numeric parse, then truncation toward zero (pandas ``astype(int)``)."""
    d = lenient_double(c)
    v = F.when(F.isnan(d), None).otherwise(d).try_cast("long")
    return F.coalesce(v, F.lit(int(fill))) if fill is not None else v


def lenient_timestamp(c) -> Column:
    """Parse text into a wall-clock ``timestamp_ntz``; unparseable text is null.

    The layout is told by its shape, slash dates are respelled as ISO text, and
    one ``try_cast`` to ``timestamp_ntz`` parses: no time zone is involved, so
    the result does not depend on the session zone.
    """
    s = F.trim(_c(c).cast("string"))
    iso = None
    for shape, spelling in SLASH_LAYOUTS:
        iso = (F if iso is None else iso).when(s.rlike(shape), F.regexp_replace(s, shape, spelling))
    return iso.otherwise(s).try_cast("timestamp_ntz")


def clip(c, lo=None, hi=None) -> Column:
    """Clip to [lo, hi] keeping null (``greatest(null, 0)`` would be 0)."""
    col = _c(c)
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(col.isNotNull(), out)
