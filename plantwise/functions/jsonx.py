"""JSON and text builders for rule messages and metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_object(**fields) -> Column:
    """JSON object text keeping null members (``{"k": null}``)."""
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in fields.items()]), _KEEP_NULLS)


def json_list_or_null(arr) -> Column:
    """An array column, or null when it is empty (SQL ``list`` on no rows)."""
    a = _c(arr)
    return F.when(F.size(a) > 0, a)


def percent_text(x, digits: int = 2) -> Column:
    """``round(x*100, digits) || '%'`` in plain notation (``80.0%``), whatever
    the magnitude."""
    text = F.round(_c(x) * 100, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.concat(F.regexp_replace(text, r"(\.\d+?)0+$", "$1"), F.lit("%"))


def key_text(*cols) -> Column:
    """Composite key text ``a|b``; null when any part is null (not concat_ws)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)
