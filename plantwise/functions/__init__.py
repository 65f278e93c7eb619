"""Column expressions shared by the operators (all JVM-side, codegen-able)."""

from plantwise.functions.safe import (  # noqa: F401
    clip, lenient_double, lenient_long, lenient_timestamp, ratio,
)
from plantwise.functions.dates import (  # noqa: F401
    date_key_from_day, date_key_from_month, date_key_parts, date_key_to_date,
    day_floor, day_lag, month_floor, month_lag,
)
from plantwise.functions.jsonx import (  # noqa: F401
    json_list_or_null, json_object, key_text, percent_text,
)
