"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from roadbook.functions.coords import decimal_places, in_box, point_in_polygon, point_struct, point_wkt
from roadbook.functions.dates import first_weekday_in_month, safe_date, to_int_code
from roadbook.functions.numeric import is_true, not_equal_or_missing, to_number

__all__ = [
    "to_number", "is_true", "not_equal_or_missing", "to_int_code", "safe_date",
    "first_weekday_in_month", "in_box", "decimal_places", "point_in_polygon",
    "point_struct", "point_wkt",
]
