"""Column expressions (all JVM-side built-ins, no UDFs)."""

from .calendar import calendar_columns, date_key
from .flags import age_in_years, full_name, is_international, stamp, won

__all__ = ["date_key", "calendar_columns", "full_name", "is_international", "won",
           "age_in_years", "stamp"]
