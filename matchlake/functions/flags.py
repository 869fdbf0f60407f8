"""Derived columns of the conformed layer."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Competition types that count as international.
INTERNATIONAL_TYPES = ("international_cup", "international")
# Text encodings of a won game (compared lower-cased and trimmed).
WIN_TOKENS = ("1", "win", "true", "w")


def full_name(name: Column, first: Column, last: Column) -> Column:
    """``name`` when present, else first and last name joined by a space."""
    return F.coalesce(name, F.concat_ws(" ", first, last))


def is_international(type_: Column) -> Column:
    """True for international competition types, False otherwise (NULL too)."""
    return F.coalesce(type_.isin(*INTERNATIONAL_TYPES), F.lit(False))


def won(is_win: Column, dtype: T.DataType) -> Column:
    """Boolean win flag from either encoding: numeric 0/1 or text ('1', 'win', ...)."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(is_win, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(is_win == 1, F.lit(False))
    return F.coalesce(F.lower(F.trim(is_win)).isin(*WIN_TOKENS), F.lit(False))


def age_in_years(dob: Column, as_of: _dt.date | None = None) -> Column:
    """Calendar-year difference to ``as_of`` (default: the query's current date)."""
    today = F.lit(as_of) if as_of is not None else F.current_date()
    return F.year(today) - F.year(dob)


def stamp(as_of: _dt.datetime | None = None) -> Column:
    """Load-time stamp: a literal when ``as_of`` is given (repeatable), else now."""
    if as_of is None:
        return F.current_timestamp()
    # As text in UTC: a datetime literal would be read in the Python process's time zone.
    utc = as_of.astimezone(_dt.timezone.utc) if as_of.tzinfo else as_of
    return F.lit(utc.strftime("%Y-%m-%d %H:%M:%S.%f") + "+00:00").cast("timestamp")
