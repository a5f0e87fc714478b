"""Date and time scalars.

Unix seconds are turned into dates without the session time zone
(``date_from_unix_date(floor(s / 86400))`` is the UTC calendar day), so results
do not depend on the cluster's ``spark.sql.session.timeZone``. Pass
``zone='session'`` to follow the session zone instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions._util import as_col


# Days since 1970-01-01 of 0001-01-01 and 9999-12-31.
FIRST_DAY, LAST_DAY = -719162, 2932896


def seconds_to_date(c, zone: str = "utc") -> Column:
    """Unix seconds -> DATE (D1); NULL outside the years 1 to 9999 (a stray microsecond value must
    not end the job)."""
    c = as_col(c)
    if zone == "utc":
        days = F.floor(c / F.lit(86400))
        return F.when(days.between(FIRST_DAY, LAST_DAY), F.date_from_unix_date(days.try_cast("int")))
    if zone == "session":
        return F.to_date(F.timestamp_seconds(c))
    raise ValueError(f"unknown zone {zone!r}")


def ntz_to_seconds(c) -> Column:
    """TIMESTAMP_NTZ -> Unix seconds, reading the wall clock as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), as_col(c))


def date_key(d) -> Column:
    """Smart key yyyymmdd as int (D9 / F11), by arithmetic rather than string formatting."""
    d = as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(d) -> Column:
    """Monday=1 .. Sunday=7."""
    return (F.weekday(as_col(d)) + 1).cast("int")


def sunday_weekday(d) -> Column:
    """Sunday=1 .. Saturday=7."""
    return F.dayofweek(as_col(d)).cast("int")


def weekday(d, numbering: str = "iso") -> Column:
    return iso_weekday(d) if numbering == "iso" else sunday_weekday(d)


def is_weekend(d) -> Column:
    """Saturday or Sunday (D8); NULL date -> False, as both sources do."""
    return F.coalesce(F.weekday(as_col(d)) >= 5, F.lit(False))


def decade(d) -> Column:
    """1990 for 1999."""
    return (F.floor(F.year(as_col(d)) / 10) * 10).cast("int")


# French month names, January first.
FRENCH_MONTHS = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
                 "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre"]


def month_name(d, names: list[str] = FRENCH_MONTHS) -> Column:
    """Month name from a fixed list."""
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), F.month(as_col(d)))


def run_id(prefix: str = "PL", ts=None) -> Column:
    """``PL_yyyyMMdd_HHmmss`` audit id."""
    ts = F.current_timestamp() if ts is None else as_col(ts)
    return F.concat(F.lit(prefix + "_"), F.date_format(ts, "yyyyMMdd_HHmmss"))
