"""Calendar expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def months_before(asof: str | dt.date, months: int) -> Column:
    return F.add_months(as_date(asof), -months)


def days_before(asof: str | dt.date, days: int) -> Column:
    return F.date_sub(as_date(asof), days)


def quarter_year(col: Column) -> Column:
    """Quarter label joined to the year, such as ``Q32000``."""
    return F.concat(F.lit("Q"), F.quarter(col).cast("string"), F.year(col).cast("string"))


def quarter_bit(col: Column, asof: str | dt.date) -> Column:
    """A bit per calendar quarter counted back from the as-of day (up to 62 back).
    Or-ing the bits and counting them gives the distinct quarters in one
    aggregate buffer, without a shuffle per distinct value."""
    number = lambda d: F.year(d) * 4 + F.quarter(d)
    return F.call_function("shiftleft", F.lit(1).cast("long"), number(as_date(asof)) - number(col))


def is_weekend(col: Column) -> Column:
    return F.when(F.weekday(col) >= 5, 1.0).otherwise(0.0)


def date_features(col: Column, prefix: str) -> list[Column]:
    """Six calendar features of one date."""
    return [
        F.dayofmonth(col).alias(f"{prefix}_dayofmonth"),
        F.dayofyear(col).alias(f"{prefix}_dayofyear"),
        F.weekday(col).alias(f"{prefix}_dayofweek"),
        F.weekofyear(col).alias(f"{prefix}_weekofyear"),
        F.month(col).alias(f"{prefix}_month"),
        is_weekend(col).alias(f"{prefix}_is_weekend"),
    ]


def ladder(col: Column, steps: Sequence[tuple[object, str]], otherwise: str | None) -> Column:
    """First label whose bound is at or above the value."""
    out = F.lit(otherwise)
    for bound, label in reversed(list(steps)):
        limit = as_date(bound) if isinstance(bound, dt.date) else F.lit(bound)
        out = F.when(col <= limit, F.lit(label)).otherwise(out)
    return out


# Days-until classes as (upper bound, label).
DAYS_UNTIL_STEPS = (
    (30, "1. 1-30 days"),
    (60, "2. 31-60 days"),
    (90, "3. 61-90 days"),
    (120, "4. 91-120 days"),
    (180, "5. 121-180 days"),
)
DAYS_UNTIL_LAST = "6. 181-365 days"


def days_until_bucket(days: Column) -> Column:
    return ladder(days, DAYS_UNTIL_STEPS, DAYS_UNTIL_LAST)
