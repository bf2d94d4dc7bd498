"""Weekly trend panel from cumulative daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.numeric import change_class, relative_change
from larkspur.operators import series

SATURDAY = 5
MEASURES = ("cases", "deaths", "hospitalized", "tested")
WEEKS = 4


def clean_panel(raw: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """One entry per region and day, gaps filled with the last known value."""
    one = series.dedupe_first(raw, ["geo_id", "date"], "entry")
    return series.forward_fill(one, measures, "geo_id", "date", leading=0.0)


def weekly_panel(raw: DataFrame, first: str, last: str, measures: Sequence[str] = MEASURES) -> DataFrame:
    saturdays = series.weekday_rows(clean_panel(raw, measures), "date", SATURDAY, first, last)
    return series.cumulative_to_new(saturdays, measures, "geo_id", "date")


def trend_panel(raw: DataFrame, first: str, last: str, measures: Sequence[str] = MEASURES) -> DataFrame:
    """New values per week with week-over-week change, four-week slope and the
    distance to the mean of the four weeks before."""
    new = [f"new_{m}" for m in measures]
    out = weekly_panel(raw, first, last, measures)
    out = series.change(out, new, "geo_id", "date")
    out = series.rolling_slope(out, new, "geo_id", "date", WEEKS, "_4w_linear")
    return series.rolling_anomaly(out, new, "geo_id", "date", WEEKS, "_4w_ma", "_anomaly")


def simple_change(df: DataFrame, column: str, entity: str, date: str, from_zero: float, out: str) -> DataFrame:
    """The older rule: relative change only, with its own value for x/0, and the
    change class."""
    prev = F.lag(column).over(Window.partitionBy(entity).orderBy(date))
    df = df.withColumn(out, relative_change(F.col(column) - prev, prev, from_zero))
    return df.withColumn(f"{out}_class", change_class(F.col(out)))
