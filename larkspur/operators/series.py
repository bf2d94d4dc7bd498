"""Time-series operators per entity.

Input is one row per entity and date, so the rows of an entity are bounded by the
calendar and its window fits one task. All operators order by the same key, and
Spark plans one shuffle and one sort for the whole chain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from larkspur.functions.numeric import relative_change


def _over(entity: str | Sequence[str], date: str) -> WindowSpec:
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(date)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row per key in the stated order, as a map-side reducible minimum."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [order, *[c for c in rest if c != order]]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*ordered), F.struct(*ordered)).alias("r"))
    return first.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def forward_fill(df: DataFrame, columns: Sequence[str], entity: str, date: str, leading: float | None = 0.0) -> DataFrame:
    """Carry the last known value forward; what is left at the start becomes ``leading``."""
    w = _over(entity, date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {c: F.last(c, ignorenulls=True).over(w) for c in columns}
    if leading is not None:
        filled = {c: F.coalesce(v, F.lit(leading)) for c, v in filled.items()}
    return df.withColumns(filled)


def weekday_rows(df: DataFrame, date: str, weekday: int, first: str, last: str) -> DataFrame:
    """Rows on one weekday (Monday = 0) of a date range: the closing value of a
    cumulative week."""
    d = F.col(date)
    return df.where((F.weekday(d) == weekday) & d.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def cumulative_to_new(df: DataFrame, columns: Sequence[str], entity: str, date: str, prefix: str = "new_") -> DataFrame:
    """Difference to the previous row; the first row has no previous one and gets 0."""
    w = _over(entity, date)
    return df.withColumns({f"{prefix}{c}": F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0.0)) for c in columns})


def change(
    df: DataFrame, columns: Sequence[str], entity: str, date: str, lag: int = 1, from_zero: float = 1.0, suffix: str = "_wow"
) -> DataFrame:
    """Absolute and relative change against the value ``lag`` rows before."""
    w = _over(entity, date)
    out = {}
    for c in columns:
        prev = F.lag(c, lag).over(w)
        delta = F.col(c) - prev
        out[f"{c}{suffix}"] = F.coalesce(delta, F.lit(0.0))
        out[f"{c}{suffix}_pct"] = relative_change(F.coalesce(delta, F.lit(0.0)), prev, from_zero)
    return df.withColumns(out)


def complete(value: Column, counted: Column, frame: WindowSpec, n: int) -> Column:
    """A frame aggregate, null until the frame has n values."""
    return F.when(F.count(counted).over(frame) == n, value)


def rolling_mean(df: DataFrame, columns: Sequence[str], entity: str | Sequence[str], date: str, n: int, suffix: str) -> DataFrame:
    w = _over(entity, date).rowsBetween(1 - n, Window.currentRow)
    return df.withColumns({f"{c}{suffix}": complete(F.avg(c).over(w), F.col(c), w, n) for c in columns})


def rolling_slope(df: DataFrame, columns: Sequence[str], entity: str, date: str, n: int, suffix: str) -> DataFrame:
    """Least-squares slope per row step over the last n rows."""
    w = _over(entity, date)
    frame = w.rowsBetween(1 - n, Window.currentRow)
    numbered = df.withColumn("__row", F.row_number().over(w).cast("double"))
    out = {
        f"{c}{suffix}": complete(F.regr_slope(F.col(c), F.col("__row")).over(frame), F.col(c), frame, n) for c in columns
    }
    return numbered.withColumns(out).drop("__row")


def rolling_anomaly(df: DataFrame, columns: Sequence[str], entity: str, date: str, n: int, mean_suffix: str, suffix: str) -> DataFrame:
    """Value minus the mean of the n rows that end at the previous row."""
    df = rolling_mean(df, columns, entity, date, n, mean_suffix)
    w = _over(entity, date)
    return df.withColumns({f"{c}{suffix}": F.col(c) - F.lag(f"{c}{mean_suffix}").over(w) for c in columns})


def valid_at(df: DataFrame, asof: str, start: str, end: str) -> DataFrame:
    """Rows of a validity-interval table that hold on a day."""
    return df.where(F.lit(asof).cast("date").between(F.col(start), F.col(end)))


def validity_intervals(changes: DataFrame, entity: str, date: str, last: str = "9999-12-31") -> DataFrame:
    """Each dated row is valid until the day before the next one of its entity."""
    w = _over(entity, date)
    nxt = F.date_sub(F.lead(date).over(w), 1)
    return changes.withColumn("valid_from", F.col(date)).withColumn(
        "valid_to", F.coalesce(nxt, F.lit(last).cast("date"))
    )
