"""Numeric rules: ratios, caps, bins, changes, losses."""

from __future__ import annotations

import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """Null where the denominator is zero (ANSI division would raise)."""
    return F.try_divide(num, den)


def ratio_or(num: Column, den: Column, default: float) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(float(default)))


def cap(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip to fixed bounds; a null stays null (least/greatest would skip it)."""
    out = col
    if high is not None:
        out = F.when(col > high, F.lit(high)).otherwise(out)
    if low is not None:
        out = F.when(col < low, F.lit(low)).otherwise(out)
    return out


def presence_flag(col: Column) -> Column:
    """1 when the value is above zero. A recency of 0 counts as absent."""
    return F.when(F.coalesce(col, F.lit(0)) > 0, 1).otherwise(0)


def cut_right_closed(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edges[i], edges[i+1]] holding the value, else null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        out = F.when((col > float(low)) & (col <= float(high)), F.lit(label)).otherwise(out)
    return out


# Edges and labels of the week-over-week classes.
CHANGE_EDGES = (-1, -0.5, -0.05, 0.05, 0.5, 1, 99999)
CHANGE_LABELS = ("-100% to -50%", "-50% to -5%", "no change", "5% to 50%", "50% to 100%", "100%+")


def change_class(col: Column) -> Column:
    return cut_right_closed(col, CHANGE_EDGES, CHANGE_LABELS)


def relative_change(delta: Column, prev: Column, from_zero: float) -> Column:
    """delta / prev, with 0/0 or a missing side as 0 and x/0 as ``from_zero``."""
    return (
        F.when(delta.isNull() | prev.isNull(), F.lit(0.0))
        .when((prev == 0) & (delta == 0), F.lit(0.0))
        .when(prev == 0, F.lit(float(from_zero)))
        .otherwise(F.try_divide(delta, prev))
    )


def log_loss(label: Column, prob: Column) -> Column:
    """-log of the probability given to what happened.

    Null where that probability is 0 (``log`` of 0 is null), so such a row drops
    out of an average.
    """
    return F.when(label == 1, -F.log(prob)).otherwise(-F.log(F.lit(1.0) - prob))


def hard_class(prob: Column) -> Column:
    """0/1 decision; one half rounds up."""
    return F.round(prob, 0).cast("int")


def rounded(col: Column, places: int = 6) -> Column:
    return F.round(col.cast("double"), places)


def with_sortable(df: DataFrame, value: str, out: str) -> DataFrame:
    """Adds a finite or infinite double as a whole number that sorts like it: the bits of its
    magnitude, negated below zero. Computed exactly from exponent and mantissa, in steps, so that
    every logarithm and power is taken once; null stays null, and NaN becomes null."""
    a, e, p, r = (F.col(f"__{c}") for c in "aepr")
    df = df.withColumn("__a", F.when(~F.isnan(value), F.abs(value))).withColumn("__e", F.least(F.greatest(F.floor(F.log2(a)), F.lit(-1022)), F.lit(1023)))
    df = df.withColumn("__p", F.pow(F.lit(2.0), e.cast("double"))).withColumn("__r", a / p)
    # the logarithm may miss by one next to a power of two, and then the ratio leaves [1, 2)
    exponent = F.when((r < 1) & (e > -1022), e - 1).when(r >= 2, e + 1).otherwise(e)
    mantissa = F.when((r < 1) & (e > -1022), r * 2).when(r >= 2, r / 2).otherwise(r) - 1
    bits = (
        F.when(a == 0, F.lit(0).cast("long"))
        .when(a == float("inf"), F.lit(2047 << 52))
        .when(a < 2.0**-1022, (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("long"))
        .otherwise((exponent + 1023) * F.lit(1 << 52) + (mantissa * F.lit(2.0**52)).cast("long"))
    )
    df = df.withColumn("__b", bits).withColumn(out, F.when(F.col(value) < 0, -F.col("__b")).otherwise(F.col("__b")))
    return df.drop("__a", "__e", "__p", "__r", "__b")


def from_sortable(image: int) -> float:
    """The double of a sortable number; beyond the largest ones infinity."""
    size = struct.unpack(">d", struct.pack(">q", min(abs(image), 2047 << 52)))[0]
    return -size if image < 0 else size
