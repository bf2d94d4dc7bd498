"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 1e-3) -> DataFrame:
    """Keys holding at least ``share`` of the rows, with the number of slices
    their rows need. There are at most 1/share of them."""
    counts = df.groupBy(*on).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    limit = F.greatest(F.ceil(total * share), F.lit(2))
    return counts.where(F.col("__n") >= limit).select(*on, F.ceil(F.col("__n") / limit).cast("int").alias("__slices"))


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Column,
    how: str = "inner",
    share: float = 1e-3,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join where the hot keys of ``left`` are cut into slices.

    ``spread`` is any expression that differs among the rows of one key. Rows of
    a hot key are dealt over its slices, and the matching right rows are repeated
    once per slice. Cold keys have one slice and are not repeated. The list of hot
    keys has a proven bound (1/share rows), which is why it may be broadcast; a
    caller that knows the hot keys passes them with their ``__slices``.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep their meaning when the right side is repeated")
    on = list(on)
    hot = hot_keys(left, on, share) if hot is None else hot
    slices = F.coalesce("__slices", F.lit(1))
    lhs = left.join(F.broadcast(hot), on, "left").withColumn("__slice", F.pmod(F.xxhash64(spread), slices).cast("int"))
    rhs = right.join(F.broadcast(hot), on, "left").withColumn("__slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    return lhs.drop("__slices").join(rhs.drop("__slices"), [*on, "__slice"], how).drop("__slice")


def left_flagged(left: DataFrame, right: DataFrame, on: str, fill: dict[str, object]) -> DataFrame:
    """Left join on a key that is unique on the right; misses take stated values."""
    return left.join(right, on, "left").na.fill(fill)


def full_compare(a: DataFrame, b: DataFrame, on: Sequence[str], a_suffix: str, b_suffix: str) -> DataFrame:
    """Full outer join on the keys with both versions of every column, distinct.

    Repeated rows go out before the join: all columns are kept, so that gives the
    same rows, and a side already laid out by the key needs no further shuffle.
    """
    on = list(on)
    mark = [F.col(k).alias(f"__{k}") for k in on]
    left = a.distinct().select(*mark, *[F.col(c).alias(f"{c}{a_suffix}") for c in a.columns])
    right = b.distinct().select(*mark, *[F.col(c).alias(f"{c}{b_suffix}") for c in b.columns])
    return left.join(right, [f"__{k}" for k in on], "full").drop(*[f"__{k}" for k in on])


def align_schema(df: DataFrame, expected: Sequence[tuple[str, str]]) -> DataFrame:
    """Expected columns in order; a missing one is added as null."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in expected])


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in set(df.columns)]


def union_latest(frames: Sequence[DataFrame], keys: Sequence[str], date: str) -> DataFrame:
    """Union of maps reduced to the latest date per key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy(*keys).agg(F.max(date).alias(date))
