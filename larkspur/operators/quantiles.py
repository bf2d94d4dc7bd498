"""Exact quantiles by radix selection, without gathering a column or a group in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.numeric import from_sortable, with_sortable
from larkspur.session import saved

CELLS = 1 << 16  # cells that a round cuts a wanted cell into
MOST = 1_000_000  # distinct values that one task orders at most


def _prefix(shift: int) -> Column:
    return F.shiftright("image", shift)


TARGETS = "array<struct<prob: double, place: double, rank: long>>"


def _wanted(total: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Per group the ranks that its quantiles need; nothing is known to lie before its only cell."""
    place = lambda p: (F.col("n") - 1) * F.lit(float(p))
    rank = lambda p, f: F.struct(F.lit(float(p)).alias("prob"), place(p).alias("place"), f(place(p)).alias("rank"))
    targets = F.array_distinct(F.array(*[rank(p, f) for p in probs for f in (F.floor, F.ceil)]))
    return total.select("g", F.lit(0).cast("long").alias("before"), targets.alias("targets"))


def _closer(counts: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """Cells of the wanted cells that hold a wanted rank, with the rows before them."""
    inside = Window.partitionBy(*on).orderBy("cell")
    upto = F.col("before") + F.sum("n").over(inside)
    held = lambda t: (t["rank"] >= F.col("upto") - F.col("n")) & (t["rank"] < F.col("upto"))
    out = counts.join(wanted, on).withColumn("upto", upto)
    out = out.withColumn("targets", F.filter("targets", held)).where(F.size("targets") > 0)
    return out.select("g", "cell", (F.col("upto") - F.col("n")).alias("before"), "targets", "m")


def _by_key(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str], digits: int, most: int) -> DataFrame:
    """Values and wanted ranks per group: rows are reduced to the values of each group first."""
    flat = df.select(*keys, F.explode(F.array(*[_cell(i, c) for i, c in enumerate(columns)])).alias("c")).where(_number("c.value"))
    g = F.struct(*keys, F.col("c.column").alias("__column")).alias("g")
    values = flat.groupBy(g, F.col("c.value").alias("value")).agg(F.count("*").alias("n"))
    rows = saved(with_sortable(values, "value", "image"), "values")
    shift, hits, open_, wanted, on = 64, [], rows, None, ["g"]
    while True:
        shift = max(0, shift - digits)
        counts = open_.groupBy(*on, _prefix(shift).alias("cell")).agg(F.sum("n").alias("n"), F.count("*").alias("m"))
        if wanted is None:
            wanted = _wanted(rows.groupBy("g").agg(F.sum("n").alias("n")), probs)
        found = saved(_closer(counts, wanted, on), "wanted")
        small = F.col("m") <= most if shift else F.lit(True)
        cells = found.where(small)
        held = rows.withColumn("cell", _prefix(shift)).join(cells.select("g", "cell"), ["g", "cell"], "left_semi")
        hits.append(_hits(held, cells, ["g", "cell"]))
        rest = found.where(~small)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, hits)
        wanted, on = rest.withColumnRenamed("cell", "parent").drop("m"), ["g", "parent"]
        open_ = rows.withColumn("parent", _prefix(shift)).join(wanted.select(*on), on, "left_semi")


def _number(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.isNotNull() & ~F.isnan(value)


def _cell(i: int, c: str) -> Column:
    return F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value"))


def _whole(df: DataFrame, columns: Sequence[str], probs: Sequence[float], digits: int, most: int) -> DataFrame:
    """The same without keys. A round counts at most 2^digits cells per column, and later per wanted cell, of which
    there are two per column and probability; the driver places the ranks. A wanted cell is an
    interval, so all other rows are filtered out by plain comparisons."""
    spark, shift = df.sparkSession, 64
    small: list[tuple[int, int, float, float, int, list]] = []  # column, number of the cell, bounds, rows before, ranks
    open_ = {(i, 0): (-math.inf, math.inf, 0, None) for i in range(len(columns))}
    while open_:
        shift = max(0, shift - digits)
        rows = with_sortable(_inside(df, columns, [(i, c, *b[:2]) for (i, c), b in open_.items()]), "value", "image")
        counts: dict[tuple[int, int], list] = {}
        for i, c, cell, n in rows.groupBy("column", "cell", _prefix(shift).alias("next")).agg(F.count("*")).collect():
            counts.setdefault((i, c), []).append((cell, n))
        rest = {}
        for (i, c), cells in counts.items():
            _, _, before, targets = open_[i, c]
            if targets is None:
                last = sum(n for _, n in cells) - 1
                targets = sorted({(float(p), last * float(p), f(last * float(p))) for p in probs for f in (math.floor, math.ceil)})
            for cell, n in sorted(cells):
                held = [t for t in targets if before <= t[2] < before + n]
                low, high = from_sortable(cell << shift), from_sortable((cell + 1 << shift) - 1)
                if held and shift and n > most:
                    rest[i, len(rest)] = (low, high, before, held)
                elif held:
                    small.append((i, len(small), low, high, before, held))
                before += n
        open_ = rest
    cells = spark.createDataFrame([(i, c, before, held) for i, c, _, _, before, held in small], f"column int, cell int, before long, targets {TARGETS}")
    rows = _inside(df, columns, [s[:4] for s in small]).withColumn("n", F.lit(1).cast("long"))
    return _hits(rows.withColumn("g", F.struct(F.col("column").alias("__column"))), cells, ["column", "cell"], F.broadcast)


def _inside(df: DataFrame, columns: Sequence[str], cells: list[tuple[int, int, float, float]]) -> DataFrame:
    """(column, cell, value) of the values that lie in an interval of their column; intervals do not overlap."""
    out, any_ = [], F.lit(False)
    for i, c in enumerate(columns):
        value, place = F.col(c).cast("double"), F.lit(None).cast("int")
        for column, cell, low, high in cells:
            if column == i:
                inside = _number(value) if (low, high) == (-math.inf, math.inf) else value.between(low, high)
                place, any_ = F.when(inside, cell).otherwise(place), any_ | inside
        out.append(F.struct(F.lit(i).alias("column"), place.alias("cell"), value.alias("value")))
    rows = df.select(*columns).where(any_).select(F.explode(F.array(*out)).alias("c")).select("c.*")
    return rows.where(F.col("cell").isNotNull())


def _hits(rows: DataFrame, cells: DataFrame, on: list[str], near=lambda t: t) -> DataFrame:
    """(g, t, value) for every wanted rank ``t`` of the cells, from their ordered distinct values."""
    values = rows.groupBy("g", *[c for c in on if c != "g"], "value").agg(F.sum("n").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*on).orderBy("value"))
    out = values.join(near(cells), on).withColumn("upto", upto).withColumn("t", F.explode("targets"))
    return out.where((F.col("t.rank") < F.col("upto")) & (F.col("t.rank") >= F.col("upto") - F.col("n"))).select("g", "t", "value")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), bins: int = CELLS, most: int = MOST
) -> DataFrame:
    """(keys, column, prob, value) with linear interpolation between neighbours.

    A double is seen as a sortable 64-bit number. A round counts rows per leading digits (``bins`` values,
    a power of two), which places each wanted rank in a cell, and only the wanted cells are looked at again,
    by their next digits, until they hold at most ``most`` distinct values (without keys: rows) or one. Those
    values are then ordered, a cell per task at most. Rows outside wanted cells are never shuffled when there are no
    keys. With keys, rows are first reduced to the values of each group, spread over all tasks.
    """
    digits = bins.bit_length() - 1
    if bins != 1 << digits or not digits:
        raise ValueError("the number of cells must be a power of two")
    hits = _by_key(df, columns, probs, keys, digits, most) if keys else _whole(df, columns, probs, digits, most)
    ends = hits.groupBy("g", F.col("t.prob").alias("prob"), F.col("t.place").alias("place")).agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    # two equal infinities have no difference
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - F.floor("place"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return ends.select(*[F.col("g")[k].alias(k) for k in keys], names[F.col("g")["__column"]].alias("column"), "prob", value.alias("value"))


def median_by(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """(keys, median)."""
    return exact_quantiles(df, [column], [0.5], keys).select(*keys, F.col("value").alias("median"))


QUARTILES = (0.25, 0.5, 0.75)
MOMENTS = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def describe(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max; a row per column."""
    group = [*keys, "column"]
    quart = (
        exact_quantiles(df, columns, QUARTILES, keys)
        .groupBy(*group)
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in QUARTILES])
    )
    one = df.groupBy(*keys).agg(
        *[
            f(F.col(c).cast("double")).alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, f in MOMENTS.items()
        ]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in MOMENTS])
        for i, c in enumerate(columns)
    ]
    moments = one.select(*keys, F.explode(F.array(*rows)).alias("c")).select(*keys, "c.*")
    joined = moments.alias("m").join(
        quart.alias("q"), reduce(and_, [F.col(f"m.{c}").eqNullSafe(F.col(f"q.{c}")) for c in group]), "left"
    )
    return joined.select(
        *[F.col(f"m.{c}").alias(c) for c in group], "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )
