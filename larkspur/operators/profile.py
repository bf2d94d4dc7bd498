"""Table profiles: counts, nulls, frequencies, histograms, cross-tabs."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.numeric import with_sortable


def _rows(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, non-null and distinct counts and a unique-key flag per column.

    Each column is reduced to its distinct values, in its own type, and these are counted, so no
    task holds the value set of a column and a columnar file is read once in all, a column at
    a time. A frame that is dear to compute is best written first.
    """
    types = dict(df.dtypes)
    out = None
    for c in columns or df.columns:
        values = df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
        there = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
        one = values.agg(F.sum("n").alias("rows"), F.sum(there).alias("non_null"), F.count("value").alias("distinct_values"))
        one = one.na.fill(0).select(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), "*")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("is_key", (F.col("distinct_values") == F.col("rows")).cast("int"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and share per column in one pass."""
    columns = list(columns or df.columns)
    one = df.agg(
        F.count("*").alias("__n"), *[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in columns]
    )
    return _rows(
        one,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).cast("long").alias("nulls"),
                F.try_divide(F.col(c), F.col("__n")).alias("null_share"),
            )
            for c in columns
        ],
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """k most frequent values, ties by value."""
    return value_counts(df.where(F.col(column).isNotNull()), column).orderBy(F.desc("n"), column).limit(k)


def mode_smallest(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per column, the smallest on a tie. Values are counted across all
    tasks first; the pick is by one number of fixed width, the count before the sortable
    image of the value, so it stays in the hash aggregate."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = (
        df.select(*keys, F.explode(cells).alias("c"))
        .select(*keys, "c.*")
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "column", "value")
        .agg(F.count("*").alias("n"))
    )
    last = F.when(F.isnan("value"), F.lit((1 << 63) - 1)).otherwise(F.col("__image"))  # NaN after all numbers
    order = F.col("n").cast("decimal(18,0)") * F.lit(Decimal(1 << 64)) - last.cast("decimal(20,0)")
    counts = with_sortable(counts, "value", "__image")
    return counts.groupBy(*keys, "column").agg(F.max_by("value", order).alias("mode"), F.max("n").alias("n"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between min and max, the last one closed on the right."""
    value = F.col(column).cast("double")
    box = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = box.select("lo").scalar(), box.select("hi").scalar()
    width = (hi - lo) / bins
    bin_no = F.when(width == 0, 0).otherwise(F.least(F.floor((value - lo) / width), F.lit(bins - 1))).cast("int")
    return (
        df.where(value.isNotNull())
        .select(bin_no.alias("bin"), lo.alias("lo"), width.alias("width"))
        .groupBy("bin", "lo", "width")
        .agg(F.count("*").alias("n"))
        .select("bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"), "n")
    )


def crosstab_share(df: DataFrame, row: str, column: str, values: Sequence, total: str = "Total") -> DataFrame:
    """Row shares per column value, with one row for the whole table."""
    cells = [F.try_divide(F.sum((F.col(column) == v).cast("int")), F.count(column)).alias(f"{column}_{v}") for v in values]
    return (
        df.rollup(row)
        .agg(F.grouping(row).alias("__g"), *cells)
        .select(F.when(F.col("__g") == 1, total).otherwise(F.col(row).cast("string")).alias(row), *[f"{column}_{v}" for v in values])
    )


def crosstab_mean(df: DataFrame, row: str, column: str, values: Sequence, measure: str) -> DataFrame:
    """Mean of a measure by row and column value; empty cells are null."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(measure))


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts by two keys, one column per value, zero where there are none."""
    out = df.groupBy(row).pivot(column, list(values)).count().na.fill(0)
    return out.toDF(row, *[f"{column}_{v}" for v in values])


def label_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, label, n, share) for every label of every column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns])
    counts = (
        df.select(F.explode(cells).alias("c"))
        .select("c.*")
        .where(F.col("label").isNotNull())
        .groupBy("column", "label")
        .agg(F.count("*").alias("n"))
    )
    total = df.agg(F.count("*").alias("total")).scalar()
    return counts.withColumn("share", F.try_divide(F.col("n"), total))


def rare_labels(df: DataFrame, columns: Sequence[str], below: float) -> DataFrame:
    return label_shares(df, columns).where(F.col("share") < below)


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null labels per column."""
    return label_shares(df, columns).groupBy("column").agg(F.count("*").alias("distinct_values"))


def variable_types(
    df: DataFrame, temporal_words: Sequence[str] = ("Yr", "Year", "date"), discrete_below: int = 20
) -> DataFrame:
    """Role of each column: temporal by name, else categorical by type, else
    discrete with few distinct values and continuous otherwise."""
    types = dict(df.dtypes)
    distinct = profile_columns(df).select("column", "dtype", "distinct_values")
    temporal = [c for c in df.columns if any(w in c for w in temporal_words)]
    text = [c for c in df.columns if types[c] == "string" and c not in temporal]
    role = (
        F.when(F.col("column").isin(temporal), "temporal")
        .when(F.col("column").isin(text), "categorical")
        .when(F.col("distinct_values") < discrete_below, "discrete")
        .otherwise("continuous")
    )
    return distinct.select("column", "dtype", "distinct_values", role.alias("role"))


def top_rows(df: DataFrame, measure: str, k: int, tie: str, ascending: bool = False) -> DataFrame:
    """k extreme rows by a measure (outlier review); ties by the id."""
    order = F.asc_nulls_last(measure) if ascending else F.desc_nulls_last(measure)
    return df.orderBy(order, F.asc(tie)).limit(k)
