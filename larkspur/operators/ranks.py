"""Places in a global order, without a window over a whole column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import saved


def global_rank(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (), name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with its place (from 0) per ``keys`` in ``order``, which should have no ties.

    Rows are cut into ranges of (keys, order), so that a task orders one range only, however
    many rows share a key. What lies before a range is the sum of the counts of the ranges before it; of those there are
    as many as partitions and keys. Ranges come from a sample, hence they are written before they are used.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn("__range", F.spark_partition_id())
    cut = saved(cut, "ranges")
    ranges = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy(*keys, "__range").agg(F.count("*").alias("__n"))
    ends = ends.select(*keys, "__range", F.coalesce(F.sum("__n").over(ranges), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys, "__range").orderBy(*order)
    placed = cut.withColumn("__place", F.row_number().over(inside) - 1)
    out = placed.join(ends, [*keys, "__range"])
    return out.withColumn(name, (F.col("__before") + F.col("__place")).cast("int")).drop("__range", "__before", "__place")
