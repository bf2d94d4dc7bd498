"""Partitioned tables: daily snapshots, retention, statistics, gates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources import files


class MissingPartition(RuntimeError):
    """An upstream partition has not arrived."""


def create_partitioned(
    spark: SparkSession, table: str, columns: str, path: str, partition: str = "record_date", fmt: str = "orc"
) -> None:
    """External partitioned table over a location."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {partition} STRING) USING {fmt} "
        f"PARTITIONED BY ({partition}) LOCATION '{path}'"
    )


def write_snapshot(
    df: DataFrame, path: str, partition: str = "record_date", sort_by: Sequence[str] = (), fmt: str = "orc"
) -> None:
    """Overwrite only the partitions present in the frame; other days stay."""
    if sort_by:
        df = df.sortWithinPartitions(partition, *sort_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    if fmt == "orc":
        writer = writer.option("compression", "snappy")
    writer.format(fmt).save(path)


def _insert(df: DataFrame, table: str, mode: str) -> None:
    """Overwriting insert (columns by name) under a stated partition overwrite mode."""
    spark = df.sparkSession
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, "static")
    spark.conf.set(key, mode)
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def insert_snapshot(df: DataFrame, table: str) -> None:
    """Replace the frame's partitions of a catalog table; other partitions stay."""
    _insert(df, table, "dynamic")


def replace_contents(df: DataFrame, table: str) -> None:
    """Replace all rows of a catalog table, partitions that the frame lacks included."""
    _insert(df, table, "static")


def scan_partition(df: DataFrame, value: str, partition: str = "record_date", drop: Sequence[str] = ()) -> DataFrame:
    """One as-of partition; the filter on the partition column prunes the scan."""
    return df.where(F.col(partition) == F.lit(value)).drop(partition, *drop)


def add_partition(spark: SparkSession, table: str, value: str, partition: str = "record_date") -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({partition}='{value}')")


def recover_partitions(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")


def partitions(spark: SparkSession, table: str, partition: str = "record_date") -> list[str]:
    """Partition values; there is one per retained day, so the list is short."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    prefix = f"{partition}="
    values = [part[len(prefix) :] for r in rows for part in r[0].split("/") if part.startswith(prefix)]
    return sorted(values)


def location(spark: SparkSession, table: str, value: str, partition: str = "record_date") -> str:
    """Where a partition's files lie."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({partition}='{value}')")
    told = [r["data_type"] for r in rows.collect() if r["col_name"] == "Location"]  # a row per column and property
    return told[0]


def swap_partition(spark: SparkSession, table: str, value: str, where: str, partition: str = "record_date") -> str | None:
    """Readers see the files below ``where`` as the partition from now on: one change in the
    catalog, no file moves. Returns the location that the partition had before."""
    before = None
    if value in partitions(spark, table, partition):
        before = location(spark, table, value, partition)
        spark.sql(f"ALTER TABLE {table} PARTITION ({partition}='{value}') SET LOCATION '{where}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({partition}='{value}') LOCATION '{where}'")
    spark.sql(f"REFRESH TABLE {table}")
    return before


def retain(spark: SparkSession, table: str, today: str, keep_days: int, partition: str = "record_date", purge: bool = True) -> list[str]:
    """Drop partitions dated at or before today - keep_days; returns what went. Their files go
    too, also those of an external table, which the catalog alone would leave: else a repair of
    the table brought the days back. ``purge=False`` keeps the files."""
    cutoff = str(dt.date.fromisoformat(today) - dt.timedelta(days=keep_days))
    old = [v for v in partitions(spark, table, partition) if v <= cutoff]
    for value in old:
        where = location(spark, table, value, partition)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition}='{value}')")
        if purge:
            files.remove(spark, where)
    return old


def analyse(spark: SparkSession, table: str, value: str, partition: str = "record_date") -> None:
    spark.sql(f"ANALYZE TABLE {table} PARTITION ({partition}='{value}') COMPUTE STATISTICS")


def require_partition(spark: SparkSession, table: str, value: str, partition: str = "record_date") -> str:
    have = partitions(spark, table, partition)
    if value not in have:
        raise MissingPartition(f"{table} has no partition {partition}={value}; latest is {have[-1] if have else 'none'}")
    return value


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Bucketed and sorted on the key, so later joins on it need no shuffle."""
    df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def create_as(df: DataFrame, table: str, path: str, fmt: str = "orc") -> DataFrame:
    """Replace a table by the result of a query."""
    df.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def strip_qualifier(df: DataFrame) -> DataFrame:
    """``table.column`` names become ``column``."""
    return df.toDF(*[c.split(".")[-1] for c in df.columns])


def clustered(df: DataFrame, key: str, *order: str, partitions: int | None = None) -> DataFrame:
    """Rows of a key together and sorted inside each partition. Meant for tables
    that are unique on the key."""
    out = df.repartition(partitions, key) if partitions else df.repartition(key)
    return out.sortWithinPartitions(key, *order)
