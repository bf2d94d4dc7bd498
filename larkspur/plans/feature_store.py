"""The feature tables of a day, written once and joined without moving a row.

Every step of the feature pipeline ends in one row per consumer. It is written as a table that is
partitioned by day and bucketed by consumer, so the star join of a day's steps reads buckets that
already lie together, and whoever needs the result later reads its written table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import work_path
from larkspur.sources import catalog

KEY, DAY = "consumer_id", "record_date"


class FeatureStore:
    """Step tables by name, all with the same number of buckets."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, prefix: str | None = None, path: str | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.prefix = prefix or f"features_{uuid.uuid4().hex[:8]}"
        self.path = path or work_path(spark, self.prefix)

    def _table(self, step: str) -> str:
        return f"{self.prefix}_{step}"

    def has(self, step: str, day: str) -> bool:
        return self.spark.catalog.tableExists(self._table(step)) and day in catalog.partitions(self.spark, self._table(step), DAY)

    def write(self, step: str, rows: DataFrame, day: str) -> None:
        """The day's rows of a step, in place of those it had. Each bucket is one file,
        written by the task that holds the bucket after the one shuffle by consumer."""
        table, stamped = self._table(step), rows.withColumn(DAY, F.lit(day))
        laid = stamped.repartition(self.buckets, KEY).sortWithinPartitions(KEY)
        if self.spark.catalog.tableExists(table):
            catalog.insert_snapshot(laid, table)
            return
        writer = laid.write.format("parquet").option("path", f"{self.path}/{step}")
        writer.partitionBy(DAY).bucketBy(self.buckets, KEY).sortBy(KEY).saveAsTable(table)

    def read(self, step: str, day: str) -> DataFrame:
        """A day of a step; raises if it has not been written."""
        catalog.require_partition(self.spark, self._table(step), day, DAY)
        return self._rows(step, day)

    def _rows(self, step: str, day: str) -> DataFrame:
        return catalog.scan_partition(self.spark.table(self._table(step)), day, DAY)

    def write_all(self, steps: dict[str, Callable[[], DataFrame]], day: str, at_once: int = 4) -> None:
        """Several steps of a day. They do not depend on each other and none fills the
        cluster, so their jobs run side by side."""
        with ThreadPoolExecutor(at_once) as pool:
            for done in [pool.submit(lambda n=name, f=make: self.write(n, f(), day)) for name, make in steps.items()]:
                done.result()

    def star(self, base: str, others: list[str], day: str) -> DataFrame:
        """Left join of the steps to the base. All are bucketed alike and unique per consumer (the base per
        consumer and its own keys), so the join takes no exchange: a merge join is asked for, as broadcasting would
        be one."""
        missing = [s for s in (base, *others) if not self.has(s, day)]
        if missing:
            raise catalog.MissingPartition(f"no rows of {day} in {', '.join(missing)}")
        out = self._rows(base, day)
        for step in others:
            out = out.join(self._rows(step, day).hint("merge"), KEY, "left")
        return out
